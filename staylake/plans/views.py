"""The data model (hotels, weather, visits, clicks) as views on the given tables.

Only this module knows those tables; the operators do not. ``oracles.py`` states the same views in
SQL. Every view covers all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.functions.geohash import geohash


# Keys from here on belong to no hotel and no user.
UNKNOWN = 10**12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _grid(key: Column, period: int, factor: int, low: int) -> Column:
    """A coordinate in hundredths of a degree, spread over the globe by the key."""
    return F.lit(low * 100 + 13) + (key * factor % period) * 100


def _lat100(key: Column) -> Column:
    return _grid(key, 120, 37, -60)


def _lng100(key: Column) -> Column:
    return _grid(key, 340, 53, -170)


def _degrees(hundredths: Column) -> Column:
    return hundredths.cast("double") / 100


def _text(hundredths: Column) -> Column:
    return _degrees(hundredths).cast("decimal(9,2)").cast("string")


def _with_places(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Add nation and region, one stored table after the other.

    The planner knows the size of a stored table, not that of a join; joined in a chain, each can be
    broadcast next to ``df``, whatever the size of ``df``.
    """
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return df.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_places(spark, sf_dir, table(spark, sf_dir, "supplier")).select("s_suppkey", *_place())


def _place() -> list[Column]:
    key = F.col("s_suppkey").cast("string")
    return [
        key.alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("No. "), key).alias("address"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
    ]


def hotel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hotels, all text; some coordinates are NULL and some say NA."""
    key = F.col("s_suppkey")
    kind = key % 5
    lat = F.when(kind == 1, None).when(kind == 2, "NA").otherwise(_text(_lat100(key)))
    lng = F.when(kind.isin(1, 3), None).when(kind == 2, "NA").otherwise(_text(_lng100(key)))
    return _places(spark, sf_dir).select(
        F.col("id").alias("Id"),
        F.col("name").alias("Name"),
        F.col("country").alias("Country"),
        F.col("city").alias("City"),
        F.col("address").alias("Address"),
        lat.alias("Latitude"),
        lng.alias("Longitude"),
    )


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return _places(spark, sf_dir).select(
        F.col("address").alias("Address"),
        F.col("city").alias("City"),
        _text(_lat100(key)).alias("lat"),
        _text(_lng100(key)).alias("lng"),
    )


def _weather_day() -> list[Column]:
    shipped = F.col("l_shipdate")
    return [
        (F.col("l_extendedprice") / 1000).alias("avg_tmpr_c"),
        (F.col("l_extendedprice") / 1000 * 9 / 5 + 32).alias("avg_tmpr_f"),
        shipped.cast("date").cast("string").alias("wthr_date"),
        F.year(shipped).alias("year"),
        F.month(shipped).alias("month"),
        F.dayofmonth(shipped).alias("day"),
    ]


def station_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather points near the hotels; some lie beyond the hotel's cell."""
    key, step = F.col("l_suppkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        _degrees(_lng100(key) + step * 4).alias("lng"),
        _degrees(_lat100(key) + step * 2).alias("lat"),
        *_weather_day(),
    )


def hotel_weather(
    spark: SparkSession, sf_dir: str, raw_coords: bool = False, lineitem: DataFrame | None = None
) -> DataFrame:
    """Observations with their hotel's attributes; ``address`` holds the hotel's name.

    ``raw_coords`` leaves the coordinates as in the raw hotel list, missing ones NULL. ``lineitem``
    may be a stream of the table.
    """
    lineitem = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    key = F.col("s_suppkey")
    lat, lng = _degrees(_lat100(key)), _degrees(_lng100(key))
    cell = geohash(lat, lng, 4).alias("geoHash")
    if raw_coords:
        lat = F.when(~(key % 5).isin(1, 2), lat)
        lng = F.when(~(key % 5).isin(1, 2, 3), lng)
    seen = lineitem.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == key)
    place_id, name, address, city, country = _place()
    return _with_places(spark, sf_dir, seen).select(
        name.alias("address"),
        city,
        country,
        cell,
        place_id,
        address.alias("name"),
        lat.alias("latitude"),
        lng.alias("longitude"),
        *_weather_day(),
    )


def visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stays of -2 to 47 nights, some of 407; a check-in or check-out may be missing, a hotel unknown."""
    nights = F.col("l_quantity").cast("int") - 3 + F.when(F.col("l_quantity") == 50, 360).otherwise(0)
    begin = F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber") - 1)
    quantity = F.col("l_quantity").cast("int")
    as_int = lambda column: column.cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.concat(begin.cast("string"), F.lit(" 12:30:00")).alias("date_time"),
        F.col("l_linenumber").alias("site_name"),
        as_int(F.col("l_suppkey") % 6).alias("posa_continent"),
        as_int(F.col("l_partkey") % 200).alias("user_location_country"),
        as_int(F.col("l_partkey") % 50).alias("user_location_region"),
        as_int(F.col("l_partkey") % 1000).alias("user_location_city"),
        F.when(F.col("l_discount") != 0.1, F.col("l_extendedprice").cast("decimal(12,2)")).alias("orig_destination_distance"),
        as_int(F.col("l_partkey")).alias("user_id"),
        as_int(F.col("l_returnflag") == "R").alias("is_mobile"),
        as_int(F.col("l_linestatus") == "O").alias("is_package"),
        F.col("l_linenumber").alias("channel"),
        F.when(F.col("l_discount") != 0, begin.cast("string")).alias("srch_ci"),
        F.when(F.col("l_tax") != 0, F.date_add(begin, nights).cast("string")).alias("srch_co"),
        F.col("l_linenumber").alias("srch_adults_cnt"),
        (quantity % 3).alias("srch_children_cnt"),
        (quantity % 2 + 1).alias("srch_rm_cnt"),
        as_int(F.col("l_suppkey")).alias("srch_destination_id"),
        (quantity % 9).alias("srch_destination_type_id"),
        (F.col("l_suppkey") + F.when(F.col("l_partkey") % 40 == 0, UNKNOWN).otherwise(0)).alias("hotel_id"),
    )


# Fixed instant of the event clock; taken as UTC whatever the session's time zone.
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def clicks_of(events: DataFrame) -> DataFrame:
    user = F.col("user_id")
    known = F.col("event_id") % 20 != 0
    number = F.from_json("props", "k int")["k"]
    micros = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, ts)")
    page = F.col("event_type").isin("click", "view")
    return events.select(
        F.floor(micros / 1000).alias("_time"),
        F.timestamp_micros(micros).alias("ts"),
        (user + F.when(known, 0).otherwise(UNKNOWN)).alias("userid"),
        F.concat(F.lit("10.0."), F.floor(user / 256).cast("string"), F.lit("."), (user % 256).cast("string")).alias("ip"),
        F.concat("event_type", F.when(page, ".html").otherwise("")).alias("request"),
        F.when(F.col("event_type") != "error", 200).otherwise(number % 6 + 400).alias("status"),
        (F.col("value") * 1024).cast("bigint").alias("bytes"),
    )


def click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks_of(table(spark, sf_dir, "events"))


def web_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers; some clicks come from users beyond them."""
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("n_name").alias("city"),
            F.col("c_mktsegment").alias("level"),
        )
    )


# Columns that hold means: rounded in the last step, in the registry and in the check SQL, well above the noise of doubles.
MEANS = {
    "join_geohash_daily": ["mean_tmpr_c"],
    "visit_weather_full": ["avg_tmpr_c", "avg_tmpr_f"],
    "topn_by_selfjoin": ["avg_tmpr_c"],
    "stay_weather_range": ["avg_tmpr_c"],
    "stay_edges": ["avg_tmpr_c", "avg_tmpr_c_ci", "avg_tmpr_c_co"],
    "sink_partitioned_stays": ["avg_tmpr_c", "avg_tmpr_c_ci", "avg_tmpr_c_co"],
    "stay_trend_ref": ["avg_tmpr_c", "avg_tmpr_c_ci", "avg_tmpr_c_co"],
    "stay_trend_spec": ["avg_tmpr_c_stay"],
}
MEAN_PLACES = 10

# Status codes and their definitions.
STATUS_CODES = (
    (400, "Bad request"),
    (401, "Unauthorized"),
    (402, "Payment required"),
    (403, "Forbidden"),
    (404, "Page not found"),
)


def codes(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({code}, '{text}')" for code, text in STATUS_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(code, definition)")
