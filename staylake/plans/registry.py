"""Every operator bound to the given tables: name -> function of (session, folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylake.functions import cleaning, stay
from staylake.functions.geohash import add_geohash
from staylake.operators import clicks, marts, models, places, profile, rollups, scoring, stays
from staylake.plans import views
from staylake.session import scratch_dir
from staylake.sources import messages, readers, writers
from staylake.streaming import medallion as medal
from staylake.streaming import replay as rp
from staylake.streaming import sessions as sess
from staylake.streaming import tables as kept

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The events lie hours apart per user, so windows are bound to hours where the defaults are seconds.
MINUTE, HOP_20, HOP_5, HALF_MINUTE, GAP = "1 day", "8 hours", "6 hours", "12 hours", "4 hours"
BUCKET_MS = 24 * 3600 * 1000

DATABASE = "staylake"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _named(name: str, function: Query) -> None:
    QUERIES[name] = function


# Views with what the operators expect -----------------------------------------------------------


def _repaired(spark, sf):
    return places.repair_coords(views.hotel(spark, sf), views.gazetteer(spark, sf))


def _hotel_cells(spark, sf):
    return add_geohash(_repaired(spark, sf), "Latitude", "Longitude")


def _hotel_table(spark, sf):
    """The same as a stored table: the planner knows its size when it meets the weather."""
    return writers.materialise(_hotel_cells(spark, sf), scratch_dir(spark, "hotels"))


def _users(spark, sf):
    """Web users as a stored table, for the same reason."""
    return writers.materialise(views.web_users(spark, sf), scratch_dir(spark, "users"))


def _weather_cells(spark, sf):
    return add_geohash(views.station_obs(spark, sf), "lat", "lng")


def _silver(spark, sf):
    return medal.silver_projection(views.hotel_weather(spark, sf, raw_coords=True))


def _daily(spark, sf, per=None):
    return stays.hotel_daily(views.hotel_weather(spark, sf), per=per)


def _daily_full(spark, sf, per):
    attributes = ["name", "address", "city", "country", "geoHash", "latitude", "longitude"]
    return stays.hotel_daily(views.hotel_weather(spark, sf), attributes, ["avg_tmpr_c", "avg_tmpr_f"], per)


# Sources and sinks ------------------------------------------------------------------------------

# Column names and types of the hotel table.
HOTEL_SCHEMA = (
    "Id string, Name string, Country string, City string, Address string, Latitude string, Longitude string"
)


@query
def src_csv_schema(spark, sf):
    path = scratch_dir(spark, "hotels-csv")
    views.hotel(spark, sf).write.option("header", True).option("sep", ";").option("compression", "gzip").csv(path)
    return readers.read_table(spark, path, "csv", HOTEL_SCHEMA, sep=";")


@query
def src_union_files(spark, sf):
    """The observations as one folder a month, read back as one table."""
    path = scratch_dir(spark, "weather-files")
    rows = views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    rows = rows.withColumn("month", F.month("l_shipdate"))
    writers.write_mart(rows.withColumn("part", F.col("month")), path, ["part"])
    return readers.read_many(spark, [path], "parquet", rows.schema)


@query
def src_union_schemas(spark, sf):
    customer = views.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    supplier = views.table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")
    )
    return readers.stack([customer, supplier])


# Column names and types of the hotel-weather table.
WEATHER_SCHEMA = (
    "address string, city string, country string, geoHash string, id string, name string, latitude double, "
    "longitude double, avg_tmpr_c double, avg_tmpr_f double, wthr_date string, year int, month int, day int"
)


@query
def src_parquet_parts(spark, sf):
    path = scratch_dir(spark, "weather-parts")
    writers.write_mart(views.hotel_weather(spark, sf), path, ["year", "month"])
    return readers.read_table(spark, path, "parquet", WEATHER_SCHEMA)


@query
def sink_partitioned(spark, sf):
    path = scratch_dir(spark, "mart")
    mart = marts.top10_temp_range(views.hotel_weather(spark, sf))
    for _ in range(2):
        writers.write_mart(mart, path, ["month"])
    return readers.read_table(spark, path, "parquet", "address string, tmpr_diff_cmax double, month int")


@query
def sink_partitioned_busy(spark, sf):
    path = scratch_dir(spark, "busy-mart")
    mart = marts.top10_busy_as_coded(views.visit(spark, sf), views.hotel_weather(spark, sf))
    writers.write_mart(mart, path, ["year", "month"])
    return spark.read.schema(mart.schema).parquet(path)


@query
def catalog_table(spark, sf):
    writers.create_database(spark, DATABASE)
    shipped = writers.register_table(spark, f"{DATABASE}.observations", f"{sf}/lineitem.parquet")
    return shipped.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.count(F.lit(1)).alias("observations")
    )


@query
def catalog_partitions(spark, sf):
    """Hotel weather as a partitioned table; the second half of the months is written and recovered later."""
    path, table = scratch_dir(spark, "weather-table"), f"{DATABASE}.hotel_weather"
    rows, parts = views.hotel_weather(spark, sf), ["year", "month"]
    writers.create_database(spark, DATABASE)
    writers.write_mart(rows.where("month <= 6"), path, parts)
    writers.register_partitioned(spark, table, path, rows.schema, parts)
    writers.write_mart(rows.where("month > 6"), path, parts)
    known = writers.recover_partitions(spark, table)
    return known.groupBy(*parts).agg(F.count(F.lit(1)).alias("observations"), F.max("avg_tmpr_c").alias("max_t"))


@query
def sink_partitioned_ci(spark, sf):
    """Visitors by months of check-in and check-out, stored by month of check-in."""
    path = scratch_dir(spark, "visitors-mart")
    mart = marts.joined_visitors(views.visit(spark, sf), views.hotel_weather(spark, sf))
    writers.write_mart(mart, path, ["month_ci"])
    return spark.read.schema(mart.schema).parquet(path)


@query
def sink_partitioned_stays(spark, sf):
    """Weather of the edges of stays, stored by the month of check-in.

    By (check-in, check-out) every pair of dates would be a folder of a few rows.
    """
    path = scratch_dir(spark, "edges-mart")
    mart = stays.stay_edges(views.visit(spark, sf), _daily(spark, sf, "day")).withColumn("ci_month", F.substring("srch_ci", 1, 7))
    writers.write_mart(mart, path, ["ci_month"])
    return spark.read.schema(mart.schema).parquet(path)


@query
def ctas_mart(spark, sf):
    writers.create_database(spark, DATABASE)
    view = f"silver_{uuid.uuid4().hex}"
    marts.city_day(_silver(spark, sf)).createOrReplaceTempView(view)
    path = scratch_dir(spark, "gold-table")
    try:
        return writers.create_table_as(spark, f"{DATABASE}.city_day", path, f"SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def _messages(spark, sf):
    return messages.encode_rows(views.visit(spark, sf))


@query
def json_encode_rows(spark, sf):
    return _messages(spark, sf)


def _visit_schema(spark, sf):
    return views.visit(spark, sf).schema


def _cut_messages(spark, sf):
    """Messages, cut off in the middle for stays without a check-out."""
    cut = F.col("value").contains('"srch_co":null')
    half = F.substring("value", F.lit(1), F.floor(F.length("value") / 2).cast("int"))
    return _messages(spark, sf).select(F.when(cut, half).otherwise(F.col("value")).alias("value"))


def _stored_messages(spark, sf):
    """The same as a table of their own."""
    return writers.materialise(_cut_messages(spark, sf), scratch_dir(spark, "messages"))


@query
def json_decode_rows(spark, sf):
    return messages.decode_rows(_stored_messages(spark, sf), _visit_schema(spark, sf))


@query
def json_reject_rows(spark, sf):
    return messages.rejected_rows(_stored_messages(spark, sf), _visit_schema(spark, sf))


def _event_stream(session, spark, sf, **caps):
    schema = views.table(spark, sf, "events").schema
    return readers.stream_table(session, readers.as_stream_path(f"{sf}/events.parquet"), "parquet", schema, **caps)


def _click_stream(session, spark, sf):
    return views.clicks_of(_event_stream(session, spark, sf))


def _plain_clicks(df):
    return df.select("_time", "userid", "ip", "request", "status", "bytes")


@query
def stream_file_source(spark, sf):
    build = lambda s: _event_stream(s, spark, sf, max_files=1).select("event_id", "user_id", "event_type", "value")
    return rp.replay(spark, build, "file-source")


@query
def stream_append_sink(spark, sf):
    """Run twice on one checkpoint: the second run finds nothing new."""
    base = scratch_dir(spark, "append-sink")
    session = rp.stream_session(spark)
    for _ in range(2):
        stream = _plain_clicks(_click_stream(session, spark, sf))
        rp.run_append(stream, f"{base}/table", f"{base}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def _weather_stream(session, spark, sf):
    schema = views.table(spark, sf, "lineitem").schema
    path = readers.as_stream_path(f"{sf}/lineitem.parquet")
    stream = readers.stream_table(session, path, "parquet", schema)
    return views.hotel_weather(session, sf, raw_coords=True, lineitem=stream)


@query
def stream_complete_sink(spark, sf):
    def build(session):
        return _weather_stream(session, spark, sf).groupBy("city", "wthr_date").agg(
            F.count(F.lit(1)).alias("observations"),
            F.max("avg_tmpr_c").alias("max_t"),
            F.min("avg_tmpr_c").alias("min_t"),
        )

    return rp.replay(spark, build, "complete-sink", mode="complete")


@query
def sink_drop_null_records(spark, sf):
    joined = clicks.user_clickstream(views.click(spark, sf), _users(spark, sf))
    return writers.drop_null_records(joined.drop("ts"), ["username", "city"])


@query
def copy_one_day_per_cycle(spark, sf):
    """From a source stored by day: finding days lists folders, copying one reads its folder."""
    path, stored = scratch_dir(spark, "copied-days"), scratch_dir(spark, "days")
    source = views.hotel_weather(spark, sf).select("address", "avg_tmpr_c", "wthr_date")
    writers.write_mart(source, stored, ["wthr_date"])
    for _ in range(3):
        writers.copy_next_folder(spark, stored, path, "wthr_date", source.schema)
    return readers.read_table(spark, path, "parquet", "address string, avg_tmpr_c double, wthr_date string")


# Cleansing --------------------------------------------------------------------------------------

_named("missing_coords", lambda s, d: cleaning.missing_coords(views.hotel(s, d)))
_named("repair_coords", _repaired)
_named("geohash4_hotels", _hotel_cells)
_named("geohash4_weather", lambda s, d: _weather_cells(s, d).select("lng", "lat", "wthr_date", "Geohash"))
_named(
    "mask_field",
    lambda s, d: cleaning.mask_field(views.visit(s, d), "date_time").select(
        "id", "date_time", "srch_ci", "srch_co", "hotel_id"
    ),
)
_named("silver_projection", _silver)


@query
def clean_column_names(spark, sf):
    part = views.table(spark, sf, "part")
    return cleaning.clean_column_names(part.toDF(*[c.replace("_", " ") for c in part.columns]))


_named("null_profile", lambda s, d: cleaning.null_profile(views.hotel(s, d)))


@query
def threshold_label(spark, sf):
    scores = views.table(spark, sf, "embeddings").select("vec_id", "label")
    return cleaning.threshold_label(scores, "label", 7, "high")


@query
def tagged_union(spark, sf):
    customer = views.table(spark, sf, "customer")
    supplier = views.table(spark, sf, "supplier")
    return cleaning.tagged_union(
        customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")),
        supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
        "is_supplier",
    )


_named("distinct_rows", lambda s, d: marts.distinct_periods(views.hotel_weather(s, d), views.visit(s, d)))

# Stays ------------------------------------------------------------------------------------------

_STAY = ["id", "hotel_id", "srch_ci", "srch_co"]

_named("stay_length", lambda s, d: stays.stay_length(views.visit(s, d)))
_named("long_stays", lambda s, d: stays.long_stays(views.visit(s, d)))
_named(
    "stay_category_ref",
    lambda s, d: stays.categorise(views.visit(s, d).select(_STAY), stay.CATEGORIES_AS_CODED),
)
_named(
    "stay_category_spec",
    lambda s, d: stays.categorise(views.visit(s, d).select(_STAY), stay.CATEGORIES_AS_STATED),
)
_named("stay_months_ref", lambda s, d: marts.stay_months_as_coded(views.visit(s, d).select(_STAY)))
_named("stay_months_spec", lambda s, d: marts.stay_months_as_stated(views.visit(s, d).select(_STAY)))
_named("extended_stay_filter_ref", lambda s, d: stays.extended_stays(views.visit(s, d).select(_STAY), True))
_named("extended_stay_filter_spec", lambda s, d: stays.extended_stays(views.visit(s, d).select(_STAY), False))

# Joins ------------------------------------------------------------------------------------------

_named("semi_prefilter", lambda s, d: places.semi_prefilter(_weather_cells(s, d), _hotel_table(s, d)))
_named("join_geohash_inner", lambda s, d: places.join_on_cell(_hotel_table(s, d), _weather_cells(s, d)))
_named("join_geohash_left", lambda s, d: places.join_on_cell(_hotel_table(s, d), _weather_cells(s, d), "left"))
_named("join_geohash_daily", lambda s, d: places.join_cell_daily(_hotel_table(s, d), _weather_cells(s, d)))


_named("join_unmatched", lambda s, d: places.join_unmatched(_hotel_table(s, d), _weather_cells(s, d)))
@query
def visit_weather_full(spark, sf):
    path = scratch_dir(spark, "visit-weather")
    rows = stays.visit_weather_full(views.visit(spark, sf), _daily_full(spark, sf, "day"))
    writers.write_mart(rows, path, ["year", "month"])
    return spark.read.schema(rows.schema).parquet(path)


_named("visit_weather_sizes", lambda s, d: stays.visit_weather_sizes(views.visit(s, d), views.hotel_weather(s, d)))
_named("visit_hotel_left", lambda s, d: marts.visit_hotel_left(views.visit(s, d), views.hotel_weather(s, d)))
_named("topn_by_selfjoin", lambda s, d: marts.topn_with_ties_dropped(_daily(s, d)))
_named("stay_weather_range", lambda s, d: stays.stay_weather_range(views.visit(s, d), _daily_full(s, d, "month")))
_named("stay_edges", lambda s, d: stays.stay_edges(views.visit(s, d), _daily(s, d, "day")))

# Marts ------------------------------------------------------------------------------------------

_W = views.hotel_weather
_V = views.visit

_named("temp_range_month", lambda s, d: marts.temp_range_month(_W(s, d)))
_named("top10_temp_range", lambda s, d: marts.top10_temp_range(_W(s, d)))
_named("top10_obs_month", lambda s, d: marts.top10_obs_month(_W(s, d)))
_named("month_summary", lambda s, d: marts.month_summary(_W(s, d)))
_named("year_month_count", lambda s, d: marts.year_month_count(_W(s, d)))
_named("max_temp_hotel_month", lambda s, d: marts.max_temp_hotel_month(_W(s, d)))
_named("max_temp_one_month", lambda s, d: marts.max_temp_hotel_month(_W(s, d), month=8, limit=10))
_named("obs_count_hotel", lambda s, d: marts.obs_count_hotel(_W(s, d), ["month"], limit=10))
_named("obs_count_hotel_month", lambda s, d: marts.obs_count_hotel(_W(s, d), month=8))
_named("obs_count_hotel_day", lambda s, d: marts.obs_count_hotel(_W(s, d), ["day"], month=8))
_named("union_top10_months", lambda s, d: marts.union_top10_rows(_W(s, d)))
_named("union_top10_obs", lambda s, d: marts.union_top10_obs(_W(s, d)))
_named("union_top10_joined", lambda s, d: marts.union_top10_joined(_V(s, d), _W(s, d)))
_named("union_top10_visits", lambda s, d: marts.union_top10_visits(_V(s, d)))
_named("union_top10_guests", lambda s, d: marts.union_top10_guests(_V(s, d), _W(s, d)))
_named("visits_ci_co_month", lambda s, d: marts.visits_ci_co_month(_V(s, d)))
_named("visits_two_months", lambda s, d: marts.visits_two_months(_V(s, d), _W(s, d)))
_named("joined_visitors", lambda s, d: marts.joined_visitors(_V(s, d), _W(s, d)))
_named("joined_visitors_one_month", lambda s, d: marts.joined_visitors_of_month(_V(s, d), _W(s, d)))
_named("guests_per_stay", lambda s, d: marts.guests_per_stay(_V(s, d), _W(s, d)))
_named("visits_by_exact_stay", lambda s, d: marts.visits_by_exact_stay(_V(s, d)))
_named("visits_by_exact_stay_named", lambda s, d: marts.visits_by_exact_stay_named(_V(s, d), views.hotel_weather(s, d)))
_named("top10_busy_ref", lambda s, d: marts.top10_busy_as_coded(_V(s, d), _W(s, d)))
_named("top10_busy_spec", lambda s, d: marts.top10_busy_as_stated(_V(s, d)))
_named("stay_trend_ref", lambda s, d: stays.stay_trend_as_coded(_V(s, d), _daily(s, d)))
_named("stay_trend_spec", lambda s, d: stays.stay_trend_as_stated(_V(s, d), _daily(s, d, "month")))
_named("category_hotels", lambda s, d: marts.category_hotels(_V(s, d), stay.CATEGORIES_AS_STATED))
_named("city_day_exact", lambda s, d: marts.city_day(_silver(s, d)))
_named("top10_cities", lambda s, d: marts.top10_cities(marts.city_day(_silver(s, d))))


def _gold_table(spark, sf):
    return writers.materialise(marts.city_day(_silver(spark, sf)), scratch_dir(spark, "gold"))


_named("city_series", lambda s, d: marts.city_series(_gold_table(s, d)))
_named("city_series_first", lambda s, d: marts.city_series(_gold_table(s, d), ranks=[1]))

# Clickstream ------------------------------------------------------------------------------------
# name: (view of clicks, users and codes; keys of the result, or None for row-by-row views)

CLICK_VIEWS = {
    "user_clickstream": (lambda c, u, k: clicks.user_clickstream(c, u()).drop("ts"), None),
    "enriched_error_codes": (lambda c, u, k: clicks.enriched_error_codes(c, k).drop("ts"), None),
    "events_per_min": (lambda c, u, k: clicks.events_per_min(c, MINUTE), ["userid", "EVENT_TS"]),
    "pages_per_min": (lambda c, u, k: clicks.pages_per_min(c, MINUTE, HOP_5), ["userid", "EVENT_TS"]),
    "click_user_sessions": (lambda c, u, k: clicks.click_user_sessions(c, u(), GAP), ()),
    "errors_per_min_alert": (lambda c, u, k: clicks.errors_per_min_alert(c, MINUTE, HOP_20), ["status", "EVENT_TS"]),
    "errors_per_min": (lambda c, u, k: clicks.errors_per_min(c, MINUTE, HOP_5), ["status", "EVENT_TS"]),
    "enriched_error_codes_count": (
        lambda c, u, k: clicks.enriched_error_codes_count(c, k, HALF_MINUTE),
        ["code", "definition", "EVENT_TS"],
    ),
    "user_ip_activity": (
        lambda c, u, k: clicks.user_ip_activity(c, u(), MINUTE),
        ["username", "ip", "city", "EVENT_TS"],
    ),
    "user_session_kbytes": (lambda c, u, k: clicks.user_session_kbytes(c, u(), GAP, more_than=100.0), ()),
}


def _click_query(name: str) -> Query:
    view, _ = CLICK_VIEWS[name]
    return lambda s, d: view(views.click(s, d), lambda: _users(s, d), views.codes(s))


def _click_stream_query(name: str) -> Query:
    view, keys = CLICK_VIEWS[name]

    def run(spark, sf):
        def build(session):
            stream = _click_stream(session, spark, sf)
            return view(stream, lambda: _users(session, sf), views.codes(session))

        mode = "append" if keys is None else "update" if keys else "complete"
        return rp.replay(spark, build, name, mode, keys or ())

    return run


for _name in CLICK_VIEWS:
    _named(_name, _click_query(_name))
    _named(f"{_name}_stream", _click_stream_query(_name))


def _named_clicks(spark, sf, base):
    """Clicks with the names of their users, joined batch by batch, as a table that further streams read."""
    users = views.web_users(spark, sf)
    writers.write_mart(users, f"{base}/users")
    clicked = clicks.user_clickstream(views.click(spark, sf), users).schema
    session = rp.stream_session(spark)
    table = lambda s: s.read.schema(users.schema).parquet(f"{base}/users")
    kept.run_joined(_click_stream(session, spark, sf), clicks.user_clickstream, table, f"{base}/named", f"{base}/named-checkpoint")
    return session, clicked


def _named_stream(spark, sf, base):
    session, schema = _named_clicks(spark, sf, base)
    return readers.stream_table(session, f"{base}/named", "parquet", schema, recursiveFileLookup=True)


@query
def user_clickstream_stream(spark, sf):
    base = scratch_dir(spark, "named-clicks")
    _, schema = _named_clicks(spark, sf, base)
    return kept.read_joined(spark, f"{base}/named", schema).drop("ts")


@query
def user_ip_activity_stream(spark, sf):
    base, keys = scratch_dir(spark, "ip-activity"), ["username", "ip", "city"]
    stream = clicks.windowed_count(_named_stream(spark, sf, base), keys, "count", MINUTE, more_than=1)
    keys = [*keys, "EVENT_TS"]
    rp.run_versions(stream, "update", f"{base}/table", f"{base}/checkpoint", keys)
    return rp.read_latest(spark, f"{base}/table", stream.schema, keys)


def _sessions_table(spark, sf, keys):
    """The sessions that a stream of changes describes."""
    base, at = scratch_dir(spark, "sessions"), [*keys, "session"]
    changes = sess.session_changes(_named_stream(spark, sf, base), keys, 4 * 3600)
    rp.run_versions(changes, "update", f"{base}/table", f"{base}/checkpoint", at)
    return rp.read_latest(spark, f"{base}/table", changes.schema, at).where("not gone")


_LAST_MS = "floor(last / 1000) AS EVENT_TS"


@query
def click_user_sessions_stream(spark, sf):
    return _sessions_table(spark, sf, ["username"]).selectExpr("username", _LAST_MS, "events")


@query
def user_session_kbytes_stream(spark, sf):
    rows = _sessions_table(spark, sf, ["username", "ip"])
    return rows.selectExpr("username", "ip", _LAST_MS, "bytes / 1024.0D AS kbytes").where("kbytes > 100")


# A table over a topic: every customer, then a second version in which some moved and some left.
CHANGE_KEYS, CHANGE_ORDER = ["user_id"], "offset"


def _user_changes(spark, sf, version):
    users = views.web_users(spark, sf).withColumn("offset", F.col("user_id") + F.lit(version * 10**12))
    if version == 0:
        return users
    left = F.col("user_id") % 10 == 0
    moved = users.where("user_id % 3 = 0 or user_id % 10 = 0").withColumn("city", F.col("level"))
    return moved.withColumns({c: F.when(~left, F.col(c)) for c in ("username", "city", "level")})


def _follow_changes(spark, sf, base, version):
    """Write the changes of a version to the topic's folder and let the stream take them in."""
    changes = _user_changes(spark, sf, version)
    changes.write.mode("append").parquet(f"{base}/topic")
    stream = readers.stream_table(rp.stream_session(spark), f"{base}/topic", "parquet", changes.schema)
    kept.run_changelog(stream, CHANGE_KEYS, CHANGE_ORDER, f"{base}/users", f"{base}/users-checkpoint")
    return changes.schema


@query
def users_changelog(spark, sf):
    base = scratch_dir(spark, "changelog")
    for version in range(2):
        schema = _follow_changes(spark, sf, base, version)
    return kept.read_changelog(spark, f"{base}/users", schema, CHANGE_KEYS, CHANGE_ORDER).drop("level")


def _arrive(clicks_table, base, parts, part):
    """Clicks that arrive as the given part, in no order of their time."""
    rows = clicks_table.where(F.col("_time") % parts == part)
    rows.write.mode("append").parquet(f"{base}/in")
    return rows.schema


@query
def user_clickstream_changing(spark, sf):
    """Each half of the clicks meets the users as they are when it arrives."""
    base = scratch_dir(spark, "changing")
    for part in range(2):
        changes = _follow_changes(spark, sf, base, part)
        clicked = _arrive(views.click(spark, sf), base, 2, part)
        table = lambda s: kept.read_changelog(s, f"{base}/users", changes, CHANGE_KEYS, CHANGE_ORDER)  # noqa: B023, E731
        stream = readers.stream_table(rp.stream_session(spark), f"{base}/in", "parquet", clicked)
        kept.run_joined(stream, clicks.user_clickstream, table, f"{base}/named", f"{base}/named-checkpoint")
    schema = clicks.user_clickstream(views.click(spark, sf), views.web_users(spark, sf)).schema
    return kept.read_joined(spark, f"{base}/named", schema).drop("ts")


# Clicks arrive in this many parts that all span the whole time, so most windows of the later parts are closed.
PARTS, DELAY = 4, "10 days"


def _watermarked(spark, sf):
    base = scratch_dir(spark, "watermarked")
    for part in range(PARTS):
        clicked = _arrive(views.click(spark, sf), base, PARTS, part)
        stream = readers.stream_table(rp.stream_session(spark), f"{base}/in", "parquet", clicked)
        schema = kept.run_windows(stream, ["userid"], "events", MINUTE, None, DELAY, f"{base}/windows", f"{base}/checkpoint")
    return f"{base}/windows", schema, clicked


@query
def events_per_min_closed(spark, sf):
    """Windows under a watermark that no later click changes."""
    path, schema, _ = _watermarked(spark, sf)
    rows = kept.read_closed(spark, path, schema, DELAY)
    return rows.select("userid", F.unix_millis("start").alias("EVENT_TS"), "events")


@query
def events_per_min_late(spark, sf):
    """Clicks that came after their window was closed."""
    path, schema, clicked = _watermarked(spark, sf)
    late = kept.read_joined(spark, f"{path}/late", clicked.add("start", "timestamp").add("end", "timestamp"))
    return late.select("userid", F.unix_millis("start").alias("EVENT_TS"), "_time")


@query
def medallion_city_day(spark, sf):
    session = rp.stream_session(spark)
    return medal.medallion(spark, _weather_stream(session, spark, sf), scratch_dir(spark, "medallion"))


def _split_messages(spark, sf):
    """A stream of JSON visit messages, some of them cut off: the same messages with their category, and the rest."""
    base = scratch_dir(spark, "stay-category")
    writers.write_mart(_cut_messages(spark, sf), f"{base}/in", compression="zstd")
    schema = _visit_schema(spark, sf)
    stream = readers.stream_table(rp.stream_session(spark), f"{base}/in", "parquet", "value string")
    kept.run_split(
        stream,
        lambda batch: messages.parsed(batch, schema),
        messages.readable(),
        lambda rows: messages.encode_rows(stays.categorise(messages.fields(rows, schema), stay.CATEGORIES_AS_CODED)),
        messages.unreadable,
        f"{base}/out",
        f"{base}/checkpoint",
    )
    return f"{base}/out", schema


def _written_messages(spark, path):
    return kept.read_joined(spark, path, T.StructType().add("value", "string"))


@query
def stay_category_stream(spark, sf):
    path, schema = _split_messages(spark, sf)
    labelled = schema.add("category", "string")
    return messages.decode_rows(_written_messages(spark, f"{path}/good"), labelled).select(*_STAY, "category")


@query
def stay_category_rejects(spark, sf):
    path, _ = _split_messages(spark, sf)
    return _written_messages(spark, f"{path}/rejected")


# Rollups ----------------------------------------------------------------------------------------


def _rollup(view: str, metric, out: str, by=(), bucket=BUCKET_MS, fill=False) -> Query:
    """A panel over a clickstream view; one that ranks terms reads the view more than once."""

    def run(spark, sf):
        rows = _click_query(view)(spark, sf)
        if by:
            rows = writers.materialise(rows, scratch_dir(spark, view))
        return rollups.time_rollup(rows, metric(), out, by, bucket, fill=fill)

    return run


_named("roll_alert_status", _rollup("errors_per_min_alert", lambda: F.max("errors"), "max_errors", ["status"]))
_named("roll_alert_status_filled", _rollup("errors_per_min_alert", lambda: F.max("errors"), "max_errors", ["status"], fill=True))
_named("roll_sessions_filled", _rollup("click_user_sessions", lambda: F.max("events"), "max_events", ["username"], fill=True))
_named("roll_events_filled", _rollup("events_per_min", lambda: F.max("events"), "max_events", fill=True))
_named(
    "roll_ip_user_city",
    _rollup("user_ip_activity", lambda: F.count(F.lit(1)), "records", ["ip", "username", "city"], None),
)
_named("roll_sessions", _rollup("click_user_sessions", lambda: F.max("events"), "max_events", ["username"]))
_named("roll_pages", _rollup("pages_per_min", lambda: F.avg("pages"), "avg_pages"))
_named(
    "roll_codes",
    _rollup("enriched_error_codes_count", lambda: F.max("count"), "max_count", ["code", "definition"]),
)
_named("roll_events", _rollup("events_per_min", lambda: F.max("events"), "max_events"))
_named("roll_kbytes", _rollup("user_session_kbytes", lambda: F.max("kbytes"), "max_kbytes", ["username", "ip"]))

# Tabular models ---------------------------------------------------------------------------------

_named("label_histogram", lambda s, d: profile.label_histogram(views.table(s, d, "embeddings"), "label"))
_named(
    "box_stats_by_label",
    lambda s, d: profile.box_stats_by_label(views.table(s, d, "embeddings"), "label", "embedding"),
)


def _scored_table(spark, sf):
    table = cleaning.threshold_label(views.table(spark, sf, "embeddings"), "label", 7, "high")
    return models.with_vector(table, "embedding")


def _parts(spark, sf):
    return models.split_parts(_scored_table(spark, sf), "vec_id")


# A stated model, so that its scores can be computed again without a fit.
WEIGHTS = [((i * 37) % 11 - 5) / 10 for i in range(64)]
INTERCEPT = 0.25
SWEPT_AUC = 0.7
SWEEP = {"trials": 6, "rounds": 5, "depth": (4, 6), "parallelism": 4}


@query
def train_test_split(spark, sf):
    return models.train_test_split(views.table(spark, sf, "embeddings").select("vec_id"), "vec_id")


# A label with a known signal, so that the fits can be held to a bound: two of the features decide it.
PLANTED, LEAST_AUC = (3, 7), 0.8


def _planted_parts(spark, sf):
    a, b = (F.col("embedding")[i] for i in PLANTED)
    table = views.table(spark, sf, "embeddings").withColumn("high", (a > b).cast("int"))
    return models.split_parts(models.with_vector(table, "embedding"), "vec_id")


@query
def rf_baseline(spark, sf):
    """An untuned forest finds the planted signal."""
    fitted = models.rf_baseline(*_planted_parts(spark, sf), "high")
    return fitted.select("trees", "train_rows", "test_rows", (F.col("auc") >= LEAST_AUC).alias("is_auc"))


@query
def feature_importance(spark, sf):
    """Each feature, whether it is one of the two most important, and the sum of all shares."""
    model = models.fit_forest(_planted_parts(spark, sf)[0], "high")
    shares = models.feature_importance(model, spark)
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))  # as many rows as features
    total = shares.agg(F.round(F.sum("importance"), 6).alias("total"))
    return shares.select("feature", (place <= len(PLANTED)).alias("is_top")).join(F.broadcast(total))


@query
def tuned_sweep(spark, sf):
    """A small search: six trials of five rounds, depths of 4 to 6 of the operator's 4 to 30; one row a trial, best
    first, and whether the best found the planted signal."""
    ranked = models.tuned_sweep(_planted_parts(spark, sf)[0], "high", **SWEEP)[0]
    order = Window.orderBy(F.desc("auc"), "trial")  # as many rows as trials
    place = F.row_number().over(order)
    found = F.max("auc").over(Window.partitionBy()) >= SWEPT_AUC
    return ranked.select(place.alias("place"), found.alias("is_auc"), F.col("maxDepth").between(*SWEEP["depth"]).alias("in_range"))


@query
def batch_score(spark, sf):
    model = models.stated_linear(spark, WEIGHTS, INTERCEPT)
    scored = models.batch_score(model, _scored_table(spark, sf), "vec_id")
    return scored.withColumn("prediction", F.round("prediction", 6))


@query
def stored_model_scores(spark, sf):
    """A fitted forest that was stored: read again, and through the function that SQL calls, it scores as before."""
    train, _ = _planted_parts(spark, sf)
    fitted, path = models.fit_forest(train, "high"), scratch_dir(spark, "forest")
    scoring.store_model(fitted, path)
    table = _scored_table(spark, sf)
    name = f"forest_{uuid.uuid4().hex}"
    scoring.register_scorer(spark, name, path)
    rows = models.batch_score(fitted, table, "vec_id")
    again = models.batch_score(scoring.read_model(spark, path), table, "vec_id").withColumnRenamed("prediction", "again")
    called = scoring.scored_by_sql(table, "vec_id", "embedding", fitted.numFeatures, name).withColumnRenamed("prediction", "called")
    near = lambda c: F.abs(F.col("prediction") - F.col(c)) <= 1e-9
    both = rows.join(again, "vec_id").join(called, "vec_id")
    return both.select("vec_id", near("again").alias("read_agrees"), near("called").alias("sql_agrees"))


@query
def score_udf(spark, sf):
    table = views.table(spark, sf, "embeddings")
    scored = models.score_struct(table, "vec_id", "embedding", WEIGHTS, INTERCEPT)
    return scored.withColumn("prediction", F.round("prediction", 6))


def _rounded(name: str, run: Query) -> Query:
    return lambda s, d: run(s, d).withColumns({c: F.round(c, views.MEAN_PLACES) for c in views.MEANS[name]})


for _name in views.MEANS:
    QUERIES[_name] = _rounded(_name, QUERIES[_name])
