"""Ranked marts over hotel weather and visits.

Top-k is ``row_number() <= k``: Spark keeps k rows per group in every task before the exchange
(``WindowGroupLimit``), so a group of any size sends a bounded number of rows to its task. Every
ranking ends with the key columns, which makes ties reproducible.

Where the SQL joins visits with all weather rows of a hotel only to count them, each side is
counted first and the counts are multiplied: the product itself is never built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylake.functions.temperature import exact_mean
from staylake.functions.stay import day, month_starts, months_apart, nights, stay_category

MONTHS = (8, 9, 10)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 10) -> DataFrame:
    ranked = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k).drop("_rank")


# Weather of hotels ------------------------------------------------------------------------------


def temp_range_month(weather: DataFrame) -> DataFrame:
    spread = F.max("avg_tmpr_c") - F.min("avg_tmpr_c")
    return weather.groupBy("address", "month").agg(F.round(spread, 5).alias("tmpr_diff_cmax"))


def top10_temp_range(weather: DataFrame, k: int = 10) -> DataFrame:
    """Hotels with the largest temperature range of each month."""
    return top_per_group(
        temp_range_month(weather), ["month"], [F.desc("tmpr_diff_cmax"), F.asc("address")], k
    )


def top10_obs_month(weather: DataFrame, k: int = 10) -> DataFrame:
    """Hottest observations of each month."""
    return top_per_group(
        weather.select("address", "month", "avg_tmpr_c", "wthr_date"),
        ["month"],
        [F.desc("avg_tmpr_c"), F.asc("address"), F.asc("wthr_date")],
        k,
    )


def topn_with_ties_dropped(daily: DataFrame, n: int = 10) -> DataFrame:
    """Rows with at most ``n`` rows of their month at their value or above.

    Equal values stand or fall together, so the question is settled on distinct values: count the
    rows of each (month, value), look at the n highest values of a month, keep those whose running
    count stays within n. At most n rows per month come out of that and go back to the table.
    """
    counts = daily.groupBy("month", "avg_tmpr_c").agg(F.count(F.lit(1)).alias("_rows"))
    highest = top_per_group(counts.where(F.col("avg_tmpr_c").isNotNull()), ["month"], [F.desc("avg_tmpr_c")], n)
    running = Window.partitionBy("month").orderBy(F.desc("avg_tmpr_c"))
    kept = (
        highest.withColumn("_running", F.sum("_rows").over(running))
        .where(F.col("_running") <= n)
        .select("month", "avg_tmpr_c")
    )
    # Bounded: n rows for each of the twelve months.
    return daily.join(F.broadcast(kept), ["month", "avg_tmpr_c"], "left_semi").select(
        "address", "month", "avg_tmpr_c", "wthr_date"
    )


def month_summary(weather: DataFrame) -> DataFrame:
    return weather.groupBy("month").agg(
        F.count("month").alias("observations"), F.max("avg_tmpr_c").alias("avg_tmpr_cmax")
    )


def year_month_count(weather: DataFrame) -> DataFrame:
    return weather.groupBy("year", "month").agg(F.count("month").alias("cm"))


def max_temp_hotel_month(weather: DataFrame, month: int | None = None, limit: int | None = None) -> DataFrame:
    """Highest temperature of each hotel and month; for one month, optionally the first ``limit``."""
    if month is not None:
        weather = weather.where(F.col("month") == month)
    out = weather.groupBy("address", "month").agg(F.max("avg_tmpr_c").alias("avg_tmpr_cmax"))
    out = out.orderBy("month", F.desc("avg_tmpr_cmax"), "address")
    return out.limit(limit) if limit else out


def obs_count_hotel(
    weather: DataFrame, by: Sequence[str] = (), month: int | None = None, limit: int | None = None
) -> DataFrame:
    """Observations per hotel and the given extra columns, most first."""
    if month is not None:
        weather = weather.where(F.col("month") == month)
    out = weather.groupBy(*by, "address").agg(F.count("address").alias("visitors"))
    out = out.orderBy(F.desc("visitors"), *by, "address")
    return out.limit(limit) if limit else out


def distinct_periods(weather: DataFrame, visits: DataFrame) -> DataFrame:
    """Distinct year-months and months of the weather, and check-in months of visits to its hotels.

    Each weather row states both periods, so they come from one pass.
    """

    def period(kind: str, year: Column, month: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), year.cast("int").alias("year"), month.alias("month"))

    no_year = F.lit(None)
    both = F.array(
        period("year_month", F.col("year"), F.col("month")), period("month", no_year, F.col("month"))
    )
    check_in = period("check_in_month", no_year, F.month(day("srch_ci")))
    months = visits.select("hotel_id", check_in.alias("p")).distinct()
    known = weather.select(F.col("id").try_cast("bigint").alias("hotel_id")).distinct()
    months = months.join(known, "hotel_id", "left_semi").select("p.*").distinct()
    return weather.select(F.inline(both)).distinct().unionByName(months)


# Visits -----------------------------------------------------------------------------------------


def with_stay_months(visits: DataFrame) -> DataFrame:
    return visits.withColumn("month_ci", F.month(day("srch_ci"))).withColumn(
        "month_co", F.month(day("srch_co"))
    )


def _weather_rows(weather: DataFrame) -> DataFrame:
    """Weather rows of each hotel id and name, with the id as the number visits refer to."""
    return weather.groupBy(F.col("id").try_cast("bigint").alias("hotel_id"), "address").agg(
        F.count(F.lit(1)).alias("_weather")
    )


def _visits_by_months(visits: DataFrame, *extra: str) -> DataFrame:
    return (
        with_stay_months(visits)
        .groupBy("month_ci", "month_co", "hotel_id", *extra)
        .agg(F.count("hotel_id").alias("_visits"))
    )


def joined_visitors(visits: DataFrame, weather: DataFrame) -> DataFrame:
    """Rows of (visits joined to weather by hotel) per month pair and hotel name."""
    return (
        _visits_by_months(visits)
        .join(_weather_rows(weather), "hotel_id")
        .groupBy("month_ci", "month_co", "address")
        .agg(F.sum(F.col("_visits") * F.col("_weather")).alias("visitors"))
    )


def _touches(month: int) -> Column:
    return (F.col("month_ci") == month) | (F.col("month_co") == month)


def _top_of_listed_months(df: DataFrame, months: Sequence[int], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each listed month that a row touches, check-in or check-out.

    A row that touches two listed months competes in both. One pass serves every month.
    """
    listed = F.array(*[F.lit(m) for m in months])
    touched = F.array_intersect(listed, F.array("month_ci", "month_co"))
    return top_per_group(df.withColumn("month", F.explode(touched)), ["month"], order, k)


def union_top10_rows(weather: DataFrame, months: Sequence[int] = MONTHS, k: int = 10) -> DataFrame:
    """The hottest weather rows of each listed month, all columns."""
    return top_per_group(
        weather.where(F.col("month").isin(*months)),
        ["month"],
        [F.desc("avg_tmpr_c"), F.asc("address"), F.asc("wthr_date")],
        k,
    )


def union_top10_obs(weather: DataFrame, months: Sequence[int] = MONTHS, k: int = 10) -> DataFrame:
    counts = obs_count_hotel(weather.where(F.col("month").isin(*months)), by=["month"])
    return top_per_group(counts, ["month"], [F.desc("visitors"), F.asc("address")], k)


def union_top10_joined(visits: DataFrame, weather: DataFrame, months: Sequence[int] = MONTHS, k: int = 10) -> DataFrame:
    order = [F.desc("visitors"), F.asc("month_ci"), F.asc("month_co"), F.asc("address")]
    return _top_of_listed_months(joined_visitors(visits, weather), months, order, k)


def union_top10_visits(visits: DataFrame, months: Sequence[int] = MONTHS, k: int = 10) -> DataFrame:
    counts = _visits_by_months(visits).withColumnRenamed("_visits", "visitors")
    order = [F.desc("visitors"), F.asc("month_ci"), F.asc("month_co"), F.asc("hotel_id")]
    return _top_of_listed_months(counts, months, order, k)


def guest_groups(visits: DataFrame, weather: DataFrame) -> DataFrame:
    """Distinct (month pair, hotel name, adults, children) of visits to hotels with weather."""
    names = weather.select(F.col("id").try_cast("bigint").alias("hotel_id"), "address").distinct()
    people = ["srch_adults_cnt", "srch_children_cnt"]
    return (
        with_stay_months(visits)
        .where((F.col("srch_adults_cnt") > 0) | (F.col("srch_children_cnt") > 0))
        .select("month_ci", "month_co", "hotel_id", *people)
        .distinct()
        .join(names, "hotel_id")
        .select("month_ci", "month_co", "address", *people)
        .distinct()
        .withColumn("visitors", F.col("srch_adults_cnt") + F.col("srch_children_cnt"))
    )


_GUEST_ORDER = ("month_ci", "month_co", "address", "srch_adults_cnt")


def union_top10_guests(visits: DataFrame, weather: DataFrame, months: Sequence[int] = MONTHS, k: int = 10) -> DataFrame:
    order = [F.desc("visitors"), *[F.asc(c) for c in _GUEST_ORDER]]
    top = _top_of_listed_months(guest_groups(visits, weather), months, order, k)
    return top.select("month", "month_ci", "month_co", "address", "visitors")


def guests_per_stay(visits: DataFrame, weather: DataFrame, month: int = 8, k: int = 10) -> DataFrame:
    """Largest parties of the stays that touch one month."""
    top = guest_groups(visits, weather).where(_touches(month))
    top = top.orderBy(F.desc("visitors"), *_GUEST_ORDER).limit(k)
    return top.select("month_ci", "month_co", "address", "visitors")


def visits_ci_co_month(visits: DataFrame, month: int = 10, k: int = 10) -> DataFrame:
    counts = _visits_by_months(visits).withColumnRenamed("_visits", "visitors")
    return counts.where(_touches(month)).orderBy(
        F.desc("visitors"), "month_ci", "month_co", "hotel_id"
    ).limit(k)


def joined_visitors_of_month(visits: DataFrame, weather: DataFrame, month: int = 8, k: int = 10) -> DataFrame:
    """Hotel names by joined rows of the stays that touch one month."""
    touching = joined_visitors(visits, weather).where(_touches(month))
    out = touching.groupBy("address").agg(F.sum("visitors").alias("visitors"))
    return out.orderBy(F.desc("visitors"), "address").limit(k)


def visits_two_months(visits: DataFrame, weather: DataFrame, first: int = 8, last: int = 9, k: int = 10) -> DataFrame:
    """Stays that begin in one given month and end in another, by joined rows per hotel name."""
    visits = visits.where((F.month(day("srch_ci")) == first) & (F.month(day("srch_co")) == last))
    return joined_visitors(visits, weather).orderBy(F.desc("visitors"), "address").limit(k)


def exact_stays(visits: DataFrame) -> DataFrame:
    """Visits of each (check-in, check-out, hotel)."""
    return visits.groupBy("srch_ci", "srch_co", "hotel_id").agg(F.count("hotel_id").alias("visits"))


def visit_hotel_left(visits: DataFrame, weather: DataFrame) -> DataFrame:
    """Exact stays with the hotel name where weather knows it; counts as after the full join."""
    return (
        exact_stays(visits)
        .join(_weather_rows(weather), "hotel_id", "left")
        .select(
            "srch_ci",
            "srch_co",
            F.month(day("srch_ci")).alias("month_ci"),
            F.month(day("srch_co")).alias("month_co"),
            "hotel_id",
            "address",
            (F.col("visits") * F.coalesce("_weather", F.lit(1))).alias("visits"),
        )
    )


def visits_by_exact_stay(visits: DataFrame, k: int = 10) -> DataFrame:
    """Most repeated stays of each check-in month; missing check-ins go after the ranking."""
    counts = with_stay_months(exact_stays(visits).withColumnRenamed("visits", "visitors"))
    order = [F.desc("visitors"), F.asc("hotel_id"), F.asc("srch_ci"), F.asc("srch_co")]
    return top_per_group(counts, ["month_ci"], order, k).where(F.col("srch_ci").isNotNull())


def visits_by_exact_stay_named(visits: DataFrame, weather: DataFrame, k: int = 10) -> DataFrame:
    order = [F.desc("visits"), F.asc("hotel_id"), F.asc("srch_ci"), F.asc("srch_co"), F.asc("address")]
    top = top_per_group(visit_hotel_left(visits, weather), ["month_ci"], order, k)
    return top.where(F.col("srch_ci").isNotNull())


def stay_months_as_coded(stays: DataFrame) -> DataFrame:
    """One row per elapsed month of a stay, ``round(months_between)`` of them plus one.

    A reversed stay keeps one row; a stay with a missing date has none.
    """
    elapsed = F.round(months_apart("srch_ci", "srch_co"), 0).cast("int")
    return (
        stays.withColumn("_months", elapsed)
        .where(F.col("_months").isNotNull())
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_months"), F.lit(0)))))
        .withColumn("dtMonth", F.add_months(day("srch_ci"), F.col("_step")))
        .drop("_months", "_step")
    )


def stay_months_as_stated(stays: DataFrame) -> DataFrame:
    """One row per calendar month that a stay touches."""
    return stays.withColumn("dtMonth", F.explode(month_starts(day("srch_ci"), day("srch_co"))))


def top10_busy_as_coded(visits: DataFrame, weather: DataFrame, k: int = 10) -> DataFrame:
    """Busiest exact stays per year and month, equal counts of a hotel collapsed.

    Visits are counted per stay before they are spread over months, equal counts collapse, and what is
    left is multiplied by the weather rows of the hotel, which is what grouping the joined rows gives: a
    hotel and name has one such number, so nothing collapses after the join that did not before.
    """
    months = stay_months_as_coded(exact_stays(visits)).select(
        "hotel_id", F.year("dtMonth").alias("year"), F.month("dtMonth").alias("month"), "visits"
    )
    counted = (
        months.distinct()
        .join(_weather_rows(weather), "hotel_id")
        .select("year", "month", "hotel_id", "address", (F.col("visits") * F.col("_weather")).alias("visits"))
    )
    order = [F.desc("visits"), F.asc("hotel_id"), F.asc("address")]
    return top_per_group(counted, ["year", "month"], order, k)


def top10_busy_as_stated(visits: DataFrame, k: int = 10) -> DataFrame:
    """Busiest hotels of each calendar month; a visit counts in every month it touches.

    Visits collapse to (hotel, first month, last month) before they are spread over months.
    """
    spans = visits.select("hotel_id", day("srch_ci").alias("ci"), day("srch_co").alias("co")).where(
        F.col("co") >= F.col("ci")
    )
    counted = spans.groupBy(
        "hotel_id", F.trunc("ci", "MM").alias("first"), F.trunc("co", "MM").alias("last")
    ).agg(F.count(F.lit(1)).alias("_visits"))
    monthly = (
        counted.withColumn("m", F.explode(month_starts(F.col("first"), F.col("last"))))
        .groupBy(F.year("m").alias("year"), F.month("m").alias("month"), "hotel_id")
        .agg(F.sum("_visits").alias("visits"))
    )
    return top_per_group(monthly, ["year", "month"], [F.desc("visits"), F.asc("hotel_id")], k)


def category_hotels(visits: DataFrame, categories) -> DataFrame:
    """Visits and distinct hotels of each stay category."""
    days = F.coalesce(nights("srch_ci", "srch_co"), F.lit(0))
    return visits.groupBy(stay_category(days, categories).alias("category")).agg(
        F.count(F.lit(1)).alias("hotels"), F.count_distinct("hotel_id").alias("distinct_hotels")
    )


# Cities -----------------------------------------------------------------------------------------


def city_day(silver: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct hotels and temperatures of each city and day."""
    distinct = F.count_distinct("id") if exact else F.approx_count_distinct("id")
    return silver.groupBy("city", "wthr_date").agg(
        distinct.alias("distinct_hotels"),
        F.round(F.round(exact_mean("avg_tmpr_c"), 10), 1).alias("avg_t"),
        F.round(F.max("avg_tmpr_c"), 1).alias("max_t"),
        F.round(F.min("avg_tmpr_c"), 1).alias("min_t"),
    )


def top10_cities(gold: DataFrame, k: int = 10) -> DataFrame:
    """Cities by their highest daily number of hotels.

    The limit comes before the numbering, so the window without a partition sees ``k`` rows.
    """
    best = gold.groupBy("city").agg(F.max("distinct_hotels").alias("num_of_hotels"))
    best = best.orderBy(F.desc("num_of_hotels"), "city").limit(k)
    ranked = Window.orderBy(F.desc("num_of_hotels"), F.asc("city"))
    return best.withColumn("rank", F.row_number().over(ranked))


def city_series(gold: DataFrame, ranks: Sequence[int] | None = None, k: int = 10) -> DataFrame:
    """Daily rows of the top cities with their rank; ``ranks`` picks some of them."""
    top = top10_cities(gold, k)
    if ranks:
        top = top.where(F.col("rank").isin(*ranks))
    return gold.join(F.broadcast(top), "city").orderBy("rank", "wthr_date")
