"""Stays and the weather during them.

Weather comes in as one row per hotel and day. A stay meets it through (hotel, day) for its edges
and through (hotel, month) for its days, never through the hotel alone: a hotel with a third of all
visits is spread over its days or months, and a stay is compared with the at most 31 rows of each
month it touches. Repeated stays are counted before any join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.functions.stay import (
    day,
    extended_as_coded,
    extended_as_stated,
    extended_dates_as_coded,
    extended_dates_as_stated,
    month_starts,
    months_apart,
    nights,
    stay_category,
)
from staylake.functions.temperature import exact_decimal, exact_mean


#: What joins with daily weather meet on beside the hotel: a day, or the first day of a month.
UNITS = {"day": "_day", "month": "_month"}


def hotel_daily(
    weather: DataFrame,
    attributes: Sequence[str] = ("address",),
    measures: Sequence[str] = ("avg_tmpr_c",),
    per: str | None = None,
) -> DataFrame:
    """One row per hotel and day with the means of the measures and the named hotel attributes.

    With ``per`` (day or month) the observations are dealt by hotel and day or month before they are aggregated,
    and the result keeps these keys, so a join on them sends the days through no second shuffle. That is for
    weather of few observations a day, where aggregating in each task first saves nothing.
    """
    means = [exact_mean(c).alias(c) for c in measures]
    keys = []
    if per:
        weather = _keyed(weather, per)
        keys = ["hotel_id", UNITS[per]]
        weather = weather.select(*keys, "id", "wthr_date", *attributes, *measures).repartition(*keys)
    daily = weather.groupBy(*keys, "id", "wthr_date", *attributes).agg(*means)
    observed = day("wthr_date")
    parts = {"year": F.year(observed), "month": F.month(observed), "day": F.dayofmonth(observed)}
    return daily.withColumns(parts)


def _keyed(weather: DataFrame, per: str) -> DataFrame:
    """Weather with ``hotel_id`` and its day or month, which it may have already; rows without them meet no stay
    but are kept."""
    if {"hotel_id", UNITS[per]} <= set(weather.columns):
        return weather
    observed = day("wthr_date")
    unit = observed if per == "day" else F.trunc(observed, "MM")
    return weather.withColumns({"hotel_id": F.col("id").try_cast("bigint"), UNITS[per]: unit})


def stay_length(visits: DataFrame) -> DataFrame:
    return visits.select(
        "hotel_id",
        "srch_ci",
        "srch_co",
        nights("srch_ci", "srch_co").alias("datediff"),
        F.round(months_apart("srch_ci", "srch_co"), 2).alias("monthdiff"),
    )


def long_stays(visits: DataFrame, more_than: int = 365) -> DataFrame:
    return stay_length(visits).where(F.col("datediff") > more_than).drop("monthdiff")


def categorise(visits: DataFrame, categories) -> DataFrame:
    """Append the stay category; a missing or unreadable date counts as zero nights."""
    days = F.coalesce(nights("srch_ci", "srch_co"), F.lit(0))
    return visits.withColumn("category", stay_category(days, categories))


def extended_stays(visits: DataFrame, as_coded: bool) -> DataFrame:
    rule = extended_as_coded if as_coded else extended_as_stated
    return visits.where(rule("srch_ci", "srch_co"))


def _by_day(daily: DataFrame, *columns: str) -> DataFrame:
    return _keyed(daily, "day").select("hotel_id", "_day", *columns)


def _exact(column: Column) -> Column:
    """Temperature as a decimal, so that half-way roundings carry no binary noise."""
    return column.try_cast("decimal(28,12)")


def _round5(value: Column) -> Column:
    return F.round(value, 5).cast("double")


def _stays(visits: DataFrame, as_coded: bool) -> DataFrame:
    """Distinct extended stays as dates, with the number of visits that share each.

    Only readable dates pass the length rules, so a date stands for exactly one text.
    """
    # ``inline`` reads each date once, for the rule and for what follows.
    dates = F.struct(day("srch_ci").alias("_ci"), day("srch_co").alias("_co"))
    rule = extended_dates_as_coded if as_coded else extended_dates_as_stated
    dated = visits.select("hotel_id", F.inline(F.array(dates))).where(rule(F.col("_ci"), F.col("_co")))
    return dated.groupBy("hotel_id", "_ci", "_co").agg(F.count(F.lit(1)).alias("visits"))


def _text(date: str, name: str) -> Column:
    return F.col(date).cast("string").alias(name)


def _days_inside(stays: DataFrame, daily: DataFrame, *columns: str) -> DataFrame:
    """Each stay with the weather rows from its first to its last day."""
    by_month = stays.withColumn("_month", F.explode(month_starts(F.col("_ci"), F.col("_co"))))
    rows = _keyed(daily, "month").select("hotel_id", "_month", day("wthr_date").alias("_day"), *columns)
    return by_month.join(rows, ["hotel_id", "_month"]).where(F.col("_day").between(F.col("_ci"), F.col("_co")))


def stay_weather_range(visits: DataFrame, daily: DataFrame) -> DataFrame:
    """Distinct weather days inside the stays that pass the coded length rule."""
    columns = ["address", "avg_tmpr_c", "wthr_date", "city", "country", "geoHash", "year", "month"]
    return _days_inside(_stays(visits, as_coded=True), daily, *columns).select(
        "hotel_id", _text("_ci", "srch_ci"), _text("_co", "srch_co"), *columns
    )


def _edge_days(ci: Column, co: Column) -> Column:
    """First and last day; for a reversed stay every day between them, as the coded clause gives."""
    reversed_days = F.sequence(F.least(ci, co), F.greatest(ci, co), F.expr("interval 1 day"))
    return F.when(co < ci, reversed_days).otherwise(F.array_distinct(F.array(ci, co)))


def stay_edges(visits: DataFrame, daily: DataFrame) -> DataFrame:
    """Weather of the first and last day as two columns, with the number of equal stays."""
    ci, co, temperature = F.col("_ci"), F.col("_co"), F.col("avg_tmpr_c")
    return (
        _stays(visits, as_coded=True)
        .withColumn("_day", F.explode(_edge_days(ci, co)))
        .join(_by_day(daily, "address", "avg_tmpr_c", "wthr_date"), ["hotel_id", "_day"])
        .select(
            "hotel_id",
            "address",
            "avg_tmpr_c",
            "wthr_date",
            _text("_ci", "srch_ci"),
            _text("_co", "srch_co"),
            F.when(F.col("_day") == ci, temperature).alias("avg_tmpr_c_ci"),
            F.when(F.col("_day") == co, temperature).alias("avg_tmpr_c_co"),
            "visits",
        )
    )


def stay_trend_as_coded(visits: DataFrame, daily: DataFrame) -> DataFrame:
    """Last-day and first-day weather met on (check-in, hotel name).

    Stays that share a check-in meet each other there, so n stays would give n * n equal rows.
    Both sides are counted per distinct row and ``copies`` holds the product of the counts: the
    table says how often a row occurs instead of repeating it.
    """
    stays = _stays(visits, as_coded=True)
    rows = _by_day(daily, "address", "avg_tmpr_c")
    last = (
        stays.withColumn("_day", F.col("_co"))
        .join(rows, ["hotel_id", "_day"])
        .groupBy("address", "_ci", "_co", F.col("avg_tmpr_c").alias("avg_tmpr_c_co"))
        .agg(F.sum("visits").alias("_last"))
    )
    first = (
        stays.groupBy("hotel_id", F.col("_ci").alias("_day"))
        .agg(F.sum("visits").alias("visits"))
        .join(rows, ["hotel_id", "_day"])
        .groupBy("address", F.col("_day").alias("_ci"), F.col("avg_tmpr_c").alias("avg_tmpr_c_ci"))
        .agg(F.sum("visits").alias("_first"))
    )
    t_co, t_ci = _exact(F.col("avg_tmpr_c_co")), _exact(F.col("avg_tmpr_c_ci"))
    return last.join(first, ["_ci", "address"]).select(
        "address",
        F.col("avg_tmpr_c_co").alias("avg_tmpr_c"),
        _text("_co", "wthr_date"),
        _text("_ci", "srch_ci"),
        _text("_co", "srch_co"),
        "avg_tmpr_c_co",
        "avg_tmpr_c_ci",
        _round5(F.abs(t_co - t_ci)).alias("weather_trend"),
        _round5((t_co + t_ci) / 2).alias("avg_tmpr_c_visits"),
        (F.col("_last") * F.col("_first")).alias("copies"),
    )


def stay_trend_as_stated(visits: DataFrame, daily: DataFrame) -> DataFrame:
    """Signed change from the first to the last observed day and the mean over the whole stay.

    The decimal of a day's temperature is worked out once a day, before stays meet it.
    """
    temperature = F.col("avg_tmpr_c")
    change = _exact(F.max_by(temperature, "_day")) - _exact(F.min_by(temperature, "_day"))
    daily = daily.withColumn("_decimal", exact_decimal(temperature))
    return (
        _days_inside(_stays(visits, as_coded=False), daily, "address", "avg_tmpr_c", "_decimal")
        .groupBy("hotel_id", "address", "_ci", "_co", "visits")
        .agg(
            _round5(change).alias("weather_trend"),
            exact_mean("avg_tmpr_c", "_decimal").alias("avg_tmpr_c_stay"),
            F.count(F.lit(1)).alias("days_observed"),
        )
        .withColumnsRenamed({"_ci": "srch_ci", "_co": "srch_co"})
        .withColumns({c: F.col(c).cast("string") for c in ("srch_ci", "srch_co")})
    )


def visit_weather_full(visits: DataFrame, daily: DataFrame) -> DataFrame:
    """Every column of the visits with the daily weather of the check-in day, ready to be partitioned.

    The visit's own id gives way to ``hotel_id``, which is the weather's id too. A join on the hotel alone
    pairs all visits of a hotel with all its weather rows; ``visit_weather_sizes`` tells how large that
    table would be.
    """
    keyed = visits.drop("id").withColumn("_day", day("srch_ci"))
    return keyed.join(_keyed(daily, "day").drop("id"), ["hotel_id", "_day"]).drop("_day")


def visit_weather_sizes(visits: DataFrame, weather: DataFrame) -> DataFrame:
    """Rows of the hotel-only join per (year, month, day) partition, from the two sides' counts."""
    per_hotel = visits.groupBy("hotel_id").agg(F.count(F.lit(1)).alias("_visits"))
    per_day = weather.groupBy(
        F.col("id").try_cast("bigint").alias("hotel_id"), "year", "month", "day"
    ).agg(F.count(F.lit(1)).alias("_weather"))
    return (
        per_day.join(per_hotel, "hotel_id")
        .groupBy("year", "month", "day")
        .agg(F.sum(F.col("_visits") * F.col("_weather")).alias("rows"))
    )
