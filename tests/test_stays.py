import datetime as dt
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from staylake.functions import stay
from staylake.functions.temperature import exact_decimal, exact_mean
from staylake.operators import marts, stays

VISIT = "id long, hotel_id long, srch_ci string, srch_co string"


def visits(spark, *pairs, hotel=1):
    return spark.createDataFrame([(i, hotel, ci, co) for i, (ci, co) in enumerate(pairs)], VISIT)


@pytest.mark.parametrize(
    "days, coded, stated",
    [
        (-1, "Erroneous data", "Erroneous data"),
        (0, "Erroneous data", "Erroneous data"),
        (1, "Short stay", "Short stay"),
        (4, "Short stay", "Short stay"),
        (5, "Short stay", "Standard stay"),
        (10, "Short stay", "Standard stay"),
        (11, "Standard stay", "Standard extended stay"),
        (14, "Standard stay", "Standard extended stay"),
        (15, "Standard extended stay", "Long stay"),
    ],
)
def test_categories(spark, days, coded, stated):
    ci = dt.date(2017, 8, 10)
    df = visits(spark, (str(ci), str(ci + dt.timedelta(days=days))))
    assert stays.categorise(df, stay.CATEGORIES_AS_CODED).first().category == coded
    assert stays.categorise(df, stay.CATEGORIES_AS_STATED).first().category == stated


BAD = [None, "", "NA", "2017-8-1", "2017-02-30", "12017-8-01", "2017-08-1 ", "2017-08-01T", " 2017-08-01", "20170801"]


def test_unreadable_dates_are_erroneous_stays(spark):
    df = visits(spark, *[(b, "2017-09-01") for b in BAD], *[("2017-07-01", b) for b in BAD])
    assert {r.category for r in stays.categorise(df, stay.CATEGORIES_AS_CODED).collect()} == {"Erroneous data"}
    assert marts.stay_months_as_coded(df).count() == 0
    assert marts.stay_months_as_stated(df).count() == 0
    assert stays.extended_stays(df, True).count() == stays.extended_stays(df, False).count() == 0


def months(df):
    return [r.dtMonth.isoformat() for r in df.orderBy("dtMonth").collect()]


def test_months_of_a_stay(spark):
    short, long, back = ("2017-08-31", "2017-09-02"), ("2017-08-31", "2017-09-20"), ("2017-08-31", "2017-05-02")
    assert months(marts.stay_months_as_coded(visits(spark, short))) == ["2017-08-31"]
    assert months(marts.stay_months_as_coded(visits(spark, long))) == ["2017-08-31", "2017-09-30"]
    assert months(marts.stay_months_as_coded(visits(spark, back))) == ["2017-08-31"]
    for pair in (short, long):
        assert months(marts.stay_months_as_stated(visits(spark, pair))) == ["2017-08-01", "2017-09-01"]
    assert months(marts.stay_months_as_stated(visits(spark, back))) == []
    assert len(months(marts.stay_months_as_stated(visits(spark, ("2016-01-15", "2017-03-01"))))) == 15


def test_extended_rules_differ(spark):
    df = visits(spark, ("2017-08-30", "2017-09-02"), ("2017-08-01", "2017-09-01"), ("2017-08-01", "2017-08-08"))
    assert [r.id for r in stays.extended_stays(df, True).orderBy("id").collect()] == [0, 2]
    assert [r.id for r in stays.extended_stays(df, False).orderBy("id").collect()] == [1]


def daily(spark, rows):
    schema = "id string, address string, wthr_date string, avg_tmpr_c double, year int, month int"
    full = [(str(h), f"hotel {h}", d, t, int(d[:4]), int(d[5:7])) for h, d, t in rows]
    return spark.createDataFrame(full, schema)


def random_world(seed):
    rng = random.Random(seed)
    start = dt.date(2017, 1, 20)
    day = lambda n: str(start + dt.timedelta(days=n))
    weather = [(h, day(n), round(rng.uniform(-5, 30), 1)) for h in (1, 2, 3) for n in range(90) if rng.random() < 0.6]
    trips = []
    for i in range(60):
        hotel, ci = rng.choice((1, 1, 1, 2, 4)), rng.randrange(70)
        trips.append((i, hotel, day(ci), day(ci + rng.randrange(-15, 45))))
    trips += [(100, 1, None, day(3)), (101, 1, day(3), None), trips[0], trips[0]]
    return weather, trips


@pytest.mark.parametrize("seed", [1, 2])
def test_range_and_trend_against_nested_loops(spark, seed):
    weather, trips = random_world(seed)
    table, days = spark.createDataFrame(trips, VISIT), daily(spark, weather)
    readable = [t for t in trips if t[2] and t[3]]
    date = dt.date.fromisoformat

    coded = {t[1:] for t in readable if abs(date(t[3]).day - date(t[2]).day) >= 7}
    want = {(*t, d) for t, (h, d, _) in itertools.product(coded, weather) if h == t[0] and t[1] <= d <= t[2]}
    world = days.selectExpr("*", "'c' city", "'k' country", "'g' geoHash")
    got = stays.stay_weather_range(table, world).collect()
    assert len(got) == len(want)
    assert {(r.hotel_id, r.srch_ci, r.srch_co, r.wthr_date) for r in got} == want

    edges = stays.stay_edges(table, days).collect()
    on_edge = [
        (t[1], t[2], t[3], d)
        for t, (h, d, _) in itertools.product([t for t in readable if t[1:] in coded], weather)
        if h == t[1] and (d in (t[2], t[3]) or t[3] <= d <= t[2])
    ]
    assert sum(r.visits for r in edges) == len(on_edge)
    assert {(r.hotel_id, r.srch_ci, r.srch_co, r.wthr_date) for r in edges} == set(on_edge)

    rows = [t for t in readable if t[1:] in coded]
    at = {(h, d): v for h, d, v in weather}
    pairs = [
        (a[1], a[2], a[3], at[a[1], a[3]], at[b[1], b[2]])
        for a, b in itertools.product(rows, rows)
        if a[1] == b[1] and a[2] == b[2] and (a[1], a[3]) in at and (b[1], b[2]) in at
    ]
    trend = stays.stay_trend_as_coded(table, days).collect()
    assert sum(r.copies for r in trend) == len(pairs)
    assert {(int(r.address[6:]), r.srch_ci, r.srch_co, r.avg_tmpr_c_co, r.avg_tmpr_c_ci) for r in trend} == set(pairs)

    stated = {(r.hotel_id, r.srch_ci, r.srch_co): r for r in stays.stay_trend_as_stated(table, days).collect()}
    long = [t[1:] for t in readable if (date(t[3]) - date(t[2])).days > 7]
    for key in set(long):
        inside = sorted((d, v) for h, d, v in weather if h == key[0] and key[1] <= d <= key[2])
        if inside:
            r = stated.pop(key)
            assert r.weather_trend == pytest.approx(inside[-1][1] - inside[0][1], abs=1e-9)
            assert r.avg_tmpr_c_stay == pytest.approx(sum(v for _, v in inside) / len(inside))
            assert r.visits == long.count(key)
    assert not stated


def test_trend_counts_copies_of_a_hot_check_in(spark):
    """A thousand visits that share a check-in stay one row each side, not a million."""
    trips = [(i, 1, "2017-03-01", "2017-03-12") for i in range(1000)]
    days = daily(spark, [(1, "2017-03-01", 5.0), (1, "2017-03-12", 8.0)])
    got = stays.stay_trend_as_coded(spark.createDataFrame(trips, VISIT), days).collect()
    assert [(r.copies, r.weather_trend, r.avg_tmpr_c_visits) for r in got] == [(1_000_000, 3.0, 6.5)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_topn_with_ties_against_the_self_join(spark, seed):
    rng = random.Random(seed)
    rows = [(f"h{i}", rng.randrange(1, 4), float(rng.randrange(25)), f"d{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "address string, month int, avg_tmpr_c double, wthr_date string")
    want = {r for r in rows if sum(1 for o in rows if o[1] == r[1] and o[2] >= r[2]) <= 10}
    got = [tuple(r) for r in marts.topn_with_ties_dropped(df, 10).collect()]
    assert len(got) == len(want)
    assert set(got) == want


def test_null_check_in_leaves_after_the_ranking(spark):
    rows = [(i, 1, None, "2017-08-05") for i in range(3)] + [(9, 1, "2017-08-01", "2017-08-05")]
    got = marts.visits_by_exact_stay(spark.createDataFrame(rows, VISIT)).collect()
    assert [(r.srch_ci, r.visitors) for r in got] == [("2017-08-01", 1)]


def test_ties_across_the_tenth_place_follow_the_key(spark):
    rows = [(f"h{i:02}", 8, float(v)) for i in range(15) for v in (0, 7)]
    df = spark.createDataFrame(rows, "address string, month int, avg_tmpr_c double")
    got = [r.address for r in marts.top10_temp_range(df).orderBy("address").collect()]
    assert got == [f"h{i:02}" for i in range(10)]


def test_product_sizes_without_the_product(spark):
    weather = spark.createDataFrame(
        [("1", 2017, 8, 1), ("1", 2017, 8, 1), ("1", 2017, 8, 2), ("7", 2017, 8, 1), ("x", 2017, 8, 1)],
        "id string, year int, month int, day int",
    )
    table = visits(spark, *[("2017-08-01", "2017-08-02")] * 4)
    got = {(r.year, r.month, r.day): r.rows for r in stays.visit_weather_sizes(table, weather).collect()}
    assert got == {(2017, 8, 1): 8, (2017, 8, 2): 4}


def test_daily_mean_is_exact_and_skips_missing(spark):
    rows = [("1", "2017-08-01", t) for t in (0.1, 0.2, 0.3, None)] + [("1", "2017-08-02", None)]
    df = spark.createDataFrame([(*r, "h") for r in rows], "id string, wthr_date string, avg_tmpr_c double, address string")
    got = {r.wthr_date: r.avg_tmpr_c for r in stays.hotel_daily(df).collect()}
    assert got == {"2017-08-01": 0.6 / 3, "2017-08-02": None}


def test_means_of_values_that_have_no_exact_decimal(spark):
    cases = {"nan": [1.0, 3.0, float("nan")], "inf": [1.0, float("inf")], "both": [float("inf"), float("-inf")], "large": [1e21, 3e21, None],
             "fine": [1e-12, 3e-12], "finer": [1e-25, 3e-25], "none": [None], "noise": [0.1] * 10}
    df = spark.createDataFrame([(k, v) for k, values in cases.items() for v in values], "k string, v double")
    got = {r.k: r.m for r in df.groupBy("k").agg(exact_mean("v").alias("m")).collect()}
    assert math.isnan(got["nan"]) and math.isnan(got["both"]) and got["inf"] == math.inf and got["none"] is None
    assert got["large"] == 2e21 and got["fine"] == pytest.approx(2e-12, rel=1e-12) and got["finer"] == pytest.approx(2e-25)
    assert got["noise"] == 0.1


def test_daily_means_are_compared_unrounded(spark):
    """Two days whose means differ by less than ten places: only the warmer one has at most one row at its value or above."""
    rows = [("1", "2017-08-01", "h", 1.0), ("2", "2017-08-01", "i", 1.0 + 1e-12)]
    daily = stays.hotel_daily(spark.createDataFrame(rows, "id string, wthr_date string, address string, avg_tmpr_c double"))
    assert [r.address for r in marts.topn_with_ties_dropped(daily, 1).collect()] == ["i"]


def test_means_of_decimals_worked_out_before(spark):
    cases = {"plain": [21.5, -3.25, 0.1] * 7, "below": [-0.1, -0.2, -1e-15], "large": [999999999.123, -999999998.9, 1e-9],
             "carry": [0.999999999999] * 50, "nan": [1.0, float("nan")], "fine": [1e-25, 1.0], "none": [None], "some": [None, 7.0]}
    df = spark.createDataFrame([(k, v) for k, values in cases.items() for v in values], "k string, v double")
    df = df.withColumn("l", exact_decimal(F.col("v")))
    rows = df.groupBy("k").agg(exact_mean("v").alias("a"), exact_mean("v", "l").alias("b")).collect()
    assert len(rows) == len(cases) and all(repr(r.a) == repr(r.b) for r in rows)
