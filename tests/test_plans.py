"""What the physical plans must and must not hold."""

import contextlib
import io

import pytest

from staylake.operators import clicks, marts, places, stays
from staylake.plans import views
from staylake.plans.registry import QUERIES

# These run something while they are built, or fit a model.
EAGER = {n for n in QUERIES if n.endswith("_stream") or n.startswith(("src_", "sink_partitioned", "stream_", "roll_"))} | {
    "copy_one_day_per_cycle", "ctas_mart", "catalog_table", "json_decode_rows", "json_reject_rows", "city_series",
    "city_series_first", "medallion_city_day", "rf_baseline", "feature_importance", "tuned_sweep", "batch_score", "score_udf", "stored_model_scores",
}


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in EAGER])
def test_no_python_and_no_pairing_without_a_key(spark, sf, name, no_broadcast):
    text = plan(QUERIES[name](spark, sf))
    for word in ("Python", "ArrowEval", "CartesianProduct", "NestedLoop"):
        assert word not in text
    # A bare single-partition exchange may only follow a limit or an already aggregated row.
    assert text.count("Exchange SinglePartition") <= (name == "null_profile")


@pytest.mark.parametrize("name", ["top10_temp_range", "top10_obs_month", "top10_busy_ref", "topn_by_selfjoin"])
def test_rankings_keep_ten_rows_before_the_exchange(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert text.count("WindowGroupLimit") == 2


def test_scan_reads_only_what_is_needed(spark, sf):
    text = plan(marts.month_summary(views.hotel_weather(spark, sf)), "formatted")
    scan = next(line for line in text.splitlines() if "l_extendedprice" in line and "ReadSchema" in line)
    assert scan.split("ReadSchema: ")[1] == "struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>"


def test_small_tables_are_broadcast_beside_the_large_one(spark, sf):
    """The planner must not take the observations, or a join of unknown size, for the small side."""
    text = plan(marts.temp_range_month(views.hotel_weather(spark, sf)))
    assert text.count("BroadcastHashJoin") == text.count("BuildRight") == 3
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_scan(spark, sf):
    text = plan(views.table(spark, sf, "embeddings").where("label >= 7"), "formatted")
    assert "GreaterThanOrEqual(label,7)" in text


def test_clicks_are_counted_before_users_join(spark, sf, no_broadcast):
    people = views.web_users(spark, sf)
    for view in (clicks.user_ip_activity, clicks.click_user_sessions):
        lines = plan(view(views.click(spark, sf), people)).splitlines()
        join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "userid" in line)
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "events.parquet" in line)
        assert any("Aggregate" in line for line in lines[join:scan])


def test_sessions_merge_clicks_before_the_first_exchange(spark, sf, no_broadcast):
    """Clicks of a user and stretch are one row a task; no session merge sees raw clicks."""
    people = views.web_users(spark, sf)
    for view in (clicks.click_user_sessions, clicks.user_session_kbytes):
        lines = plan(view(views.click(spark, sf), people)).splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "events.parquet" in line)
        exchange = max(i for i, line in enumerate(lines[:scan]) if "Exchange" in line)
        assert any("HashAggregate" in line and "_piece" in line for line in lines[exchange:scan])
        assert all(i < exchange for i, line in enumerate(lines) if "MergingSessions" in line)


def test_the_left_join_never_broadcasts_the_weather(spark, sf):
    lines = plan(QUERIES["join_geohash_left"](spark, sf)).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = [x for x in lines[i + 1 :]]
            end = next((k for k, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            scans = [x for x in below[:end] if "FileScan" in x and "lineitem" in x]
            assert not scans or any("Aggregate" in x for x in below[:end])  # at most its distinct cells


def test_stay_joins_use_day_or_month_beside_the_hotel(spark, sf, no_broadcast):
    daily = stays.hotel_daily(views.hotel_weather(spark, sf))
    for job in (stays.stay_trend_as_stated, stays.stay_trend_as_coded, stays.stay_edges, stays.visit_weather_full):
        joins = [line for line in plan(job(views.visit(spark, sf), daily)).splitlines() if "SortMergeJoin" in line]
        own = [line for line in joins if "hotel_id" in line]
        assert own and all("_day" in line or "_month" in line for line in own)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_aqe_splits_a_hot_cell(spark, no_broadcast, how):
    """A third of the weather rows lie in one cell; its partition is read by several tasks."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        weather = spark.range(200_000).selectExpr(
            "if(id % 3 = 0, 'hot0', concat('c', id % 997)) Geohash", "xxhash64(id) avg_tmpr_c", "'2017-08-01' wthr_date"
        ).repartition(12)
        hotels = spark.range(1000).selectExpr("if(id = 0, 'hot0', concat('c', id % 997)) Geohash", "id Id")
        joined = places.join_on_cell(hotels, weather, how)
        rows = joined.collect()
        assert "skew=true" in plan(joined)
        assert len(rows) == hotels.join(weather, "Geohash", how).count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name, unit", [("visit_weather_full", "day"), ("stay_trend_spec", "month")])
def test_daily_weather_meets_stays_without_a_second_shuffle(spark, sf, no_broadcast, name, unit):
    job = {"visit_weather_full": stays.visit_weather_full, "stay_trend_spec": stays.stay_trend_as_stated}[name]
    daily = stays.hotel_daily(views.hotel_weather(spark, sf), per=unit)
    lines = plan(job(views.visit(spark, sf), daily)).splitlines()
    dealt = [line for line in lines if "Exchange hashpartitioning(hotel_id" in line and f"_{unit}" in line]
    assert len(dealt) == 2 and not any("Exchange hashpartitioning" in line and "wthr_date" in line for line in lines)
