import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from staylake.operators import clicks, rollups

CLICK = "userid long, ms long, request string, status int, ip string, bytes long"


def click_table(spark, rows):
    df = spark.createDataFrame(rows, CLICK)
    return df.withColumn("ts", F.timestamp_millis("ms")).drop("ms")


def user_table(spark, rows):
    return spark.createDataFrame(rows, "user_id long, username string, city string")


def brute_sessions(events, gap_ms):
    """events: (key, ms, bytes) -> sorted (key, last ms, events, bytes)"""
    out, by_key = [], {}
    for key, ms, size in events:
        by_key.setdefault(key, []).append((ms, size))
    for key, items in by_key.items():
        items.sort()
        last, n, total = None, 0, 0
        for ms, size in items:
            if last is not None and ms - last > gap_ms:
                out.append((key, last, n, total))
                n, total = 0, 0
            last, n, total = ms, n + 1, total + size
        out.append((key, last, n, total))
    return sorted(out)


def test_gap_edges(spark):
    base = 1_700_000_000_000
    rows = [(1, base, "a", 200, "x", 1024), (1, base + 30_000, "a", 200, "x", 1024), (1, base + 60_001, "a", 200, "x", 512)]
    got = clicks.click_user_sessions(click_table(spark, rows), user_table(spark, [(1, "u", "c")])).collect()
    assert sorted((r.EVENT_TS - base, r.events) for r in got) == [(30_000, 2), (60_001, 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_against_brute_force(spark, seed):
    """Half the events belong to one user; two user ids share a name; one id is unknown."""
    rng = random.Random(seed)
    rows = [
        (rng.choice([1, 1, 1, 2, 3, 9, None]), rng.randrange(0, 20_000_000), "a", 200, rng.choice("xy"), rng.randrange(5000))
        for _ in range(1500)
    ]
    names = {1: "ann", 2: "ann", 3: "bob"}
    table = click_table(spark, rows)
    people = user_table(spark, [(k, v, "c") for k, v in names.items()])
    known = [r for r in rows if r[0] in names]

    got = clicks.click_user_sessions(table, people).collect()
    want = brute_sessions([(names[r[0]], r[1], r[5]) for r in known], 30_000)
    assert sorted((r.username, r.EVENT_TS, r.events) for r in got) == [w[:3] for w in want]

    got = clicks.user_session_kbytes(table, people, more_than=4.0).collect()
    want = brute_sessions([((names[r[0]], r[4]), r[1], r[5]) for r in known], 30_000)
    assert sorted((r.username, r.ip, r.EVENT_TS, r.kbytes) for r in got) == [
        (*k, ms, size / 1024) for k, ms, _, size in want if size / 1024 > 4.0
    ]


def test_hopping_window_edges(spark):
    minute = 60_000
    base = 1_700_000_040_000 // minute * minute
    rows = [(1, base + 5_000, "a.html", 200, "x", 1), (1, base + 5_000, "a.txt", 200, "x", 1)]
    got = clicks.pages_per_min(click_table(spark, rows)).collect()
    assert sorted(r.EVENT_TS - base for r in got) == list(range(-50_000, 5_001, 5_000))
    assert {r.pages for r in got} == {1}
    tumbling = clicks.events_per_min(click_table(spark, [(1, base, "", 200, "", 0), (1, base + minute, "", 200, "", 0)]))
    assert sorted(r.EVENT_TS - base for r in tumbling.collect()) == [0, minute]


def test_null_keys_unknown_codes_and_thresholds(spark):
    rows = [(None, 0, "a", 200, "x", 1)] * 3 + [(1, 0, "a", 405, "x", 1)] * 3 + [(1, 0, "a", 404, "x", 1)] * 6
    table = click_table(spark, rows)
    codes = spark.createDataFrame([(404, "Page not found")], "code int, definition string")
    assert [r.userid for r in clicks.events_per_min(table).collect()] == [1]
    assert [(r.code, r["count"]) for r in clicks.enriched_error_codes_count(table, codes).collect()] == [(404, 6)]
    assert clicks.enriched_error_codes(table, codes).where("code is null").count() == 6
    assert {r.status for r in clicks.errors_per_min_alert(table).collect()} == {404}
    people = user_table(spark, [(1, None, "c")])
    assert clicks.user_ip_activity(table, people).count() == 0
    assert clicks.click_user_sessions(table, people).count() == 0


def test_top_terms_are_nested(spark):
    rows = [(a, a * 100 + b, t) for a in range(15) for b in range(12) for t in (1, 70_000)]
    df = spark.createDataFrame(rows, "a int, b int, EVENT_TS long")
    got = rollups.time_rollup(df, F.count(F.lit(1)), "n", ["a", "b"], 60_000).collect()
    want = {(a, a * 100 + b, t) for a in range(5, 15) for b in range(2, 12) for t in (0, 60_000)}
    assert {(r.a, r.b, r.bucket) for r in got} == want
    assert {r.n for r in got} == {1}


def test_event_time_is_utc_in_any_session_zone(spark, sf):
    from staylake.plans import views

    zone = spark.conf.get("spark.sql.session.timeZone")
    first = views.click(spark, sf).agg(F.min("_time"), F.min("ts")).first()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        other = views.click(spark, sf).agg(F.min("_time"), F.min(F.unix_millis("ts"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert other[0] == other[1] == first[0]
    assert dt.datetime.fromtimestamp(first[0] / 1000, dt.UTC).year == 2024


def test_salted_join_changes_no_row(spark):
    rows = [(1, i * 1000, f"r{i % 7}", 200, f"10.0.0.{i % 5}", i) for i in range(200)]
    rows += [(2, 5, "a", 200, "x", 1), (2, 5, "a", 200, "x", 1), (9, 5, "a", 200, "x", 1), (None, 5, None, 200, None, 1)]
    table = click_table(spark, rows)
    people = user_table(spark, [(1, "ann", "c"), (2, "bob", "d"), (3, "cy", "e")])
    plain, salted = clicks.user_clickstream(table, people), clicks.user_clickstream(table, people, salts=6)
    assert salted.count() == len(rows)
    assert plain.exceptAll(salted).count() == 0


def test_empty_buckets_are_filled_between_the_first_and_the_last_of_a_term(spark):
    from staylake.operators import rollups

    rows = [("a", 1, 5), ("a", 41, 7), ("b", 25, 1), ("c", None, 3), (None, 3, 9)]
    df = spark.createDataFrame(rows, "k string, EVENT_TS long, v int")
    out = rollups.time_rollup(df, F.max("v"), "m", ["k"], 10, fill=True)
    got = sorted((r.k, r.bucket, r.m) for r in out.collect())
    assert got == [("a", 0, 5), ("a", 10, None), ("a", 20, None), ("a", 30, None), ("a", 40, 7), ("b", 20, 1)]
    assert rollups.time_rollup(df.limit(0), F.max("v"), "m", ["k"], 10, fill=True).collect() == []
    alone = rollups.time_rollup(df, F.max("v"), "m", (), 10, fill=True)
    assert sorted((r.bucket, r.m) for r in alone.collect()) == [(0, 9), (10, None), (20, 1), (30, None), (40, 7)]
