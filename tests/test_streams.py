"""Streams that get their input in parts, restart, and meet late rows."""

import json
import os

from pyspark.sql import functions as F

from staylake.functions.stay import CATEGORIES_AS_CODED
from staylake.operators import clicks, stays
from staylake.session import scratch_dir
from staylake.sources import messages, readers
from staylake.streaming import replay as rp

SCHEMA = "userid long, ts timestamp, request string, status int, ip string, bytes long"


def put(spark, path, rows):
    df = spark.createDataFrame([(u, ms, "a.html", 404, "x", 1) for u, ms in rows], "userid long, ms long, request string, status int, ip string, bytes long")
    df.withColumn("ts", F.timestamp_millis("ms")).drop("ms").coalesce(1).write.mode("append").parquet(path)


def run_updates(spark, source, base, watermark):
    session = rp.stream_session(spark, 2)
    stream = clicks.events_per_min(readers.stream_table(session, source, "parquet", SCHEMA), watermark=watermark)
    rp.run_versions(stream, "update", f"{base}/table", f"{base}/checkpoint", ["userid", "EVENT_TS"])
    rows = rp.read_latest(spark, f"{base}/table", stream.schema, ["userid", "EVENT_TS"]).collect()
    return {(r.userid, r.EVENT_TS): r.events for r in rows}


def test_updates_across_restarts(spark):
    base = scratch_dir(spark, "updates")
    put(spark, f"{base}/in", [(1, 1_000), (1, 2_000), (2, 61_000)])
    assert run_updates(spark, f"{base}/in", base, None) == {(1, 0): 2, (2, 60_000): 1}
    put(spark, f"{base}/in", [(1, 3_000)])
    assert run_updates(spark, f"{base}/in", base, None) == {(1, 0): 3, (2, 60_000): 1}
    assert run_updates(spark, f"{base}/in", base, None) == {(1, 0): 3, (2, 60_000): 1}


def test_late_rows_count_only_without_a_watermark(spark):
    for watermark, first in ((None, 2), ("1 minute", 1)):
        base = scratch_dir(spark, "late")
        for rows in ([(1, 1_000)], [(1, 3_600_000)], [(1, 2_000)]):
            put(spark, f"{base}/in", rows)
            got = run_updates(spark, f"{base}/in", base, watermark)
        assert got[1, 0] == first


def test_append_adds_nothing_twice(spark):
    base = scratch_dir(spark, "append")
    session = rp.stream_session(spark, 2)
    for rows in ([(1, 1)], [], [(2, 2), (3, 3)]):
        if rows:
            put(spark, f"{base}/in", rows)
        stream = readers.stream_table(session, f"{base}/in", "parquet", SCHEMA, max_files=1)
        rp.run_append(stream, f"{base}/out", f"{base}/checkpoint")
    assert sorted(r.userid for r in spark.read.parquet(f"{base}/out").collect()) == [1, 2, 3]


def folders(spark, path):
    return [f for f in os.listdir(path) if f.startswith("batch_id=")]


def test_kept_folders_stay_bounded(spark, monkeypatch):
    """Many batches of updates and of full refreshes; the tables stay whole."""
    monkeypatch.setattr(rp, "COMPACT_EVERY", 3)
    base = scratch_dir(spark, "bounded")
    for k in range(11):
        put(spark, f"{base}/in", [(k % 4, 1_000 + k), (9, 60_000 * k)])
    session = rp.stream_session(spark, 2)
    source = lambda: readers.stream_table(session, f"{base}/in", "parquet", SCHEMA, max_files=1)
    keys = ["userid", "EVENT_TS"]
    updates = clicks.events_per_min(source())
    rp.run_versions(updates, "update", f"{base}/updates", f"{base}/checkpoint-u", keys)
    rp.run_versions(clicks.events_per_min(source()), "complete", f"{base}/complete", f"{base}/checkpoint-c")
    assert 1 <= len(folders(spark, f"{base}/updates")) <= 6 and len(folders(spark, f"{base}/complete")) == rp.REFRESHES
    want = {(r.userid, r.EVENT_TS): r.events for r in clicks.events_per_min(spark.read.schema(SCHEMA).parquet(f"{base}/in")).collect()}
    for table in (rp.read_latest(spark, f"{base}/updates", updates.schema, keys), rp.read_complete(spark, f"{base}/complete", updates.schema)):
        assert {(r.userid, r.EVENT_TS): r.events for r in table.collect()} == want


def test_append_under_a_watermark_writes_each_window_and_session_once(spark):
    """Several batches, a late row and a restart; what the watermark has closed is there, once."""
    base = scratch_dir(spark, "closed")
    views = {
        "windows": lambda c, u: clicks.events_per_min(c, watermark="1 minute"),
        "sessions": lambda c, u: clicks.click_user_sessions(c, u, gap="30 seconds", watermark="1 minute"),
    }
    users = spark.createDataFrame([(1, "ann", "x")], "user_id long, username string, city string")
    out = {}
    for rows in ([(1, 1_000), (1, 20_000)], [(1, 200_000)], [(1, 5_000)], [(1, 210_000), (1, 900_000)]):
        put(spark, f"{base}/in", rows)
        for name, view in views.items():
            session = rp.stream_session(spark, 2)
            stream = view(readers.stream_table(session, f"{base}/in", "parquet", SCHEMA), users)
            rp.run_append(stream, f"{base}/{name}", f"{base}/checkpoint-{name}")
            out[name] = sorted((r.EVENT_TS, r.events) for r in spark.read.schema(stream.schema).parquet(f"{base}/{name}").collect())
    assert out == {"windows": [(0, 2), (180_000, 2)], "sessions": [(20_000, 2), (210_000, 2)]}


def test_source_takes_one_cap(spark):
    try:
        readers.stream_table(spark, "/nowhere", "parquet", SCHEMA, max_files=1, max_bytes="1m")
    except ValueError:
        return
    raise AssertionError("two caps were accepted")


def test_messages_keep_numbers_and_nulls(spark):
    incoming = [
        '{"id": 1, "hotel_id": 7, "srch_ci": "2017-08-01", "srch_co": "2017-08-03", "price": 1.5}',
        '{"id": 2, "hotel_id": 7, "srch_co": "2017-08-03", "price": null}',
        '{"id": 3, "hotel_id": 7, "srch_ci": null, "srch_co": "2017-08-03"}',
        '{"id": 4, "hotel_id": ',
        "not json",
        "",
    ]
    df = spark.createDataFrame([(m,) for m in incoming] + [(None,)], "value string")
    schema = spark.createDataFrame([], "id long, hotel_id long, srch_ci string, srch_co string, price double").schema
    good = stays.categorise(messages.decode_rows(df, schema), CATEGORIES_AS_CODED)
    out = {m["id"]: m for m in (json.loads(r.value) for r in messages.encode_rows(good).collect())}
    assert out[1] == {
        "id": 1, "hotel_id": 7, "srch_ci": "2017-08-01", "srch_co": "2017-08-03", "price": 1.5, "category": "Short stay",
    }
    assert out[2]["category"] == out[3]["category"] == "Erroneous data"
    assert out[2]["srch_ci"] is None and "srch_ci" in out[2]
    rejected = [r.value for r in messages.rejected_rows(df, schema).collect()]
    assert sorted(rejected, key=str) == sorted([*incoming[3:], None], key=str)
