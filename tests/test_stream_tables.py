"""Tables that streams keep: several batches, restarts in mid-batch, late rows, tombstones, sketches."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylake.operators import clicks, marts, stays
from staylake.functions import stay
from staylake.session import scratch_dir
from staylake.sources import messages, readers
from staylake.streaming import medallion as medal
from staylake.streaming import replay as rp
from staylake.streaming import sessions, tables

CLICKS = "username string, at long, bytes long"


def arrive(spark, path, rows, schema=CLICKS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def source(spark, path, schema, fmt="parquet"):
    return readers.stream_table(rp.stream_session(spark, 2), path, fmt, schema)


# Sessions ---------------------------------------------------------------------------------------


def run_sessions(spark, base, watermark=None):
    stream = source(spark, f"{base}/in", CLICKS).withColumn("ts", F.timestamp_millis("at"))
    changes = sessions.session_changes(stream, ["username"], 30, watermark)
    rp.run_versions(changes, "update", f"{base}/table", f"{base}/checkpoint", ["username", "session"])
    return changes.schema


def test_a_batch_writes_only_the_sessions_it_touches(spark):
    base = scratch_dir(spark, "touched")
    batches = [
        [("a", 0, 1), ("a", 10_000, 2), ("b", 0, 4), (None, 0, 1)],
        [("a", 100_000, None)],
        [("a", 40_000, 8), ("a", 70_000, 16)],  # each exactly a gap from the next: all of a is one session
        [("c", 5_000, None)],
    ]
    folders = []
    for rows in batches:
        arrive(spark, f"{base}/in", rows)
        schema = run_sessions(spark, base)
        written = rp.versions(spark, f"{base}/table", schema).collect()
        last = max(r.batch_id for r in written)
        folders.append(sorted((r.username, r.session, r.events, r.gone) for r in written if r.batch_id == last))
    assert folders == [[("a", 0, 2, False), ("b", 0, 1, False)], [("a", 1, 1, False)], [("a", 0, 5, False), ("a", 1, None, True)], [("c", 0, 1, False)]]
    table = rp.read_latest(spark, f"{base}/table", schema, ["username", "session"]).where("not gone").collect()
    assert sorted((r.username, r["first"], r["last"], r.events, r.bytes) for r in table) == [
        ("a", 0, 100_000_000, 5, 27), ("b", 0, 0, 1, 4), ("c", 5_000_000, 5_000_000, 1, None),
    ]


def test_sessions_under_a_watermark_are_closed_once(spark):
    base = scratch_dir(spark, "closed-sessions")
    for rows in ([("a", 1_000, 1), ("a", 20_000, 1)], [("b", 200_000, 1)], [("a", 5_000, 1)], [("b", 210_000, 1), ("b", 900_000, 1)]):
        arrive(spark, f"{base}/in", rows)
        schema = run_sessions(spark, base, "1 minute")
    closed = rp.versions(spark, f"{base}/table", schema).where("closed").collect()
    assert sorted((r.username, r["last"] // 1000, r.events) for r in closed) == [("a", 20_000, 2), ("b", 210_000, 2)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 9)), max_size=6), max_size=6))
def test_merging_batches_equals_all_at_once(batches):
    open_, number, table = [], 0, {}
    for batch in batches:
        pieces = [(None, at, at, 1, size) for at, size in batch]
        before = dict(table)
        open_, changed, gone, number = sessions.merged(open_, pieces, 3, number)
        table.update({s[0]: s[1:] for s in changed})
        for n in gone:
            table.pop(n, None)
        assert {s[0]: s[1:] for s in open_} == table
        assert all(before.get(s[0]) != s[1:] for s in changed)
    want, events = [], sorted(e for batch in batches for e in batch)
    for at, size in events:
        if want and at - want[-1][1] <= 3:
            first, _, n, total = want[-1]
            want[-1] = (first, at, n + 1, total + size)
        else:
            want.append((at, at, 1, size))
    assert sorted(table.values()) == want


# Changelogs and joins ---------------------------------------------------------------------------

USERS = "user_id long, offset long, username string, city string"


def test_changelog_and_join(spark, monkeypatch):
    """Changes out of order, a tombstone, a key that comes back, compaction, and clicks of every state."""
    monkeypatch.setattr(rp, "COMPACT_EVERY", 2)
    base, plans, latest, named = scratch_dir(spark, "changing"), [], {}, []
    versions = [
        [(1, 1, "ann", "x"), (2, 2, "bob", "y"), (None, 3, "no", "z")],
        [(1, 12, "ann", "v"), (1, 11, "ann", "w"), (2, 13, None, None)],
        [(2, 5, "old", "y"), (3, 20, "cat", None)],
        [(2, 30, "bob", "u")],
        [(3, 31, None, None)],
    ]

    def join(batch, users):
        out = clicks.user_clickstream(batch, users)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    schema = spark.createDataFrame([], USERS).schema
    click = "userid long, ip string, request string, status int, bytes long, ts timestamp"
    for rows in versions:
        arrive(spark, f"{base}/topic", rows, USERS)
        tables.run_changelog(source(spark, f"{base}/topic", schema), ["user_id"], "offset", f"{base}/users", f"{base}/c1")
        spark.range(1, 4).selectExpr("id AS userid", "'i' AS ip", "'r' AS request", "200 AS status", "1L AS bytes", "timestamp_seconds(0) AS ts").write.mode(
            "append"
        ).parquet(f"{base}/clicks")
        table = lambda s: tables.read_changelog(s, f"{base}/users", schema, ["user_id"], "offset")
        tables.run_joined(source(spark, f"{base}/clicks", click), join, table, f"{base}/named", f"{base}/c2")
        for user, offset, *values in sorted(rows, key=lambda r: r[1]):
            if user is not None and offset > latest.get(user, (0,))[0]:
                latest[user] = (offset, *values)
        named += [(u, *latest.get(u, (0, None, None))[1:]) for u in (1, 2, 3)]
    out = tables.read_joined(spark, f"{base}/named", clicks.user_clickstream(spark.createDataFrame([], click), spark.createDataFrame([], USERS)).schema)
    assert sorted((r.userid, str(r.username), str(r.city)) for r in out.collect()) == sorted((u, str(n), str(c)) for u, n, c in named)
    assert sorted(table(spark).collect()) == [(1, "ann", "v"), (2, "bob", "u")]
    assert not any("Generate" in p or "explode" in p for p in plans)


# Windows with late rows -------------------------------------------------------------------------


def test_late_rows_go_to_a_side_table(spark):
    base, rng = scratch_dir(spark, "late-rows"), random.Random(4)
    batches = [[(rng.choice("ab"), t + rng.randint(-100_000, 0), 1) for t in range(0, 600_000, 60_000)] for _ in range(2)]
    batches = [batches[0][:5], batches[1][:7] + [(None, 0, 1)], batches[0][5:], batches[1][7:] + [("a", None, 1)]]
    counts, late, bound = {}, [], None
    for rows in batches:
        arrive(spark, f"{base}/in", rows)
        stream = source(spark, f"{base}/in", CLICKS).withColumn("ts", F.timestamp_millis("at"))
        schema = tables.run_windows(stream, ["username"], "n", "60 seconds", "20 seconds", "90 seconds", f"{base}/w", f"{base}/checkpoint")
        for name, at, _ in rows:
            if name is None or at is None:
                continue
            for start in range(at // 20_000 * 20_000 - 40_000, at + 1, 20_000):
                if bound is not None and start + 60_000 <= bound:
                    late.append((name, at, start))
                else:
                    counts[name, start] = counts.get((name, start), 0) + 1
        bound = max([bound or -(10**9)] + [at - 90_000 for _, at, _ in rows if at is not None])
    closed = tables.read_closed(spark, f"{base}/w", schema, "90 seconds").collect()
    ms = lambda t: round(t.timestamp() * 1000)
    assert {(r.username, ms(r.start)): r.n for r in closed} == {k: n for k, n in counts.items() if k[1] + 60_000 <= bound}
    rows = tables.read_joined(spark, f"{base}/w/late", stream.schema.add("start", "timestamp").add("end", "timestamp")).collect()
    assert sorted((r.username, r["at"], ms(r.start)) for r in rows) == sorted(late) and late


# Messages ---------------------------------------------------------------------------------------


def test_two_sinks_survive_a_failure_between_them(spark, monkeypatch):
    base = scratch_dir(spark, "two-sinks")
    schema = spark.createDataFrame([], "id long, hotel_id long, srch_ci string, srch_co string").schema
    good = [f'{{"id": {i}, "hotel_id": 7, "srch_ci": "2017-08-01", "srch_co": "2017-08-0{i}"}}' for i in (2, 3)]
    bad = ['{"id": 4, "hotel', "no", ""]

    def run():
        tables.run_split(
            source(spark, f"{base}/in", "value string"), lambda b: messages.parsed(b, schema), messages.readable(),
            lambda rows: messages.encode_rows(stays.categorise(messages.fields(rows, schema), stay.CATEGORIES_AS_CODED)),
            messages.unreadable, f"{base}/out", f"{base}/checkpoint",
        )

    arrive(spark, f"{base}/in", [(m,) for m in good[:1] + bad], "value string")
    run()
    arrive(spark, f"{base}/in", [(good[1],), (None,)], "value string")
    write = tables._write

    def fails(rows, path, *rest):
        if path.endswith("rejected"):
            raise OSError("disk")
        write(rows, path, *rest)

    monkeypatch.setattr(tables, "_write", fails)
    with pytest.raises(Exception, match="disk"):
        run()
    monkeypatch.setattr(tables, "_write", write)
    run()
    run()
    value = spark.createDataFrame([], "value string").schema
    out = messages.decode_rows(tables.read_joined(spark, f"{base}/out/good", value), schema.add("category", "string"))
    assert sorted((r.id, r.category) for r in out.collect()) == [(2, "Short stay"), (3, "Short stay")]
    rejected = [r.value for r in tables.read_joined(spark, f"{base}/out/rejected", value).collect()]
    assert sorted(rejected, key=str) == sorted([*bad, None], key=str)


# Gold -------------------------------------------------------------------------------------------


def test_gold_merges_sketches_of_touched_days(spark):
    """Estimates within four standard errors of the exact table, means alike, and no other day written."""
    base = scratch_dir(spark, "gold")
    silver = "id string, city string, wthr_date string, avg_tmpr_c double"
    days = ["2017-08-01", "2017-08-02", "2017-08-03"]
    rows = lambda low, high, on: [(f"h{i}", "x", d, i / 7) for i in range(low, high) for d in on]
    batches = [rows(0, 3000, days), rows(2000, 6000, days[1:2]), rows(0, 10, days[2:]) + [("h", "y", days[0], float("nan")), (None, "y", days[0], 1e21)]]
    for batch in batches:
        arrive(spark, f"{base}/in", batch, silver)
        schema = tables.run_merged(source(spark, f"{base}/in", silver), medal.GOLD_KEYS, medal.gold_parts, medal.merge_gold, f"{base}/gold", f"{base}/checkpoint")
    written = rp.versions(spark, f"{base}/gold", schema).groupBy("batch_id").agg(F.sort_array(F.collect_set("wthr_date")).alias("days")).collect()
    assert {r.batch_id: r.days for r in written} == {0: days, 1: days[1:2], 2: [days[0], days[2]]}
    got = medal.gold_table(rp.read_latest(spark, f"{base}/gold", schema, medal.GOLD_KEYS)).collect()
    want = {(r.city, r.wthr_date): r for r in marts.city_day(spark.read.schema(silver).parquet(f"{base}/in")).collect()}
    assert len(got) == len(want) == 4
    for r in got:
        exact = want[r.city, r.wthr_date]
        assert abs(r.distinct_hotels - exact.distinct_hotels) <= 4 * 0.013 * exact.distinct_hotels
        assert str((r.avg_t, r.max_t, r.min_t)) == str((exact.avg_t, exact.max_t, exact.min_t))


def test_split_messages_are_stored_once_and_never_kept_by_executors(spark, sf, monkeypatch):
    from staylake.plans import registry

    def refuse(self, *rest):
        raise AssertionError("a batch of parsed messages is kept")

    roots = {}
    monkeypatch.setattr(registry, "scratch_dir", lambda s, label: roots.setdefault(label, scratch_dir(s, label)))
    monkeypatch.setattr(type(spark.range(1)), "persist", refuse)
    registry.QUERIES["stay_category_stream"](spark, sf).collect()
    assert list(roots) == ["stay-category"]
    files = [f for f in spark.read.format("binaryFile").load(f"{roots['stay-category']}/in").select("path").toPandas()["path"]]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
