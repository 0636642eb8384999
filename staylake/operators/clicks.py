"""Clickstream views. Each takes a batch or a streaming table and works on both.

``EVENT_TS`` is epoch milliseconds of the window start, and of the last event for sessions.
Rows with a NULL group key belong to no group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: status codes above this one are errors.
ERROR_STATUS = 400


def _known(users: DataFrame) -> DataFrame:
    return users.select(F.col("user_id").alias("userid"), "username", "city")


def stream_salts(users: DataFrame) -> int:
    """Tasks among which a streaming join divides one user's clicks: all tasks of a state, or one where
    the planner knows the users to be small enough to be broadcast."""
    conf = users.sparkSession.conf
    limit = int(users.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    size = int(str(users._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return 1 if size <= limit else int(conf.get("spark.sql.shuffle.partitions"))


def user_clickstream(clicks: DataFrame, users: DataFrame, salts: int | None = None) -> DataFrame:
    """Clicks with user name and city where the user is known.

    ``salts`` spreads each user's clicks over that many tasks and repeats the user table as often.
    AQE splits a hot user of a batch table by itself; a stream has no AQE, so it is salted unless
    told otherwise.
    """
    salts = salts or (stream_salts(users) if clicks.isStreaming else 1)
    known, on = _known(users), ["userid"]
    if salts > 1:
        known = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        clicks = clicks.withColumn("_salt", F.pmod(F.hash("ts", "ip", "request"), F.lit(salts)))
        on = ["userid", "_salt"]
    return clicks.join(known, on, "left").select(
        "userid", "username", "ip", "city", "request", "status", "bytes", "ts"
    )


def enriched_error_codes(clicks: DataFrame, codes: DataFrame) -> DataFrame:
    """Code and definition of each click's status; both NULL for an unlisted status."""
    return clicks.join(codes, clicks["status"] == codes["code"], "left").select("code", "definition", "ts")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def _late(df: DataFrame, watermark: str | None) -> DataFrame:
    return df.withWatermark("ts", watermark) if watermark else df


def windowed_count(
    df: DataFrame,
    keys: Sequence[str],
    out: str,
    size: str,
    hop: str | None = None,
    more_than: int | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Rows per key and window; ``hop`` makes windows overlap, ``more_than`` hides small groups."""
    counted = (
        drop_null_keys(_late(df, watermark), keys)
        .groupBy(*keys, F.window("ts", size, hop).alias("_w"))
        .agg(F.count(F.lit(1)).alias(out))
    )
    if more_than is not None:
        counted = counted.where(F.col(out) > more_than)
    return counted.select(*keys, F.unix_millis("_w.start").alias("EVENT_TS"), out)


def events_per_min(clicks, size="60 seconds", watermark=None) -> DataFrame:
    return windowed_count(clicks, ["userid"], "events", size, watermark=watermark)


def pages_per_min(clicks, size="60 seconds", hop="5 seconds", watermark=None) -> DataFrame:
    pages = clicks.where(F.col("request").like("%html%"))
    return windowed_count(pages, ["userid"], "pages", size, hop, watermark=watermark)


def errors_per_min_alert(clicks, size="60 seconds", hop="20 seconds", more_than=5, watermark=None) -> DataFrame:
    errors = clicks.where(F.col("status") > ERROR_STATUS)
    return windowed_count(errors, ["status"], "errors", size, hop, more_than, watermark)


def errors_per_min(clicks, size="60 seconds", hop="5 seconds", watermark=None) -> DataFrame:
    errors = clicks.where(F.col("status") > ERROR_STATUS)
    return windowed_count(errors, ["status"], "errors", size, hop, watermark=watermark)


def enriched_error_codes_count(clicks, codes, size="30 seconds", more_than=1, watermark=None) -> DataFrame:
    enriched = enriched_error_codes(_late(clicks, watermark), codes)
    return windowed_count(enriched, ["code", "definition"], "count", size, more_than=more_than)


def user_ip_activity(clicks, users, size="60 seconds", more_than=1, watermark=None) -> DataFrame:
    """Clicks per user name, address, city and window.

    On a batch table clicks are counted per user id first, so the user table meets counts, not
    clicks; user ids that share a name are added up afterwards.
    """
    keys = ["username", "ip", "city"]
    if clicks.isStreaming:
        enriched = user_clickstream(_late(clicks, watermark), users)
        return windowed_count(enriched, keys, "count", size, more_than=more_than)
    counted = windowed_count(clicks, ["userid", "ip"], "_clicks", size)
    named = counted.join(_known(users), "userid").groupBy(*keys, "EVENT_TS").agg(F.sum("_clicks").alias("count"))
    return drop_null_keys(named.where(F.col("count") > more_than), keys).select(*keys, "EVENT_TS", "count")


# Sessions ---------------------------------------------------------------------------------------


def _gap_seconds(gap: str) -> float:
    number, unit = gap.split()
    factor = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return float(number) * factor[unit.rstrip("s")]


def _single_events(df: DataFrame) -> DataFrame:
    """Every click as a session of one event."""
    one = {"events": F.lit(1).cast("bigint"), "first_ts": F.col("ts"), "last_ts": F.col("ts")}
    return df.withColumns(one)


def _closed(rows: DataFrame, keys: Sequence[str], window: Column) -> DataFrame:
    measures = [
        F.sum("events").alias("events"),
        F.sum("bytes").alias("bytes"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    ]
    return rows.groupBy(*keys, window.alias("_w")).agg(*measures).drop("_w")


def session_pieces(clicks: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """Clicks of each key and stretch of one gap as one piece.

    Two clicks of a stretch are less than a gap apart, so they share a session. The aggregate is an
    ordinary one: every task merges its clicks before the exchange, also those of a hot user.
    """
    length = int(_gap_seconds(gap) * 1_000_000)
    cut = drop_null_keys(clicks, keys).withColumn("_piece", F.floor(F.unix_micros("ts") / F.lit(length)))
    return cut.groupBy(*keys, "_piece").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("bytes").alias("bytes"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    ).drop("_piece")


def merge_sessions(pieces: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """Join pieces at most one gap apart; a piece reaches from its first event to a gap after its last.

    A key has at most one piece per gap of its time line here, however many clicks it has.
    """
    reach = F.expr(
        "make_interval(0, 0, 0, 0, 0, 0, cast((unix_micros(last_ts) - unix_micros(first_ts)) / 1000000 "
        f"+ {_gap_seconds(gap)} as decimal(18, 6)))"
    )
    return _closed(drop_null_keys(pieces, keys), keys, F.session_window("first_ts", reach))


def user_sessions(clicks, users, keys: Sequence[str], gap: str, watermark: str | None = None) -> DataFrame:
    """Sessions per user name (and further click columns), closed by ``gap`` of inactivity.

    Events exactly one gap apart share a session. On a batch table clicks are merged per user id and
    stretch of one gap before the user table is joined, and the pieces merged to sessions per name. A streaming table
    keeps its sessions as state, per key.
    """
    if clicks.isStreaming:
        rows = drop_null_keys(user_clickstream(_late(clicks, watermark), users), keys)
        return _closed(_single_events(rows), keys, F.session_window("ts", gap))
    own = ["userid", *[k for k in keys if k != "username"]]
    pieces = session_pieces(clicks, own, gap).join(_known(users), "userid")
    return merge_sessions(pieces, keys, gap)


def click_user_sessions(clicks, users, gap="30 seconds", watermark=None) -> DataFrame:
    """Events of each user's sessions."""
    closed = user_sessions(clicks, users, ["username"], gap, watermark)
    return closed.select("username", F.unix_millis("last_ts").alias("EVENT_TS"), "events")


def user_session_kbytes(clicks, users, gap="30 seconds", more_than=0.0, watermark=None) -> DataFrame:
    """Kilobytes of each user's and address's sessions above a threshold."""
    closed = user_sessions(clicks, users, ["username", "ip"], gap, watermark)
    kbytes = (F.col("bytes") / F.lit(1024.0)).alias("kbytes")
    return closed.select("username", "ip", F.unix_millis("last_ts").alias("EVENT_TS"), kbytes).where(
        F.col("kbytes") > more_than
    )
