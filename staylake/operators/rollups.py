"""Rollups of the clickstream views: top terms, then a metric per time bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_terms(df: DataFrame, by: Sequence[str], terms: int = 10) -> DataFrame:
    """The ``terms`` highest values of the first column, of the second within each of those, ...

    Each level ranks distinct values only; at most ``terms ** len(by)`` rows remain.
    """
    values = df.select(*by).dropna().distinct()
    first = values.select(by[0]).distinct().orderBy(F.desc(by[0])).limit(terms)
    kept = F.broadcast(first)
    for depth in range(1, len(by)):
        outer, name = list(by[:depth]), by[depth]
        inner = values.join(kept, outer, "left_semi").select(*outer, name).distinct()
        ranked = Window.partitionBy(*outer).orderBy(F.desc(name))
        inner = inner.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= terms)
        kept = F.broadcast(inner.drop("_rank"))
    return kept


def time_rollup(
    df: DataFrame,
    metric: Column,
    out: str,
    by: Sequence[str] = (),
    bucket_ms: int | None = None,
    ts: str = "EVENT_TS",
    terms: int = 10,
    fill: bool = False,
) -> DataFrame:
    """``metric`` per top term and time bucket.

    Buckets without rows do not appear, unless ``fill`` asks for all from the first to the last of each kept term;
    their metric is NULL.
    """
    if by:
        df = df.join(top_terms(df, by, terms), list(by), "left_semi")
    keys = [F.col(c) for c in by]
    if bucket_ms:
        keys.append((F.floor(F.col(ts) / F.lit(bucket_ms)) * bucket_ms).alias("bucket"))
    rolled = df.groupBy(*keys).agg(metric.alias(out))
    return filled(rolled, by, bucket_ms) if fill and bucket_ms else rolled


def filled(rolled: DataFrame, by: Sequence[str], bucket_ms: int) -> DataFrame:
    """Each term's buckets from its first to its last, NULL where ``rolled`` has none."""
    ends = rolled.groupBy(*by).agg(F.min("bucket").alias("_low"), F.max("bucket").alias("_high")).dropna(subset=["_low"])
    every = F.explode(F.sequence("_low", "_high", F.lit(bucket_ms).cast("bigint"))).alias("bucket")
    return ends.select(*by, every).join(rolled, [*by, "bucket"], "left")
