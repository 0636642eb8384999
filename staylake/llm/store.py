"""Cutting lineage: tables written to the folder all executors share, and connected components."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.session import scratch_dir

#: Links that make a hub at least, and how many hubs there can be about.
HUB, HUBS = 1 << 20, 1000


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: later steps do not recompute it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """As :func:`stored`, in buckets of ``key``, so that grouping by it later needs no shuffle of the table.

    The catalog knows the table only until it is read here; its files stay in the shared folder.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_dir(spark, label)
    name = os.path.basename(path).replace("-", "_")
    df.write.option("path", path).bucketBy(buckets, key).saveAsTable(name)
    kept = spark.table(name)
    kept.schema  # resolved, with its buckets
    spark.sql(f"DROP TABLE {name}")
    return kept


def partitions_for(texts: DataFrame, text_col: str, each: int) -> int:
    """Partitions of about ``each`` bytes of text, which are measured; at least the session's shuffle partitions."""
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = texts.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0
    return max(least, -(-size // each))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for ``edges`` of columns ``a`` and ``b``.

    Large-star and small-star in turn: every node links its larger neighbours, then its smaller ones, to
    the smallest it knows. Rounds grow with the logarithm of the longest path. A node with very many links,
    more than a thousandth of all, is a hub; as there are few of them, what they know is sent to their links, so no
    task gets all links of one node.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, state = _counted(links)
    while True:
        hub = max(HUB, state[0] // HUBS)
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("a", "m"))
        large = _told(both.where("b > a"), least, hub, state[0]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = _told(large, least, hub, state[0]).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        before = state
        pairs, state = _counted(small.where("a <> b").distinct())
        if state == before:
            roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _counted(links: DataFrame) -> tuple[DataFrame, tuple]:
    """``links`` stored, and their number with a digest of the set they form."""
    kept = stored(links, "links")
    digest = kept.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.hash("b", "a").cast("long")).alias("s"))
    return kept, tuple(digest.first())


def _told(links: DataFrame, least: DataFrame, hub: int, total: int) -> DataFrame:
    """``links`` with what ``least`` knows of ``a``. At most ``2 * HUBS`` nodes have more than ``hub`` links, and none
    if there are no more links than that in ``total``."""
    if total <= hub:
        return links.join(least.select("a", "m"), "a")
    hubs = least.where(F.col("n") > hub).select("a", "m")
    usual = least.where(F.col("n") <= hub).select("a", "m")
    others = links.join(F.broadcast(hubs.select("a")), "a", "left_anti")
    return links.join(F.broadcast(hubs), "a").union(others.join(usual, "a"))
