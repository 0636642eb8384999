"""Tables that a stream keeps batch by batch: changelogs, joined rows, mergeable aggregates, split rows.

Every micro-batch writes folders of its own, named by its number, and reads only those of earlier batches, so a
batch that is run again after a failure replaces what it wrote and changes nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from staylake.streaming import replay as rp


def _earlier(spark: SparkSession, path: str, schema: StructType, batch_id: int | None = None) -> DataFrame:
    """Rows of all batches, or of those before ``batch_id``; none where nothing was written yet."""
    try:
        rows = rp.versions(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema.simpleString()).withColumn("batch_id", F.lit(0).cast("bigint"))
    return rows if batch_id is None else rows.where(F.col("batch_id") < batch_id)


def _compacts(batch_id: int) -> bool:
    return (batch_id + 1) % rp.COMPACT_EVERY == 0


def _write(rows: DataFrame, path: str, batch_id: int, compacted: bool = False, compression: str | None = None) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}", compression=compression)
    if compacted:
        rp.drop_before(rows.sparkSession, path, batch_id - rp.COMPACT_EVERY)


# Changelogs -------------------------------------------------------------------------------------


def newest_change(changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last record of each key by ``order``, which differs within a key; rows without a key are left out."""
    values = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*values), order).alias("_row")
    return changes.dropna(subset=list(keys)).groupBy(*keys).agg(last).select(*keys, "_row.*").select(changes.columns)


def run_changelog(changes: DataFrame, keys: Sequence[str], order: str, path: str, checkpoint: str) -> None:
    """Keep the table that a stream of changes describes: a batch adds the newest record of each of its keys.

    A record whose values are all NULL takes its key away; it stays as a record, so that an older one which
    arrives later does not bring the key back.
    """
    schema = changes.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = newest_change(batch, keys, order)
        if _compacts(batch_id):
            older = _earlier(batch.sparkSession, path, schema, batch_id).drop("batch_id")
            rows = newest_change(older.unionByName(rows), keys, order)
        _write(rows, path, batch_id, _compacts(batch_id))

    rp.run_batches(changes, write, checkpoint)


def read_changelog(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: str) -> DataFrame:
    """The table as of the last batch."""
    values = [f.name for f in schema.fields if f.name not in (*keys, order)]
    rows = newest_change(_earlier(spark, path, schema).drop("batch_id"), keys, order)
    return rows.dropna(how="all", subset=values).drop(order)


def run_joined(
    stream: DataFrame, join: Callable[[DataFrame, DataFrame], DataFrame], table: Callable[[SparkSession], DataFrame], path: str, checkpoint: str
) -> None:
    """Rows joined to a table as it is when their batch runs.

    The join is one of two plain tables, so it is planned for their sizes and a hot key is split, without
    repeating the table. ``table`` is read anew in every batch.
    """
    rp.run_batches(stream, lambda batch, batch_id: _write(join(batch, table(batch.sparkSession)), path, batch_id), checkpoint)


def read_joined(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _earlier(spark, path, schema).drop("batch_id")


# Aggregates -------------------------------------------------------------------------------------


def run_merged(
    stream: DataFrame, keys: Sequence[str], partial: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StructType:
    """Keep an aggregate whose parts can be merged; returns its schema, for :func:`staylake.streaming.replay.read_latest`.

    A batch is aggregated by ``partial``, ``merge`` puts parts of the same keys together. A batch reads what is
    known of the keys it has and writes those alone, so a batch about few keys writes few rows.
    """
    schema = partial(stream).schema
    rp.run_batches(stream, lambda batch, batch_id: _merge(partial(batch), keys, merge, path, schema, batch_id), checkpoint)
    return schema


def _merge(part: DataFrame, keys, merge, path: str, schema: StructType, batch_id: int) -> None:
    part = part.persist()
    try:
        older = rp.newest(_earlier(part.sparkSession, path, schema, batch_id), schema, keys)
        if not _compacts(batch_id):
            older = older.join(part.select(*keys), list(keys), "left_semi")
        _write(merge(older.unionByName(part)).select(schema.fieldNames()), path, batch_id, _compacts(batch_id))
    finally:
        part.unpersist()


# Windows with late rows -------------------------------------------------------------------------


def run_windows(stream: DataFrame, keys: Sequence[str], out: str, size: str, hop: str | None, delay: str, path: str, checkpoint: str) -> StructType:
    """Count rows per key and window under a watermark; rows for closed windows go to a side table.

    The watermark of a batch is the latest ``ts`` of the batches before, in whole milliseconds, less ``delay``; a
    window that ends there or earlier is closed. Rows without a key or a time are left out. ``path`` holds
    ``counts``, ``late`` and ``clock``.
    """
    counted = [*keys, "start", "end"]

    def opened(rows: DataFrame) -> DataFrame:
        window = F.window("ts", size, hop).alias("_w")
        return rows.dropna(subset=[*keys, "ts"]).select("*", window).select("*", F.col("_w.start").alias("start"), F.col("_w.end").alias("end")).drop("_w")

    def counts(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*counted).agg(F.count(F.lit(1)).alias(out))

    schema = counts(opened(stream)).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bound = watermark(spark, path, delay, batch_id)
        rows = opened(batch)
        closed = F.lit(False) if bound is None else F.unix_micros("end") <= bound
        _write(rows.where(closed), f"{path}/late", batch_id)
        merge = lambda parts: parts.groupBy(*counted).agg(F.sum(out).alias(out))
        _merge(counts(rows.where(~closed)), counted, merge, f"{path}/counts", schema, batch_id)
        _write(batch.agg((F.floor(F.unix_micros(F.max("ts")) / 1000) * 1000).alias("latest")), f"{path}/clock", batch_id)

    rp.run_batches(stream, write, checkpoint)
    return schema


def watermark(spark: SparkSession, path: str, delay: str, batch_id: int | None = None) -> int | None:
    """Microseconds up to which windows are closed after all batches, or before ``batch_id``."""
    schema = StructType().add("latest", "long")
    back = F.unix_micros(F.timestamp_micros(F.max("latest")) - F.expr(f"interval {delay}"))
    return _earlier(spark, f"{path}/clock", schema, batch_id).agg(back).first()[0]


def read_closed(spark: SparkSession, path: str, schema: StructType, delay: str) -> DataFrame:
    """Windows that no later batch changes, each once."""
    keys = [f for f in schema.fieldNames()[:-1]]
    rows = rp.newest(_earlier(spark, f"{path}/counts", schema), schema, keys)
    bound = watermark(spark, path, delay)
    return rows.where(F.lit(False) if bound is None else F.unix_micros("end") <= bound)


# Messages ---------------------------------------------------------------------------------------


def run_split(stream: DataFrame, parse: Callable[[DataFrame], DataFrame], readable, good, rejected, path: str, checkpoint: str) -> None:
    """Each batch goes to two folders: what is ``readable`` once parsed by ``parse``, and the rest.

    ``good`` and ``rejected`` make the rows to be written from the parsed ones. Both sinks parse the batch's files:
    parsed rows are several times the stored messages, and keeping them for the second sink would put a copy of
    a large batch on the executors' disks.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse(batch)
        _write(good(parsed.where(readable)), f"{path}/good", batch_id, False, "zstd")
        _write(rejected(parsed.where(~readable)), f"{path}/rejected", batch_id, False, "zstd")

    rp.run_batches(stream, write, checkpoint)
