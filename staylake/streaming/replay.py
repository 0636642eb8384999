"""Run a streaming table over the files that are there now and read back what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.session import scratch_dir

TIMEOUT_SECONDS = 24 * 3600

# Full refreshes that stay, so that a reader of the last but one is not cut off.
REFRESHES = 2
# Update batches between two compactions.
COMPACT_EVERY = 10

# Fixed value: the state store that comes with Spark for large state.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams.

    The number of state partitions is frozen with a query's first checkpoint, and AQE does not
    adjust it, so it follows the cores of the cluster rather than the batch setting. State lives in
    RocksDB, beside the heap. Sessions are merged within each task before the exchange, so a hot
    user sends sessions, not clicks.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sibling.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    sibling.conf.set("spark.sql.shuffle.partitions", str(partitions))
    sibling.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return sibling


def _finish(query, timeout: int) -> None:
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout} s")


def run_append(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", timeout: int = TIMEOUT_SECONDS) -> None:
    """Append new input to a file table; the checkpoint makes a rerun add nothing twice."""
    query = (
        stream.writeStream.outputMode("append")
        .format(fmt)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    _finish(query, timeout)


def run_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", timeout: int = TIMEOUT_SECONDS
) -> None:
    """Hand each micro-batch, a plain table, and its number to ``write``."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    _finish(query, timeout)


def run_versions(
    stream: DataFrame, mode: str, path: str, checkpoint: str, keys: Sequence[str] = (), timeout: int = TIMEOUT_SECONDS
) -> None:
    """Write each micro-batch of an aggregate to its own folder.

    A repeated batch overwrites its folder, so a restart after a failure leaves no duplicates, and
    readers never see a half-replaced table. The number of folders is bounded: of full refreshes the last
    ``REFRESHES`` stay; updates of ``keys`` are compacted every ``COMPACT_EVERY`` batches into the folder of
    that batch, and what lies before the compaction before goes, so a compaction that is repeated finds all
    it needs. Without a watermark the state itself grows with the keys; with one, append mode writes each
    closed window or session once, to a plain table (:func:`run_append`).
    """
    schema = stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        compacts = mode == "update" and keys and (batch_id + 1) % COMPACT_EVERY == 0
        if compacts:
            older = versions(batch.sparkSession, path, schema).where(F.col("batch_id") < batch_id)
            rows = older.unionByName(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
            batch = newest(rows, schema, keys)
        batch.write.mode("overwrite").parquet(folder)
        if compacts:
            drop_before(batch.sparkSession, path, batch_id - COMPACT_EVERY)
        elif mode == "complete":
            drop_before(batch.sparkSession, path, batch_id - REFRESHES + 1)

    run_batches(stream, write, checkpoint, mode, timeout)


def drop_before(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove the folders of earlier batches, in whatever file system ``path`` lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) < batch_id:
            files.delete(status.getPath(), True)


def versions(spark: SparkSession, path: str, schema) -> DataFrame:
    """What all batches wrote, with the number of each as ``batch_id``."""
    from pyspark.sql.types import LongType, StructField, StructType

    dated = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(dated).parquet(path)


def read_complete(spark: SparkSession, path: str, schema) -> DataFrame:
    """The last full refresh."""
    rows = versions(spark, path, schema)
    last = rows.agg(F.max("batch_id").alias("batch_id"))
    return rows.join(F.broadcast(last), "batch_id").drop("batch_id")


def read_latest(spark: SparkSession, path: str, schema, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key, which is the table that a stream of updates describes."""
    return newest(versions(spark, path, schema), schema, keys)


def newest(rows: DataFrame, schema, keys: Sequence[str]) -> DataFrame:
    """The row of the last batch of each key."""
    values = [f.name for f in schema.fields if f.name not in keys]
    last = F.max_by(F.struct(*values), "batch_id").alias("_row")
    return rows.groupBy(*keys).agg(last).select(*keys, "_row.*").select(*schema.fieldNames())


def replay(
    spark: SparkSession,
    build: Callable[[SparkSession], DataFrame],
    label: str,
    mode: str = "append",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Run ``build``'s streaming table to the end of its input and return the resulting table.

    ``append`` for row-by-row work, ``update`` for windows (only changed groups are written; needs
    ``keys``), ``complete`` for sessions, which Spark does not run in update mode.
    """
    base = scratch_dir(spark, label)
    path, checkpoint = f"{base}/table", f"{base}/checkpoint"
    stream = build(stream_session(spark))
    if mode == "append":
        run_append(stream, path, checkpoint)
        return spark.read.schema(stream.schema).parquet(path)
    run_versions(stream, mode, path, checkpoint, keys)
    if mode == "complete":
        return read_complete(spark, path, stream.schema)
    return read_latest(spark, path, stream.schema, keys)
