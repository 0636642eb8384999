"""Table writers that may be run again without changing the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed value: the folder name that stands for NULL.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_mart(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", **options) -> None:
    """Overwrite exactly the partitions present in ``df``; a rerun gives the same files' content.

    ``rebalance`` sends the rows of a partition value together but lets AQE cut a large value into
    several tasks and files, so neither many small files nor one writer for a hot value.
    """
    writer = df.hint("rebalance", *partition_by).write if partition_by else df.write
    writer = writer.format(fmt).mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a table that several later steps read, and read it back."""
    write_mart(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_null_records(df: DataFrame, value_columns: Sequence[str]) -> DataFrame:
    """Leave out records whose value columns are all NULL, as a sink that ignores them does."""
    return df.dropna(how="all", subset=list(value_columns))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """A database, at ``location`` if the caller names one; an existing one keeps its place.

    Tables name their own location, so they do not depend on it.
    """
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def register_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """External table over existing files, replaced if the name is taken; no data is copied."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}'")
    return spark.table(table)


def register_partitioned(
    spark: SparkSession, table: str, path: str, schema: StructType, partition_by: Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    """External table over files that are stored by partition; the catalog knows its partitions, so a query on
    them lists no other folder. Replaced if the name is taken; no data is copied."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING {fmt} PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'")
    return recover_partitions(spark, table)


def recover_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Let the catalog know partitions that were written since."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    return spark.table(table)


def create_table_as(spark: SparkSession, table: str, path: str, query: str, fmt: str = "parquet") -> DataFrame:
    """Materialise a query as a table at ``path``."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING {fmt} LOCATION '{path}' AS {query}")
    return spark.table(table)


def copy_next_day(source: DataFrame, target: str, day: str) -> str | None:
    """Copy the earliest day that the target lacks; returns it, or None when all are there.

    A day counts as copied once its marker is written, after the commit of its rows: a cycle that was cut
    off leaves no marker, and the next one overwrites the day's partition. Finding the day reads the day column
    of the whole source; for a source that is stored by day there is :func:`copy_next_folder`.
    """
    spark = source.sparkSession
    days = source.select(day).where(F.col(day).isNotNull()).distinct()
    copied = copied_days(spark, target, day)
    if copied is not None:
        days = days.join(copied, day, "left_anti")
    next_day = days.agg(F.min(day)).first()[0]
    if next_day is None:
        return None
    write_mart(source.where(F.col(day) == next_day), target, [day])
    _mark(spark, target, day, next_day)
    return next_day


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column of a stored table, from the names of its folders: no file is opened.

    As many as there are folders; NULL has no value here, and a path that is not there has none.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    unescape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = [unescape(name.partition("=")[2]) for name in names if name.startswith(f"{column}=")]
    return sorted(v for v in values if v != _NO_VALUE)


def copy_next_folder(spark: SparkSession, source: str, target: str, day: str, schema, fmt: str = "parquet") -> str | None:
    """As :func:`copy_next_day`, from a table that is stored by day: the days are those of its folders, compared
    with the markers, and only the folder of the day that is copied is read."""
    done = set(partition_values(spark, _markers(target), "copied"))
    next_day = next((d for d in partition_values(spark, source, day) if d not in done), None)
    if next_day is None:
        return None
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    rows = spark.read.format(fmt).schema(schema).option("basePath", source).load(f"{source}/{day}={escape(next_day)}")
    write_mart(rows, target, [day])
    _mark(spark, target, day, next_day)
    return next_day


def _mark(spark: SparkSession, target: str, day: str, value: str) -> None:
    marker = spark.range(1).select(F.lit(value).alias(day))
    marker.write.mode("overwrite").parquet(f"{_markers(target)}/copied={value}")


def _markers(target: str) -> str:
    """Markers lie beside the table, so that readers of the table do not see them."""
    return f"{target.rstrip('/')}-copied"


def copied_days(spark: SparkSession, target: str, day: str) -> DataFrame | None:
    """Days whose copy was completed, or None before the first cycle."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(f"{day} string").parquet(_markers(target)).select(day).distinct()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
