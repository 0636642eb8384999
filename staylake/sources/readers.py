"""Batch and streaming readers with declared schemas: none infers a schema from the rows.

Tables that carry their own schema (the views, tables of the catalog) are read by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

FORMATS = ("csv", "json", "parquet", "orc", "text")


def read_table(spark: SparkSession, path: str | Sequence[str], fmt: str, schema: StructType | str, **options) -> DataFrame:
    """Read one path or a list of paths with a declared schema.

    Partition columns named in the schema keep the declared type.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {', '.join(FORMATS)}")
    if fmt == "csv":
        options.setdefault("header", True)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format(fmt).schema(schema).options(**options).load(paths)


def read_many(spark: SparkSession, paths: Sequence[str], fmt: str, schema: StructType | str, **options) -> DataFrame:
    """Stack every file below the given paths; the file tree adds no columns."""
    return read_table(spark, paths, fmt, schema, recursiveFileLookup=True, **options)


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column that one of them lacks is NULL there."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def stream_table(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType | str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    **options,
) -> DataFrame:
    """Incremental file source; at most one of the two per-trigger caps may be given."""
    if max_files and max_bytes:
        raise ValueError("give max_files or max_bytes, not both")
    if max_files:
        options["maxFilesPerTrigger"] = max_files
    if max_bytes:
        options["maxBytesPerTrigger"] = max_bytes
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def as_stream_path(path: str) -> str:
    """The same path as a pattern, which a stream accepts for a single file as for a folder."""
    return f"{path[:-1]}[{path[-1]}]"
