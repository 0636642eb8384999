"""Rows as JSON messages in one ``value`` column, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

_BAD = "_bad_record"


def encode_rows(df: DataFrame) -> DataFrame:
    """Every row as one JSON object; NULL fields stay in the message."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def parsed(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Messages with their fields, for :func:`readable` to part; ``inline`` parses each message once for all
    fields and checks."""
    checked = StructType([*schema.fields, StructField(_BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    row = F.from_json(value, checked, options)
    names = [f"_field{i}" for i in range(len(schema.fields))]
    return messages.select(F.col(value).alias("_value"), F.inline(F.array(row))).toDF("_value", *names, _BAD)


def readable() -> Column:
    return (F.coalesce(F.trim("_value"), F.lit("")) != "") & F.col(_BAD).isNull()


def fields(rows: DataFrame, schema: StructType) -> DataFrame:
    """Typed columns of parsed messages."""
    return rows.select(*[F.col(f"_field{i}").alias(f.name) for i, f in enumerate(schema.fields)])


def unreadable(rows: DataFrame, value: str = "value") -> DataFrame:
    """Parsed messages as they came."""
    return rows.select(F.col("_value").alias(value))


def decode_rows(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Typed columns of the readable messages."""
    return fields(parsed(messages, schema, value).where(readable()), schema)


def rejected_rows(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Messages that are missing or do not fit the schema, as they came."""
    return unreadable(parsed(messages, schema, value).where(~readable()), value)
