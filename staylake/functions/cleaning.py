"""Small cleaning expressions and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marker of a missing coordinate and the mask of a hidden time.
MISSING_PATTERN = "NA"
TIME_MASK = "0000-00-00 00:00:00"


def is_missing(column: str | Column) -> Column:
    """NULL, or text that contains the marker anywhere."""
    column = F.col(column) if isinstance(column, str) else column
    return column.isNull() | F.coalesce(column.contains(MISSING_PATTERN), F.lit(False))


def missing_coords(df: DataFrame, lat: str = "Latitude", lng: str = "Longitude") -> DataFrame:
    return df.where(is_missing(lat) | is_missing(lng))


def mask_field(df: DataFrame, column: str, mask: str = TIME_MASK) -> DataFrame:
    """Hide every value of a column behind a constant; NULL stays NULL."""
    return df.withColumn(column, F.when(F.col(column).isNotNull(), F.lit(mask)))


def clean_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.replace(" ", "_") for name in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: does it hold a NULL? One pass, whatever the number of columns."""
    names = df.columns
    flags = df.agg(*[F.max(F.col(f"`{n}`").isNull()).alias(f"c{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("column"), F.coalesce(F.col(f"c{i}"), F.lit(False)).alias("has_nulls"))
            for i, n in enumerate(names)
        ]
    )
    return flags.select(F.inline(pairs))


def threshold_label(df: DataFrame, score: str, threshold: float, out: str) -> DataFrame:
    return df.withColumn(out, (F.col(score) >= threshold).cast("int"))


def tagged_union(first: DataFrame, second: DataFrame, flag: str) -> DataFrame:
    """Stack two sources with a 0/1 column that tells which one a row came from."""
    return first.withColumn(flag, F.lit(0)).unionByName(second.withColumn(flag, F.lit(1)))
