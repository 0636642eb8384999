"""Geohash cells as a plain column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public geohash alphabet, five bits per character.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# The digits Spark's ``conv`` writes to base 32.
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def _grid_index(value: Column, low: float, span: float, bits: int) -> Column:
    """Index of the grid step that holds ``value``; the upper end belongs to the last step."""
    steps = 1 << bits
    step = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(steps)))
    return F.greatest(F.lit(0), F.least(F.lit(steps - 1), step)).cast("bigint")


def _spread_bits(index: Column) -> Column:
    """Put a zero between the bits: the binary digits, read to base four.

    Each operand appears once, which keeps the generated code small enough to be compiled.
    """
    return F.conv(F.bin(index), 4, 10).cast("bigint")


def geohash(lat: Column, lng: Column, precision: int = 4) -> Column:
    """Geohash of a point, or NULL for a missing or out-of-range coordinate.

    Longitude and latitude bits alternate, longitude first. A point exactly on a cell edge
    belongs to the cell above it.
    """
    if not 1 <= precision <= 12:
        raise ValueError(f"precision must be 1 to 12, got {precision}")
    total = 5 * precision
    x = _spread_bits(_grid_index(lng, -180.0, 360.0, (total + 1) // 2))
    y = _spread_bits(_grid_index(lat, -90.0, 180.0, total // 2))
    # The last bit belongs to latitude for an even number of bits, to longitude for an odd one.
    code = x * 2 + y if total % 2 == 0 else x + y * 2
    digits = F.lpad(F.conv(code.cast("string"), 10, 32), precision, "0")
    cell = F.translate(digits, BASE32_DIGITS, GEOHASH_ALPHABET)
    return F.when(lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0), cell)


def add_geohash(
    df: DataFrame, lat: str, lng: str, out: str = "Geohash", precision: int = 4
) -> DataFrame:
    """Append the cell of each row; coordinates may be numbers or text."""
    as_double = lambda name: F.col(name).try_cast("double")
    return df.withColumn(out, geohash(as_double(lat), as_double(lng), precision))


def distinct_cells(df: DataFrame, column: str = "Geohash") -> DataFrame:
    """The cells in use. Whether they are broadcast is up to the planner, which measures them."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()
