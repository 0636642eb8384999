"""Means that do not depend on the order in which rows arrive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values below this have an exact decimal of 18 places; sums of 1e11 of them fit as well.
LARGEST = 1e9


def exact_decimal(value: Column) -> Column:
    """The decimal of a value that has one; NULL where it is not finite, too large or finer than 18 places."""
    decimal = F.when(F.abs(value) < LARGEST, value.try_cast("decimal(38,18)"))
    return F.when(decimal.cast("double") == value, decimal)


def exact_mean(column: str, decimal: str | None = None) -> Column:
    """Mean of a column of doubles, without rounding of the input or of the mean.

    The sum runs over decimals and is exact, so a repeated task changes nothing. Nulls are left out. Where a
    value is not finite, too large or finer than 18 places, the mean is the plain average of all values: NaN
    and infinities come out as they do there. ``decimal`` names a column of :func:`exact_decimal` of the values,
    which is worked out once where one value is in many groups.
    """
    value = F.col(column)
    exact = F.col(decimal) if decimal else exact_decimal(value)
    return F.when(
        F.count(exact) == F.count(value), F.sum(exact).cast("double") / F.count(value)
    ).otherwise(F.avg(value))


#: Parts of a mean: how many values, how many of them are exact, their exact sum and the plain sum of all.
MEAN_PARTS = ("n", "n_exact", "exact", "plain")


def mean_parts(column: str) -> list[Column]:
    """Aggregates from which, added up over parts of a table, :func:`mean_of_parts` makes the same mean."""
    value = F.col(column)
    parts = F.count(value), F.count(exact_decimal(value)), F.sum(exact_decimal(value)), F.sum(value)
    return [part.alias(name) for part, name in zip(parts, MEAN_PARTS)]


def mean_of_parts() -> Column:
    n = F.when(F.col("n") > 0, F.col("n"))
    return F.when(F.col("n") == F.col("n_exact"), F.col("exact").cast("double") / n).otherwise(F.col("plain") / n)
