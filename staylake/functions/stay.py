"""Column expressions over check-in and check-out dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stay dates are ISO days, two digits each for month and day.
ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"

# Stay categories by number of nights, (first, last, label).
CATEGORIES_AS_CODED = (
    (1, 4, "Short stay"),
    (5, 10, "Short stay"),
    (11, 14, "Standard stay"),
    (15, None, "Standard extended stay"),
)
CATEGORIES_AS_STATED = (
    (1, 4, "Short stay"),
    (5, 10, "Standard stay"),
    (11, 14, "Standard extended stay"),
    (15, None, "Long stay"),
)
ERRONEOUS = "Erroneous data"


def day(column: str | Column) -> Column:
    """ISO text to date; anything else, such as 30 February, becomes NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column.rlike(ISO_DAY), column.try_cast("date"))


def nights(check_in: str, check_out: str) -> Column:
    return F.datediff(day(check_out), day(check_in))


def months_apart(check_in: str, check_out: str) -> Column:
    return F.months_between(day(check_out), day(check_in))


def stay_category(days: Column, categories=CATEGORIES_AS_CODED) -> Column:
    """Label of a number of nights; NULL, zero and negative counts are erroneous."""
    label = F.lit(ERRONEOUS)
    for first, last, name in reversed(categories):
        inside = days >= first if last is None else days.between(first, last)
        label = F.when(inside, F.lit(name)).otherwise(label)
    return label


def extended_as_coded(check_in: str, check_out: str, at_least: int = 7) -> Column:
    """Difference of the two days of the month, whatever the months are."""
    return extended_dates_as_coded(day(check_in), day(check_out), at_least)


def extended_dates_as_coded(first: Column, last: Column, at_least: int = 7) -> Column:
    return F.abs(F.dayofmonth(last) - F.dayofmonth(first)) >= at_least


def extended_as_stated(check_in: str, check_out: str, more_than: int = 7) -> Column:
    return extended_dates_as_stated(day(check_in), day(check_out), more_than)


def extended_dates_as_stated(first: Column, last: Column, more_than: int = 7) -> Column:
    return F.datediff(last, first) > more_than


def month_starts(first: Column, last: Column) -> Column:
    """First days of the calendar months from ``first`` to ``last``; NULL if they are reversed."""
    return F.when(
        last >= first,
        F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month")),
    )
