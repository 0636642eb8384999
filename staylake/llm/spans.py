"""Places of regular-expression matches in a text, as column expressions.

A span is ``kind:start:end`` in code points, end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,end:bigint,match:string>"


def spans(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """Start, end and text of all matches from the left without overlap; none where ``gate`` is false.

    Matches and the stretches between them alternate, so places are sums of their lengths. Matches must
    not be empty.
    """
    some = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(between, some, lambda gap, m: F.struct(F.length(gap).cast("long").alias("gap"), m.alias("m")))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def add(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        # The last stretch has no match behind it.
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("match"))
        return F.when(x["m"].isNull(), acc).otherwise(
            F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))
        )

    walked = F.aggregate(steps, zero, add, lambda acc: acc["out"])
    has = F.regexp_like(text, F.lit(pattern))
    return F.when(has if gate is None else gate & has, walked).otherwise(F.array().cast(f"array<{SPAN}>"))


def ordered(kinds: dict[str, Column]) -> Column:
    """Spans of several kinds as one array, by start, then by kind as listed, then by end."""

    def tagged(rank: int, kind: str, found: Column) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")),
        )

    parts = [tagged(i, kind, found) for i, (kind, found) in enumerate(kinds.items())]
    return F.sort_array(F.concat(*parts))


def written(spans_of: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans_of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans_of: Column, mark: str = "[{kind}]") -> Column:
    """The text with each span replaced by its kind; of overlapping spans the first is written out."""
    left, right = mark.split("{kind}")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(acc, s):
        begin = F.greatest(acc["at"], s["start"])
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
        name = F.when(s["start"] >= acc["at"], F.concat(F.lit(left), s["kind"], F.lit(right))).otherwise("")
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], kept, name).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans_of) == 0, text).otherwise(F.aggregate(spans_of, zero, add, rest))
