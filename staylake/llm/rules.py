"""Quality rules as a ledger of failure bits (operator 5).

Each rule is measured once for each document. The ledger keeps the measurements and one bit for each rule
that failed; a policy is a version with the bits it enforces, so a new policy or an ablation reads the
ledger only. Everything is a column expression; a document never leaves its row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Rule -> (failure over the measurements). The place in this table is the rule's bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "5 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
}

#: Policy version -> rules it enforces.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols"),
    "v2": tuple(RULES),
}

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def policy_mask(version: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[version])


def _repeat_words(grams: str) -> Column:
    """Words inside runs whose hash stands twice or more in the array ``grams``.

    Runs sorted by hash show their equals as neighbours; the places of those, in order, each add the words
    up to the next one, three at most.
    """
    g = F.col(grams)
    ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    pairs = F.zip_with(
        ordered,
        F.zip_with(
            F.concat(F.array(F.lit(None).cast("struct<g:bigint,i:int>")), F.slice(ordered, 1, F.size(g) - 1)),
            F.slice(ordered, 2, F.size(g)),
            lambda a, b: F.struct(a["g"].alias("a"), b["g"].alias("b")),
        ),
        lambda x, near: F.when((x["g"] == near["a"]) | (x["g"] == near["b"]), x["i"]),
    )
    places = F.sort_array(F.array_compact(pairs))
    following = F.slice(places, 2, F.size(g))
    covered = F.zip_with(places, following, lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(total)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the measurements of every row; a null or empty text measures 0 throughout.

    Rows are judged each for itself, also if they repeat or have no id; other columns are left out. Runs of
    three words are compared by 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    without = lambda c, chars: F.translate(c, chars, "")
    words = F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: without(x, BLANKS) != "")
    rows = docs.select(
        F.col(id_col),
        F.length(without(text, BLANKS)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        words.alias("w"),
        lines.alias("l"),
    )
    size = F.size("w").cast("long")
    place = F.sequence(F.lit(1), F.size("w") - 2)
    gram = lambda i: F.xxhash64(F.get("w", i - 1), F.get("w", i), F.get("w", i + 1))
    empty = F.array().cast("array<bigint>")
    rows = rows.select(
        id_col,
        size.alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") >= 3, F.transform(place, gram)).otherwise(empty).alias("grams"),
    )
    return rows.select(id_col, *MEASURES[:-1], _repeat_words("grams").alias("n_repeat_words"))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measurements with ``failed``: bit i is set if rule i of ``RULES`` failed.

    The partition's number in the expression keeps a later filter on the bits from being pushed below the
    measurements, where each rule would measure anew.
    """
    rows = measured(docs, id_col, text_col)
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    failed = reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")
    return rows.withColumn("failed", F.when(F.spark_partition_id() >= 0, failed))


def enforced(version: str) -> Column:
    """Failure bits that the policy minds; 0: the document stays."""
    return F.col("failed").bitwiseAND(F.lit(policy_mask(version)))


def passing(docs: DataFrame, version: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the policy keeps. Rows stay where they are."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return ledger(whole, "row", "text").where(enforced(version) == 0).select("row.*")


def ablations(rows: DataFrame, version: str) -> DataFrame:
    """For each rule of a policy: ``n_failed``, and ``n_only``, the documents that it alone rejects.

    Documents are first counted for each pattern of bits, of which there are few.
    """
    counts = rows.groupBy(enforced(version).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    table = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("long").alias("bit")) for r in POLICIES[version]]
    )
    each = counts.select("bits", "n", F.explode(table).alias("r"))
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.coalesce(F.sum(F.when(failed, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0)).alias("n_only"),
    )
