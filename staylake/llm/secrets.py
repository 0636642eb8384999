"""Secret scans over an incremental blob ledger (operator 8).

Every version of every path has a blob, named by the SHA-256 of its content. A ledger holds one row for each
blob and rule version that was scanned, with the spans found. A run scans only pairs the ledger lacks, each
blob once whatever the number of its paths, and then joins the findings to all paths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.spans import ordered, redacted, spans, written
from staylake.llm.store import stored

SPANS = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
LEDGER = f"blob string, version int, found {SPANS}"

ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


LABEL = r"[A-Z0-9\x20]{0,40}"
LINE_END = r"(?:\r?\n|(?:\\r)?\\n)"
MARGIN = r"[\x20\t>\"']*+"
BASE64 = "[A-Za-z0-9+/=]"
HEADER = rf"{LINE_END}{MARGIN}(?:Proc-Type|DEK-Info|Version|Comment|Hash|Charset|MessageID):\x20[^\r\n]*+"
#: A private key: BEGIN to the END of the same label with no other marker between; else BEGIN and the base64
#: behind it, the first line of 16 characters at least, further ones of any length, long runs on one line too.
#: Loops are possessive, so that long bodies are walked and not recursed into.
KEY = (
    rf"-----BEGIN\x20({LABEL})PRIVATE\x20KEY(\x20BLOCK)?+-----"
    rf"(?:(?:[^-]++|-(?!----(?:BEGIN|END)\x20))*+-----END\x20\1PRIVATE\x20KEY(?:\x20BLOCK)?+-----"
    rf"|(?:{HEADER})*+(?:{LINE_END}[\x20\t>]*+(?={LINE_END}))*+"
    rf"(?:(?:{LINE_END}|[\x20\t]){MARGIN}(?:{BASE64}{{32,}}+|{BASE64}{{16,}}+(?={MARGIN}(?:{LINE_END}|\z)))"
    rf"(?:[\x20\t]++{BASE64}{{32,}}+|{LINE_END}{MARGIN}(?:{BASE64}{{32,}}+|{BASE64}++(?={MARGIN}(?:{LINE_END}|\z))))*+)?+)"
)


def _assigned(text: Column) -> Column:
    found = spans(text, ASSIGN)
    return F.filter(found, lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= 6)


#: Rule version -> kind -> spans in a text. A new version holds only what it adds.
RULES = {
    1: {
        "assign": _assigned,
        # Runs shorter than asked for are matches that would be dropped, so the pattern may pass over them.
        "access": lambda t: spans(t, "AKIA[A-Z0-9]{16,}", t.contains("AKIA")),
        "hex": lambda t: spans(t, "[0-9a-f]{24,}"),
    },
    2: {
        "pem": lambda t: spans(t, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", t.contains("PRIVATE KEY-----")),
        "jwt": lambda t: spans(t, r"eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", t.contains("eyJ")),
    },
    # Version 2 marks the BEGIN line alone; the body is a secret too.
    3: {"key": lambda t: spans(t, KEY, t.contains("PRIVATE KEY"))},
}
KINDS = [kind for rules in RULES.values() for kind in rules]


def blob(text_col: str) -> Column:
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("blob")


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", versions: Sequence[int] = tuple(RULES)
):
    """``(findings, ledger)``: findings have ``id_col``, ``blob`` and ``found`` (spans of all versions in the ledger).

    The new ledger holds the old rows, which are not written again, and those of this run: the pairs of a blob and
    one of ``versions`` that the old one lacks. Rules of other versions are not evaluated on a blob. A null text
    is an empty one; equal texts share a blob; rows may repeat and may have no id; other columns are left out.
    """
    spark = docs.sparkSession
    content = F.coalesce(F.col(text_col), F.lit(""))
    if ledger is None:
        ledger = spark.range(0).select(F.from_json(F.lit("{}"), LEDGER).alias("x")).select("x.*")
    ledger = ledger.select("blob", "version", "found")
    paths = docs.select(F.col(id_col), blob(text_col))
    heads = paths.groupBy("blob").agg(F.min(id_col).alias("id"))
    pairs = heads.withColumn("version", F.explode(F.array(*map(F.lit, versions))))
    unseen = pairs.join(ledger.select("blob", "version"), ["blob", "version"], "left_anti")
    todo = unseen.groupBy("blob", "id").agg(F.collect_set("version").alias("versions"))
    texts = docs.select(F.col(id_col).alias("path"), content.alias("text"), blob(text_col).alias("own"))
    texts = texts.join(todo.hint("merge"), F.col("path").eqNullSafe(F.col("id")) & (F.col("own") == F.col("blob")))
    rank = {kind: i for i, kind in enumerate(KINDS)}
    unseen_rules = [
        F.when(F.array_contains("versions", v), rule(F.col("text"))).alias(kind) for v in versions for kind, rule in RULES[v].items()
    ]
    scanned = texts.select("blob", "versions", *unseen_rules)
    each = F.array(
        *[
            F.struct(F.lit(v).alias("version"), _ranked({k: F.col(k) for k in rules}, rank).alias("found"))
            for v, rules in RULES.items()
            if v in versions
        ]
    )
    rows = scanned.select("blob", F.explode(F.filter(each, lambda x: F.array_contains("versions", x["version"]))).alias("x"))
    rows = rows.select("blob", "x.version", "x.found").dropDuplicates(["blob", "version"])
    done = ledger.unionByName(stored(rows, "secret-ledger"))
    found = paths.join(hits(done), "blob", "left")
    return found.select(id_col, "blob", F.coalesce("found", F.array().cast(SPANS)).alias("found")), done


def hits(ledger: DataFrame) -> DataFrame:
    """``blob`` and ``found``, the spans of all versions in order, of blobs with any."""
    rows = ledger.where(F.size("found") > 0).groupBy("blob")
    return rows.agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))


def redact(docs: DataFrame, ledger: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """All columns of ``docs``, the ledger's spans in the text written as their kinds.

    ``size_col``, if there is one, becomes the length of a text that changed. Rows without a finding,
    repeated ones and nulls stay as they are.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), blob(text_col))
    rows = whole.join(hits(ledger), "blob", "left").select(
        "row", F.when(F.col("found").isNotNull(), redacted(F.col("row")[text_col], F.col("found"))).alias("clean")
    )
    new = {text_col: F.coalesce("clean", F.col("row")[text_col])}
    if size_col in docs.columns:
        length = F.length("clean").cast(docs.schema[size_col].dataType)
        new[size_col] = F.coalesce(length, F.col("row")[size_col])
    return rows.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def _ranked(kinds: dict[str, Column], rank: dict[str, int]) -> Column:
    """Spans in order, ranks being those of all versions together."""
    low = min(rank[k] for k in kinds)
    return F.transform(
        ordered(kinds),
        lambda s: F.struct(s["start"].alias("start"), (s["rank"] + low).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
    )


def report(findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans written out."""
    base = list(RULES[1])
    of_base = F.filter("found", lambda s: s["kind"].isin(base))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return findings.select(
        id_col,
        *[count(kind) for kind in base],
        F.sha2(written(of_base), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
