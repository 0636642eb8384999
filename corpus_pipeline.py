"""A training corpus in five stages, each an operator of staylake.llm over what the stage before kept.

Stages keep the columns of ``documents``; the last one returns tokens. Every row is judged, texts are whole.
Defined cases: a null or empty text fails the quality rules (no words); of repeated rows with one id and text
one stays; a document without an id is near no other, and stays once for each text; empty tables give empty
tables; further columns are passed on as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm import bpe, decontaminate, ngram_join, rules, secrets
from staylake.llm.queries import vocabulary
from staylake.llm.store import stored

#: Near duplicates share 80 per cent of their five-word shingles.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return rules.passing(docs, "v1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group, once; documents without an id are in no group and stay."""
    return ngram_join.one_of_each_group(docs, SHINGLE, PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    found = decontaminate.find_passages(whole, items, keep=("row",))
    return found.where("n_hit = 0").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    _, ledger = secrets.scan(docs)
    return secrets.redact(docs, ledger)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit) and ``text`` decoded from them."""
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    rows = bpe.decode(bpe.encode(docs, path), path)
    count = (F.octet_length("ids") / 4).cast("long")
    return rows.select("doc_id", count.alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("text"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", byte_bpe),
]

#: Components and merges have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
