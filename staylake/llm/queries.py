"""The operators applied to the given tables, with the columns their checks compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylake.llm import align, bpe, decontaminate, fim, ngram_join, pii, preference, rules, secrets, simhash, suffix_dedup, token_count, urls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vocabulary(name: str) -> str:
    """A public vocabulary file; the folder is the one of the installed ``public_tokenizers``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query
def op7_byte_bpe(spark, sf):
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    rows = bpe.decode(bpe.encode(documents(spark, sf), path), path)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_token_counts(spark, sf):
    counted = token_count.count_tokens(documents(spark, sf), vocabulary("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query
def op6_decontaminate(spark, sf):
    found = decontaminate.find_passages(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op1_ngram_jaccard(spark, sf):
    """Sets are those of 64-bit hashes of shingles."""
    return ngram_join.similar_groups(documents(spark, sf), n=3, percent=90, count_links=False)


@query
def op4_suffix_dedup(spark, sf):
    rows = suffix_dedup.remove_repeats(documents(spark, sf), length=100)
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_quality_rules(spark, sf):
    """Repeated windows are found by 64-bit hashes."""
    rows = rules.ledger(documents(spark, sf))
    return rows.select(
        "doc_id",
        *rules.MEASURES,
        "failed",
        (rules.enforced("base") != 0).alias("base_failed"),
        (rules.enforced("v1") == 0).alias("kept"),
    )


ORACLES["op5_quality_rules"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
u AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM t),
g AS (SELECT doc_id, i, a, lead(a) OVER d AS b, lead(a, 2) OVER d AS c FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g
  WHERE c IS NOT NULL) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY doc_id),
m AS (SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN c USING (doc_id)),
f AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (5 * n_symbols > n_words)::INT
    + 8 * (10 * n_dup_lines > 3 * n_lines)::INT + 16 * (word_chars < 3 * n_words)::INT
    + 32 * (word_chars > 10 * n_words)::INT)::BIGINT AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed & 7 = 0 AS kept FROM f
"""


@query
def op8_secret_scan(spark, sf):
    """In two runs: half of the texts with the first two rule versions, then all texts with all versions."""
    docs = documents(spark, sf)
    half = docs.where(F.pmod(F.xxhash64("text"), F.lit(2)) == 0)
    _, ledger = secrets.scan(half, versions=(1, 2))
    findings, _ = secrets.scan(docs, ledger)
    return secrets.report(findings)


@query
def op3_pii(spark, sf):
    docs = documents(spark, sf)
    return pii.report(pii.find(docs, pii.fitted_once(spark)))


@query
def op9_url_filter(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return urls.judged(pages, urls.fit(urls.labelled_urls(spark))).drop("score")


@query
def op2_chat_preferences(spark, sf):
    return preference.all_preferences(spark.read.parquet(f"{sf}/conversations.parquet"))


ORACLES["op2_chat_preferences"] = """
WITH c AS (SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
p AS (SELECT *, min(conv_id) OVER (PARTITION BY t[1].role, t[1].text) AS first FROM c),
e AS (SELECT conv_id, t[:list_max(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant'))] AS t
  FROM c WHERE len(list_filter(t, lambda m: m.role = 'assistant')) > 0),
n AS (SELECT *, coalesce(lead(conv_id) OVER w, first_value(conv_id) OVER w) AS next
  FROM e WINDOW w AS (ORDER BY sha256(conv_id::VARCHAR), conv_id)),
j AS (SELECT b.first AS chosen_id, b.conv_id AS rejected_id, a.t AS a, b.t AS b
  FROM p b JOIN c a ON a.conv_id = b.first WHERE b.conv_id <> b.first
  UNION ALL SELECT a.conv_id, b.conv_id, a.t, list_append(a.t[:-2], b.t[-1]) FROM n a JOIN e b ON b.conv_id = a.next
  UNION ALL SELECT a.conv_id, b.conv_id, a.t, list_append(a.t[:a.at - 1], b.t[-1]) FROM (SELECT *,
    list_min(list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant')) AS at FROM n) a JOIN e b ON b.conv_id = a.next
    WHERE a.at < len(a.t)),
k AS (SELECT *, coalesce(list_position(list_transform(range(1, greatest(len(a), len(b)) + 1),
    lambda i: coalesce(a[i].role = b[i].role AND a[i].text = b[i].text, false)), false) - 1, len(a))::BIGINT AS n_common FROM j),
x AS (SELECT *, a[n_common + 1:] AS ra, b[n_common + 1:] AS rb FROM k)
SELECT chosen_id, rejected_id, n_common,
  coalesce(array_to_string(list_transform(a[:n_common], lambda m: '<|' || m.role || '|>' || chr(10) || m.text || '<|end|>' || chr(10)), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(ra, lambda m: '<|' || m.role || '|>' || chr(10) || m.text || '<|end|>' || chr(10)), ''), '') AS chosen,
  coalesce(array_to_string(list_transform(rb, lambda m: '<|' || m.role || '|>' || chr(10) || m.text || '<|end|>' || chr(10)), ''), '') AS rejected,
  coalesce(array_to_string(list_transform(ra, lambda m: '0:' || (length(m.role) + 5) || ',' || (m.role = 'assistant')::INT
    || ':' || length(m.text) || ',0:8'), ','), '') AS chosen_mask,
  coalesce(array_to_string(list_transform(rb, lambda m: '0:' || (length(m.role) + 5) || ',' || (m.role = 'assistant')::INT
    || ':' || length(m.text) || ',0:8'), ','), '') AS rejected_mask
FROM x
"""


@query
def op13_fill_in_middle(spark, sf):
    rows = fim.transform(documents(spark, sf))
    text = fim.restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


@query
def op12_simhash_near_dedup(spark, sf):
    return simhash.near_duplicates(documents(spark, sf))


@query
def op11_align_tokenizers(spark, sf):
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    rows = align.align_documents(documents(spark, sf), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return rows.withColumn("groups_sha256", digest).drop("groups")
