"""Similarity join, repeats and passages beside brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylake.llm import decontaminate, ngram_join, suffix_dedup
from staylake.llm.store import components
from tests.llm import brute


@pytest.mark.parametrize("n, percent, block", [(3, 90, 800), (5, 80, 4), (2, 60, 3)])
def test_similar_groups(docs, texts, n, percent, block):
    rows = ngram_join.similar_groups(docs, n, percent, block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in rows} == brute.groups(texts, n, percent)
    assert len(rows) == len(texts)


def test_similar_groups_of_nothing_and_of_repeated_rows(docs, nothing, texts):
    assert ngram_join.similar_groups(nothing, 3, 90).collect() == []
    rows = ngram_join.similar_groups(docs.union(docs), 3, 90).collect()
    assert len(rows) == 2 * len(texts)
    want = brute.groups(texts, 3, 90)
    assert all(r["component_id"] == want[r["doc_id"]][1] for r in rows)
    without = docs.withColumn("doc_id", F.when(F.col("doc_id") != 63, F.col("doc_id")))
    rows = ngram_join.similar_groups(without, 3, 90).where("doc_id is null").collect()
    assert [(r["component_id"], r["n_links"]) for r in rows] == [(None, 0)]


@pytest.mark.parametrize("percent", [70, 80, 90])
def test_linked_sets_share_a_signature(percent):
    rng, signer = np.random.default_rng(percent), ngram_join.Signer(percent)
    for size in [1, 2, 5, 9, 30, 200, 1000]:
        for _ in range(25):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            drop = rng.integers(0, int(size * (100 - percent) / 100) + 1)
            b = a[drop:]
            room = int((100 * len(b) - percent * size) / percent) if len(b) else 0
            b = np.concatenate([b, rng.integers(0, 2**63, rng.integers(0, max(room, 0) + 1), dtype=np.uint64)])
            same = len(np.intersect1d(a, b))
            if len(b) and 100 * same >= percent * (size + len(b) - same):
                assert set(signer.signatures(a).tolist()) & set(signer.signatures(b).tolist())


@pytest.mark.parametrize("n, percent, block", [(3, 90, 800), (5, 80, 4), (2, 60, 3), (1, 50, 2)])
def test_components_without_counting_links(docs, texts, n, percent, block):
    rows = ngram_join.similar_groups(docs, n, percent, block=block, count_links=False).collect()
    want = {i: x[:2] for i, x in brute.groups(texts, n, percent).items()}
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want and len(rows) == len(texts)


@pytest.mark.parametrize("percent, sets", [(80, 50_000), (80, 10**9), (90, 50_000)])
def test_sets_near_band_ends_share_a_signature(percent, sets):
    rng, signer = np.random.default_rng(percent), ngram_join.Signer(percent, sets)
    signer.band(700)
    for end in [e for e in signer.ends if 3 < e < 700][::3]:
        for size in (end, end + 1):
            other = -(-size * percent // 100)
            a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            for b in (a[:other], np.concatenate([a[: len(a) - 1], rng.integers(0, 2**63, 1, dtype=np.uint64)]) if size > 20 else a[:other]):
                same = len(np.intersect1d(a, b))
                if 100 * same >= percent * (len(a) + len(b) - same):
                    assert set(signer.signatures(a).tolist()) & set(signer.signatures(b).tolist())


@pytest.mark.parametrize("percent, size", [(80, 100), (80, 400), (80, 1200), (90, 400)])
def test_unrelated_sets_form_no_candidate_group(percent, size):
    """Strong signatures of sets that share nothing are never alike; weak ones seldom."""
    rng, signer = np.random.default_rng(size), ngram_join.Signer(percent, 40_000)
    owners, met = {}, set()
    for i in range(150):
        for sign, strong in zip(*signer.signed(rng.integers(0, 2**63, size, dtype=np.uint64))):
            j = owners.setdefault(int(sign), (i, bool(strong)))
            if j[0] != i:
                assert not strong and not j[1]
                met.add((j[0], i))
    assert len(met) < 0.02 * 150 * 149 / 2


def test_a_large_group_of_near_copies_sends_about_its_members(spark, monkeypatch):
    """Not its members times its blocks: 600 near copies are 30 blocks of 20."""
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 10**6, 200)]
    rows = []
    for i in range(600):
        copy = list(base)
        for at in rng.integers(0, 200, rng.integers(0, 4)):
            copy[at] = f"x{rng.integers(0, 10**9)}"
        rows.append((i, " ".join(copy)))
    sent, compared = [], ngram_join._compared

    def spy(jobs, *rest):
        sent.append(jobs.count())
        return compared(jobs, *rest)

    monkeypatch.setattr(ngram_join, "_compared", spy)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_groups(frame, 3, 90, block=20, count_links=False).collect()}
    assert got == {i: x[1] for i, x in brute.groups(dict(rows), 3, 90).items()}
    assert sum(sent) < 4 * 600, sent


def test_only_sets_that_can_have_a_link_sign(spark, monkeypatch):
    """At 80 per cent: not texts that share a passage, nor exact copies of a text that is like no other."""
    rng = np.random.default_rng(5)
    word = lambda k: [f"w{x}" for x in rng.integers(0, 10**9, k)]
    passage, base = word(20), word(200)
    rows = [(i, " ".join(word(300) + passage + word(80))) for i in range(80)]
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(200 + i, " ".join(base[: 195 - i] + word(3))) for i in range(6)]
    signed, buckets = [], ngram_join._buckets

    def spy(docs, *rest):
        signed.extend(r["doc_id"] for r in docs.select("doc_id").collect())
        return buckets(docs, *rest)

    monkeypatch.setattr(ngram_join, "_buckets", spy)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_groups(frame, 5, 80, count_links=False).collect()}
    assert got == {i: x[1] for i, x in brute.groups(dict(rows), 5, 80).items()}
    assert set(range(200, 206)) <= set(signed) and len(signed) <= 10, signed


@pytest.mark.parametrize("percent", [50, 75, 80, 89])
def test_links_at_the_threshold_pass_the_filter(spark, percent):
    """Sets of one n-gram in common more or less than a link takes, all others in no other set."""
    rows = []
    for i, size in enumerate([1, 2, 3, 7, 20, 100, 400]):
        for j, shared in enumerate([-(-size * percent // 100), -(-size * percent // 100) - 1]):
            one = [f"p{i}q{j}r{k}" for k in range(size)]
            rows += [(100 * i + 10 * j, " ".join(one)), (100 * i + 10 * j + 1, " ".join(one[:shared]))]
            rows += [(100 * i + 10 * j + 2, " ".join(one[size // 4 :] + [f"z{i}q{j}r{k}" for k in range(size // 20)]))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in ngram_join.similar_groups(frame, 1, percent).collect()}
    assert got == {i: x[1:] for i, x in brute.groups(dict(rows), 1, percent).items()}


@pytest.mark.parametrize("most", [1 << 28, 5000])
def test_rows_parted_by_a_bitmap_of_ids(spark, monkeypatch, most):
    """No row of the list is lost, rows keep their columns, and few others are to be sent."""
    monkeypatch.setattr(ngram_join, "MOST_BITS", most)
    docs = spark.range(-20_000, 20_000).selectExpr("id * 7 AS doc_id", "id AS bits0")
    ids = docs.where("bits0 % 10 = 3").select("doc_id")
    some, others = ngram_join._parted(docs, ids, "doc_id")
    assert some.columns == others.columns == docs.columns
    assert some.count() + others.count() == docs.count() and others.join(ids, "doc_id").count() == 0
    assert some.join(ids, "doc_id").count() == ids.count() and (most == 5000 or some.count() < 3 * ids.count())
    some, others = ngram_join._parted(docs, ids.limit(0), "doc_id")
    assert (some.count(), others.count()) == (0, docs.count())


def test_components_with_a_hub(spark, monkeypatch):
    from staylake.llm import store

    monkeypatch.setattr(store, "HUB", 3)
    star = spark.range(1, 200).select(F.lit(0).alias("a"), F.col("id").alias("b"))
    more = spark.range(200, 300).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    rows = components(spark, star.union(more).union(spark.range(1).selectExpr("500L", "501L"))).collect()
    assert {r["node"]: r["component"] for r in rows} == {**{i: 0 for i in range(200)}, **{i: 200 for i in range(200, 301)}, 500: 500, 501: 500}
    assert components(spark, star.limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    path = spark.range(0, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    rows = components(spark, path.union(spark.range(1).selectExpr("100L AS a", "90L AS b")))
    assert {r["node"]: r["component"] for r in rows.collect()} == {**{i: 0 for i in range(61)}, 100: 90, 90: 90}


@pytest.mark.parametrize("length", [100, 40])
def test_remove_repeats(docs, texts, length):
    rows = suffix_dedup.remove_repeats(docs, length).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], brute.sha(bytes(r["kept"]))) for r in rows}
    assert got == brute.without_repeats(texts, length)


def test_remove_repeats_over_many_small_buckets(docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 64)
    rows = suffix_dedup.remove_repeats(docs, 100).collect()
    assert {r["doc_id"]: r["n_removed"] for r in rows} == {i: x[1] for i, x in brute.without_repeats(texts, 100).items()}


def test_remove_repeats_of_nothing(nothing):
    assert suffix_dedup.remove_repeats(nothing, 100).collect() == []


def test_repeated_rows_and_rows_without_an_id(docs, texts):
    odd = docs.union(docs).union(docs.withColumn("doc_id", F.lit(None).cast("long")))
    rows = suffix_dedup.remove_repeats(odd, 100).collect()
    want = brute.without_repeats(texts, 100)
    assert sorted((r["doc_id"], r["n_removed"]) for r in rows if r["doc_id"] is not None) == sorted(2 * [(i, x[1]) for i, x in want.items()])
    assert sum(r["doc_id"] is None for r in rows) == len(texts) and all(r["n_removed"] == 0 for r in rows if r["doc_id"] is None)


def test_multikey_sort():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order, same = suffix_dedup.multikey_sort(words, (np.arange(500),))
    assert order.tolist() == sorted(range(500), key=lambda i: (words[i].tolist(), i))
    rows = words[order]
    assert (np.diff(same) == 0).tolist() == (rows[1:] == rows[:-1]).all(axis=1).tolist()


@pytest.fixture(scope="module")
def items(texts):
    part = lambda i, a, b: " ".join(texts[i].split(" ")[a:b])
    return [(1, part(5, 0, 14)), (2, part(55, 20, 40).upper()), (3, "ONE"), (4, "two, words"), (5, None), (6, "- -"), (7, part(55, 20, 40))]


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_find_passages(spark, docs, texts, items, limit):
    table = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.find_passages(docs, table, broadcast_bytes=limit).collect()
    want = brute.passages(texts, items)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == want
    assert sum(x[1] > 0 for x in want.values()) > 5


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_passages_without_an_id_and_in_repeated_rows(spark, docs, texts, items, limit):
    table = spark.createDataFrame(items, "item_id bigint, text string")
    odd = docs.union(docs).withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    rows = decontaminate.find_passages(odd, table, broadcast_bytes=limit, keep=("source",)).collect()
    want = brute.passages(texts, items)
    assert sorted((r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows) == sorted(2 * [(a, b, tuple(c)) for a, b, c in want.values()])


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 0])
def test_no_items_or_no_documents(spark, docs, nothing, texts, limit):
    none = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontaminate.find_passages(docs, none, broadcast_bytes=limit, keep=("id",)).collect()
    assert len(rows) == len(texts) and {(r["n_hit"], r["id"]) for r in rows} == {(0, "x")}
    assert decontaminate.find_passages(nothing, none, broadcast_bytes=limit).collect() == []
