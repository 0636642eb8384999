"""SimHash near duplicates beside brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from staylake.llm import simhash
from tests.llm.brute import LOWER, NOT_BLANK


def fingerprint(text, n=4):
    words = NOT_BLANK.findall((text or "").translate(LOWER))
    grams = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(prints):
    """id -> smallest id reachable, from {id: fingerprint}."""
    root = {i: i for i in prints}
    for _ in prints:
        before = dict(root)
        for i, x in prints.items():
            root[i] = min(root[j] for j, y in prints.items() if (x ^ y).bit_count() <= 4)
        if before == root:
            return root


def test_near_duplicates(docs, texts):
    rows = simhash.near_duplicates(docs).collect()
    prints = {i: fingerprint(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{x:016x}" for i, x in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == groups(prints) and len(rows) == len(texts)


def test_hash_is_the_one_of_spark(spark):
    words = ["a b c d", "x", "é ü ñ ö"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h")).collect()
    assert [r.h % 2**64 for r in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_nothing_repeated_rows_and_no_id(spark, docs, nothing):
    assert simhash.near_duplicates(nothing).collect() == []
    once = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    rows = simhash.near_duplicates(docs.union(docs).withColumn("doc_id", F.when(F.col("doc_id") != 63, F.col("doc_id")))).collect()
    assert len(rows) == 2 * len(once)
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert {r["component_id"] for r in rows if r["doc_id"] == 64} == {min(i for i, c in once.items() if c == once[64] and i != 63)}


def clustered(rng, clusters, size, flips):
    """Points around centres, with some bits flipped."""
    centres = rng.integers(0, 2**64, clusters, dtype=np.uint64)
    out = np.repeat(centres, size)
    for _ in range(flips):
        out ^= np.uint64(1) << rng.integers(0, 64, len(out), dtype=np.uint64)
    return np.unique(out)


def labels_by_brute_force(points):
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    label = np.arange(len(points))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


@pytest.mark.parametrize("clusters, size, flips", [(400, 3, 4), (1, 1500, 3), (2, 600, 8), (1, 1200, 14)])
def test_links_in_a_shard(monkeypatch, clusters, size, flips):
    """Small limits, so that the local tree is used."""
    monkeypatch.setattr(simhash, "PAIRS", 2000)
    points = clustered(np.random.default_rng(size), clusters, size, flips)
    assert simhash.joined(points, np.uint64(0), 4).tolist() == labels_by_brute_force(points).tolist()


@pytest.mark.parametrize("classes, clusters, size, flips", [(10**6, 300, 4, 4), (10**6, 1, 1500, 4), (10**9, 100, 8, 5), (10**12, 100, 8, 5)])
def test_linked_points_share_a_shard(classes, clusters, size, flips):
    rng = np.random.default_rng(flips + size)
    points = clustered(rng, clusters, size, flips)
    sample = np.sort(points.view(np.int64)[rng.random(len(points)) < 0.3]).view(np.uint64)
    wanted = {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 4)) if i < j}
    found = set()
    for mask in simhash.masks(classes, 4):
        tree = simhash.Tree(sample, mask, 4, 16)
        index, leaf = tree.route(points)
        assert tree.leaves > 1
        for number in range(tree.leaves):
            here = np.sort(index[leaf == number])
            equal = (points[here][:, None] ^ points[here][None, :]) & mask == 0
            found |= {(here[a], here[b]) for a, b in zip(*np.nonzero(equal)) if a < b}
    assert wanted and wanted <= found


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 20)
    points = np.unique(np.concatenate([clustered(np.random.default_rng(5), 150, 4, 4), clustered(np.random.default_rng(6), 1, 500, 6)]))
    table = spark.createDataFrame([(int(p), i) for i, p in enumerate(points.view(np.int64).tolist())], "fp bigint, rep bigint")
    from staylake.llm.store import components

    got = {r["node"]: r["component"] for r in components(spark, simhash.near_classes(table)).collect()}
    want = labels_by_brute_force(points).tolist()
    assert [got.get(i, i) for i in range(len(points))] == want
