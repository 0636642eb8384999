"""Fill-in-middle beside a plain version."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from staylake.llm import fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain_version(id_, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{id_}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("block", [fim.BLOCK, 3])
def test_transform(spark, docs, texts, block):
    more = {100: "a<P>b", 101: "<", 102: "<S", 103: "x<M>", 104: "abc" * 5000, 105: "é<<é<S é" * 40, -106: "a1<" * 9}
    frame = docs.select("doc_id", "text", "spans").unionByName(
        spark.createDataFrame(list(more.items()), "doc_id bigint, text string"), allowMissingColumns=True
    )
    rows = fim.transform(frame, block=block).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = {i: plain_version(i, t) for i, t in {**texts, **more}.items()}
    assert {r["doc_id"]: (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows} == want
    assert {r["doc_id"]: r["back"] for r in rows} == {i: t or "" for i, t in {**texts, **more}.items()}
    assert {w[1] for w in want.values()} == {"plain", "psm", "spm"}


def test_nothing_repeated_rows_and_no_id(spark, docs, nothing):
    assert fim.transform(nothing).collect() == []
    twice = fim.transform(docs.union(docs))
    assert twice.count() == 2 * docs.count() and twice.distinct().count() == docs.count()
    one = fim.transform(spark.createDataFrame([(None, "ab c")], "doc_id bigint, text string")).collect()
    assert one[0]["doc_id"] is None and one[0]["n"] == 3


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=40), min_size=1, max_size=5))
def test_descent_finds_the_block(texts):
    blocks = np.array([len(t) for t in texts])
    flat = np.array([c for t in texts for c in t])
    tree = fim.Fenwick(blocks, flat, flat * 10)
    for i, t in enumerate(texts):
        entries = [(b, r) for b, c in enumerate(t) for r in range(c)]
        if entries:
            block, rest, (before,) = tree.descend(np.full(len(entries), i), np.arange(len(entries)))
            assert list(zip(block.tolist(), rest.tolist())) == entries
            assert before.tolist() == [10 * sum(t[:b]) for b, _ in entries]
