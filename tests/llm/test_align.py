"""Alignment of tokenizers beside whole-text encoding and a plain count."""

import functools
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from staylake.llm import align
from staylake.llm.queries import vocabulary
from staylake.llm.token_count import byte_symbols

PATHS = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def whole():
    """Text -> tokens of A and B as (id, bytes), each text encoded as one; empty where the bytes differ."""
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    symbols = {c: i for i, c in enumerate(byte_symbols())}

    def encode(text):
        if not text:
            return [], []
        e = a.encode(" " + text, add_special_tokens=False)
        one = [(i, bytes(symbols[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
        two = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            two.append((i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        want = (" " + text).encode()
        if any(b"".join(x for _, x in tokens) != want for tokens in (one, two)):
            return [], []
        return one, two

    return encode


def plain_version(texts, encode):
    """id -> contract columns, with groups as text."""
    spans, pairs = {}, Counter()
    for i, text in texts.items():
        sides = []
        for tokens in encode(text):
            at, rows = 0, []
            for number, data in tokens:
                rows.append((number, at, at + len(data)))
                at += len(data)
            sides.append(rows)
        a, b = sides
        links, k = [], 0
        for x, s, e in a:
            while k < len(b) and b[k][2] <= s:
                k += 1
            j = k
            while j < len(b) and b[j][1] < e:
                links.append((x, b[j][0]))
                j += 1
        common = {e for *_, e in a} & {e for *_, e in b}
        groups, low = [], 0
        for high in sorted(common):
            groups.append("|".join(",".join(str(x) for x, s, e in side if low <= s and e <= high) for side in sides) if len(a) < 500 else None)
            low = high
        spans[i] = a, b, links, groups
        pairs.update(links)
    best = {}
    for (x, y), n in pairs.items():
        best[y] = max(best.get(y, 0), n)
    return {
        i: (len(a), len(b), len(groups), len(links), sum(pairs[p] == best[p[1]] for p in links), sum(pairs[p] for p in links),
            ";".join(groups) if None not in groups else None)
        for i, (a, b, links, groups) in spans.items()
    }


MORE = {200: "▁ a", 201: "a ", 202: "  a  b \n c\n  d\t e　 f   g  h", 203: " ", 204: "<s> </s> <0x41> <|endoftext|> x", 205: "a\x00 b",
        206: "日本語のテキスト 123 ½", 207: "\x1c \x7f x\x85 y", 208: "don’t “stop” …now", 209: "it's  'll 've" * 3, 210: "ﬁ é ́x"}


@pytest.mark.parametrize("size", [align.BLOCK_BYTES, 300])
def test_align_documents(spark, docs, texts, whole, monkeypatch, size):
    monkeypatch.setattr(align, "BLOCK_BYTES", size)
    more = spark.createDataFrame(list(MORE.items()), "doc_id bigint, text string")
    rows = align.align_documents(docs.select("doc_id", "text", "spans", "id").unionByName(more, allowMissingColumns=True), *PATHS).collect()
    want = plain_version({**texts, **MORE}, whole)
    assert want[200][:4] == (0, 0, 0, 0) and want[202][0] > 5
    assert len(rows) == len(want)
    for r in rows:
        expected = want[r["doc_id"]]
        got = tuple(r[c] for c in align.SUMS) + (r["groups"] if expected[6] is not None else None,)
        assert got == expected, r["doc_id"]


def test_given_documents(spark, sf, whole):
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in frame.collect()}
    got = {r["doc_id"]: tuple(r[c] for c in align.SUMS) for r in align.align_documents(frame, *PATHS).collect()}
    assert got == {i: x[:6] for i, x in plain_version(texts, whole).items()}


def test_nothing_repeated_rows_and_no_id(spark, docs, nothing):
    assert align.align_documents(nothing, *PATHS).collect() == []
    few = docs.where("doc_id in (60, 61, 65, 66)").withColumn("doc_id", F.when(F.col("doc_id") != 66, F.col("doc_id")))
    rows = align.align_documents(few.union(few), *PATHS).collect()
    assert sorted((r["doc_id"] or 0, r["n_links"], r["count_sum"]) for r in rows) == sorted(2 * [(60, 0, 0), (61, 0, 0), (65, 1, 4), (0, 1, 4)])


@functools.cache
def sides():
    return align.ByteLevel(PATHS[0]), align.Pieces(PATHS[1])


CHARS = st.sampled_from(list("ab'1 .\n\t\r\x0b\x1c\x7f") + ["  ", "  ", " ", "　", "​", "᠎", "é", "’", "日", "s ", "'s", "́"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(CHARS, max_size=14).map("".join), min_size=1, max_size=4))
def test_units_are_encoded_like_the_whole_text(texts):
    a, b = sides()
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    data, begin, at = align.units_of(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
    for i, t in enumerate(raw):
        own = [x for x in begin.tolist() if at[i] <= x < at[i + 1]]
        units = [data[x:y].tobytes() for x, y in zip(own, [*own[1:], at[i + 1]])]
        assert b"".join(units) == (b" " + t if t else b"")
        for side in (a, b):
            assert [x for ids in side.encode(units) for x in ids] == [x for ids in side.encode([b" " + t] if t else []) for x in ids]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.integers(0, 2**32))
def test_coalescing_finds_common_ends(sizes, seed):
    total = sum(sizes)
    rng = np.random.default_rng(seed)
    cuts = np.unique(np.append(rng.integers(1, total + 1, rng.integers(1, 8)), total))
    a_end, b_end = np.cumsum(sizes), cuts
    start = np.concatenate([a_end - sizes, b_end - np.diff(np.append(0, b_end))])
    order, begins = align.coalesce(start, np.concatenate([a_end, b_end]))
    assert begins.sum() == len(np.intersect1d(a_end, b_end))


def test_a_full_cache_keeps_the_units_met_most(monkeypatch):
    units = align.Units(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    monkeypatch.setattr(align, "CACHE", 6)
    often, rare = [b" the", b" over"], [b" word%d" % i for i in range(9)]
    first = {w: (units.groups[n], units.counts[n].tolist(), units.pairs_of(np.array([n])).tolist()) for w in often for n in units.numbers([w, w])[:1]}
    units.numbers(rare)
    asked, add = [], units._add
    monkeypatch.setattr(units, "_add", lambda words: (asked.extend(words), add(words)))
    found = units.numbers([*often, *rare])
    assert asked == rare  # the frequent ones were kept
    for word, n in zip(often, found):
        assert first[word] == (units.groups[n], units.counts[n].tolist(), units.pairs_of(np.array([n])).tolist())
