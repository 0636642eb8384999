"""Pre-tokens, byte-level BPE and token counts beside the public libraries."""

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from staylake.llm import bpe, token_count
from staylake.llm.pretokens import Splitter

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = bpe.read_ranks(MULTI)
SPLITTER = Splitter()
MERGES = token_count.Merges(JSON)


@given(st.lists(st.text(alphabet=st.sampled_from("astredvlm' \n\t\u3000\x1c1٣éß漢!?👍\u0301Ⅷ"), max_size=30), max_size=6))
@settings(max_examples=300, deadline=None)
def test_pretokens_begin_where_the_pattern_matches(parts):
    want, at = [], 0
    for text in parts:
        want += [at + len(text[: m.start()].encode()) for m in regex.finditer(public_tokenizers.PATTERN, text)]
        at += len(text.encode())
    data = np.frombuffer("".join(parts).encode(), dtype=np.uint8)
    assert SPLITTER.split(data, np.cumsum([0, *(len(t.encode()) for t in parts)])).tolist() == want


@given(st.binary(min_size=1, max_size=150))
@settings(max_examples=200, deadline=None)
def test_both_merges_agree(word):
    short = bpe.merge(word[: bpe.LONG], RANKS)
    assert word[: bpe.LONG] == b"".join(dict(zip(RANKS.values(), RANKS))[i] for i in short)
    if word[: bpe.LONG] not in RANKS:
        assert short == bpe._merge_long(word[: bpe.LONG], RANKS)


@given(st.lists(st.text(alphabet="aehinort '\u00e9", min_size=1, max_size=40), min_size=1, max_size=8))
@settings(max_examples=100, deadline=None)
def test_counts_of_single_sequences(words):
    tokenizer = Tokenizer.from_file(JSON)
    data = [w.encode() for w in words]
    left = MERGES.counts(np.frombuffer(b"".join(data), dtype=np.uint8), np.array([len(w) for w in data]))
    symbols = token_count.byte_symbols()
    shown = ["".join(symbols[b] for b in w) for w in data]
    assert left.tolist() == [len(tokenizer.model.tokenize(w)) for w in shown]


@pytest.fixture(scope="module")
def encoder():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_encode_and_decode(docs, nothing, texts, encoder):
    rows = bpe.decode(bpe.encode(docs, MULTI), MULTI).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = (texts[r["doc_id"]] or "").encode()
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert ids == encoder.encode_ordinary(text.decode()) and bytes(r["decoded"]) == text
        ends = np.frombuffer(r["ends"], dtype="<u4").tolist()
        assert ends == np.cumsum([len(encoder.decode_single_token_bytes(i)) for i in ids]).tolist()
    assert bpe.decode(bpe.encode(nothing, MULTI), MULTI).collect() == []


def test_count_tokens(docs, nothing, texts):
    tokenizer = Tokenizer.from_file(JSON)
    want = {i: (len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in texts.items()}
    rows = token_count.count_tokens(docs, JSON).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows} == want and len(rows) == len(want)
    assert token_count.count_tokens(nothing, JSON).collect() == []
