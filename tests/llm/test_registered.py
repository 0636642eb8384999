"""Every registered query over a folder made of the edge texts: all contract columns, digests too."""

import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from staylake.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_align import plain_version as aligned
from tests.llm.test_align import whole  # noqa: F401
from tests.llm.test_fim import plain_version as filled
from tests.llm.test_simhash import fingerprint
from tests.llm.test_simhash import groups as near


@pytest.fixture(scope="module")
def items(texts):
    return [(10, " ".join(texts[54].split(" ")[3:20])), (9, " ".join(texts[54].split(" ")[6:24])), (2, None), (3, "one")]


@pytest.fixture(scope="module")
def folder(spark, docs, items, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge"))
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def op1(texts):
    return {i: x[:2] for i, x in brute.groups(texts, 3, 90).items()}, ("n_shingles", "component_id")


def op3(texts):
    base = {i: brute.personal(t) for i, t in texts.items()}
    count = lambda x, kind: sum(s.startswith(f"{kind}:") for s in x)
    kinds = ("email", "ip", "card", "phone")
    return {i: (*[count(x, k) for k in kinds], brute.sha(",".join(x))) for i, x in base.items()}, (*[f"n_{k}" for k in kinds], "base_sha256")


def op4(texts):
    return brute.without_repeats(texts, 100), ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5(texts):
    out = {}
    for i, t in texts.items():
        words, chars, symbols, _, dup, repeated = brute.quality(t)
        out[i] = words, chars, symbols, dup, repeated, words < 50 or 100 * repeated > 50 * words
    return out, ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def op7(texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {}
    for i, t in texts.items():
        ids = coder.encode_ordinary(t or "")
        out[i] = len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)), brute.sha(t or "")
    return out, ("n_tokens", "ids_sha256", "decoded_sha256")


def op8(texts):
    base = {i: brute.secrets(t) for i, t in texts.items()}
    count = lambda x, kind: sum(s.startswith(f"{kind}:") for s in x)
    kinds = ("assign", "access", "hex")
    return {i: (*[count(x, k) for k in kinds], brute.sha(",".join(x))) for i, x in base.items()}, (*[f"n_{k}" for k in kinds], "base_sha256")


def op10(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counts = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in texts.items()}
    return {i: (len((t or "").encode()), counts[i], counts[i] > 1024) for i, t in texts.items()}, ("n_bytes", "n_tokens", "over_limit")


def op12(texts):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    group = near(prints)
    return {i: (f"{x:016x}", group[i]) for i, x in prints.items()}, ("fingerprint", "component_id")


def op13(texts):
    out = {}
    for i, t in texts.items():
        n, form, prefix, middle, output = filled(i, t)
        out[i] = n, form, prefix, middle, brute.sha(output), brute.sha(t or "")
    return out, ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def named(number):
    return next(run for name, run in QUERIES.items() if name.startswith(f"op{number}_"))


def rows_of(frame, columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in frame.collect()}


@pytest.mark.parametrize("want", [op1, op3, op4, op5, op7, op8, op10, op12, op13])
def test_contract_columns(spark, folder, texts, want):
    expected, columns = want(texts)
    frame = named(want.__name__[2:])(spark, folder)
    assert rows_of(frame, columns) == expected
    assert all(kind == "bigint" for c, kind in frame.dtypes if c.startswith("n_") or c in ("doc_id", "n", "component_id"))


def test_items_of_decontamination(spark, folder, texts, items):
    want = {}
    for i, (words, hit, found) in brute.passages(texts, items).items():
        want[i] = words, hit, len(found), brute.sha(",".join(sorted(map(str, found)))), hit > 0
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(named(6)(spark, folder), columns) == want and any(w[2] > 1 for w in want.values())


def test_alignment(spark, folder, texts, whole):  # noqa: F811
    want = {}
    for i, (*counts, groups) in aligned(texts, whole).items():
        want[i] = (*counts, None if groups is None else brute.sha(groups) if groups else "")
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = rows_of(named(11)(spark, folder), columns)
    assert set(got) == set(want)
    for i, row in want.items():
        assert got[i][:6] == row[:6] and (row[6] is None or got[i][6] == row[6])


def test_digests_are_hex():
    assert brute.sha("") == hashlib.sha256(b"").hexdigest()
