"""Byte-level BPE encoding and decoding (operator 7).

Pre-tokens come from :mod:`pretokens`. Each different slice of a piece is merged once, in a cache that the
task keeps; ids and the byte end of each token are then gathered for all slices at once. The ends let a
reader decode any part of a text without the rest.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from staylake.llm import arrays
from staylake.llm.pretokens import Splitter, distinct_slices

CACHE = 150_000
LONG = 60
NO_PAIR = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: again and again the leftmost pair of lowest rank becomes one symbol."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > LONG:
        return _merge_long(word, ranks)
    at = list(range(len(word) + 1))
    pairs = [ranks.get(word[i : i + 2], NO_PAIR) for i in range(len(word) - 1)]
    while (lowest := min(pairs)) < NO_PAIR:
        i = pairs.index(lowest)
        del at[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(word[at[i] : at[i + 2]], NO_PAIR)
        if i:
            pairs[i - 1] = ranks.get(word[at[i - 1] : at[i + 1]], NO_PAIR)
        if not pairs:
            break
    return [ranks[word[a:b]] for a, b in zip(at, at[1:])]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a queue, for words whose pairs are too many to look through in each step."""
    n = len(word)
    right = list(range(1, n + 1))  # where the symbol that begins here ends; 0: no symbol begins here
    left = list(range(-1, n))
    queue = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(queue)
    while queue:
        _, i, j = heapq.heappop(queue)
        middle = right[i]
        if not middle or middle >= n or middle >= j or right[middle] != j:
            continue
        right[i], right[middle] = j, 0
        if j < n:
            left[j] = i
            if (r := ranks.get(word[i : right[j]])) is not None:
                heapq.heappush(queue, (r, i, right[j]))
        if (k := left[i]) >= 0 and (r := ranks.get(word[k:j])) is not None:
            heapq.heappush(queue, (r, k, j))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : right[i]]])
        i = right[i]
    return ids


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` and ``ends``: token ids and byte ends as little-endian unsigned 32-bit numbers.

    A null text is an empty one: no ids. Rows with equal ids are encoded each for itself; other columns
    are left out. ``path`` names the rank file, which every executor can read.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, ids binary, ends binary"

    def run(batches):
        ranks = read_ranks(path)
        size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        size[list(ranks.values())] = [len(x) for x in ranks]
        splitter, hashes, cache = Splitter(), (arrays.SpanHash(1), arrays.SpanHash(2)), {}
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                begin = splitter.split(data, offsets)
                end = np.append(begin[1:], len(data))
                first, which = distinct_slices(data, begin, end, hashes)
                if len(cache) > CACHE:
                    cache.clear()
                raw, found = data.tobytes(), []
                for a, b in zip(begin[first].tolist(), end[first].tolist()):
                    ids = cache.get(word := raw[a:b])
                    if ids is None:
                        ids = cache[word] = np.array(merge(word, ranks), dtype=np.uint32).tobytes()
                    found.append(ids)
                lengths = np.array([len(x) // 4 for x in found], dtype=np.int64)
                flat = np.frombuffer(b"".join(found), dtype=np.uint32)
                row, place = arrays.ragged(lengths[which])
                ids = flat[(np.cumsum(lengths) - lengths)[which][row] + place]
                tokens = np.concatenate([[0], np.cumsum(lengths[which])])[np.searchsorted(begin, offsets)]
                ends = np.cumsum(size[ids])  # over the piece; the texts lie behind each other in it
                ends -= np.repeat(offsets[:-1], np.diff(tokens))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), arrays.binaries(ids, tokens, np.uint32), arrays.binaries(ends, tokens, np.uint32)],
                    names=[id_col, "ids", "ends"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ``ids`` stand for (null: none)."""
    columns = [id_col, "ids", "ends"]
    schema = f"`{id_col}` {encoded.schema[id_col].dataType.simpleString()}, ids binary, ends binary, decoded binary"

    def run(batches):
        ranks = read_ranks(path)
        words = [b""] * (max(ranks.values()) + 1)
        for word, rank in ranks.items():
            words[rank] = word
        size = np.array([len(x) for x in words], dtype=np.int64)
        begin, table = np.cumsum(size) - size, np.frombuffer(b"".join(words), dtype=np.uint8)
        for batch in batches:
            for row in range(0, batch.num_rows, 200):
                rows = batch.slice(row, 200)
                texts = []
                for ids in rows.column(1).to_pylist():
                    ids = np.frombuffer(ids or b"", dtype=np.uint32)
                    token, place = arrays.ragged(size[ids])
                    texts.append(table[begin[ids][token] + place].tobytes())
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary())], names=[*columns, "decoded"])

    return encoded.select(*columns).mapInArrow(run, schema)
