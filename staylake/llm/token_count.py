"""Token counts by rank-synchronous merging (operator 10).

The different pre-tokens of a piece lie behind each other in one array of symbols. In each round every
sequence that still has a known pair finds its lowest-ranked one and merges all its places, from the left
and without overlap; sequences without a known pair leave the round. What remains is counted.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from staylake.llm import arrays
from staylake.llm.pretokens import Splitter, distinct_slices

NO_PAIR = np.int64(1 << 40)
CACHE = 300_000


def byte_symbols() -> list[str]:
    """The characters that stand for bytes in such vocabularies: printable ones for themselves, the
    others for code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + shifted.index(b)) for b in range(256)]


class Merges:
    """Ranks of symbol pairs from a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.of_byte = np.array([vocab[c] for c in byte_symbols()], dtype=np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order, made
        self.special = [t["content"].encode() for t in spec["added_tokens"] if t["special"]]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], NO_PAIR)

    def counts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Symbols left in each sequence; sequences are not empty."""
        left = lengths.astype(np.int64).copy()
        active = np.flatnonzero(left > 1)
        keep = np.repeat(left > 1, left)
        symbols = self.of_byte[symbols[keep]]
        pair = None
        while len(active):
            size = left[active]
            begin = np.cumsum(size) - size
            if pair is None:
                pair = np.full(len(symbols), NO_PAIR, dtype=np.int64)
                pair[:-1] = self.ranks(symbols[:-1], symbols[1:])
            pair[begin + size - 1] = NO_PAIR  # the last symbol of a sequence has no partner
            lowest = np.minimum.reduceat(pair, begin)
            some = lowest < NO_PAIR
            if not some.all():
                stay = np.repeat(some, size)
                symbols, pair = symbols[stay], pair[stay]
                active, size, lowest = active[some], size[some], lowest[some]
                if not len(active):
                    break
            hit = pair == np.repeat(lowest, size)
            place = np.flatnonzero(hit)
            new = np.ones(len(place), dtype=bool)
            new[1:] = np.diff(place) != 1
            run = np.flatnonzero(new)
            place = place[(np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))) % 2 == 0]
            symbols[place] = self.made[pair[place]]
            stay = np.ones(len(symbols), dtype=bool)
            stay[place + 1] = False
            owner = np.searchsorted(np.cumsum(size), place, side="right")
            left[active] = size - np.bincount(owner, minlength=len(active))
            fresh = np.zeros(len(symbols), dtype=bool)
            fresh[place] = True
            symbols, pair, fresh = symbols[stay], pair[stay], fresh[stay]
            fresh[:-1] |= fresh[1:]
            at = np.flatnonzero(fresh[:-1])
            pair[at] = self.ranks(symbols[at], symbols[at + 1])
        return left


def cut_special(data: np.ndarray, offsets: np.ndarray, special: list[bytes]):
    """Texts without the special strings in them: (bytes, begin of each part, text of each part, strings a text)."""
    raw, n = data.tobytes(), len(offsets) - 1
    found = np.zeros(n, dtype=np.int64)
    if not any(s in raw for s in special):
        return data, offsets, np.arange(n), found
    parts, owner = [], []
    for i, (a, b) in enumerate(zip(offsets.tolist(), offsets[1:].tolist())):
        at = a
        while True:
            hit = min(((p, -len(s)) for s in special if (p := raw.find(s, at, b)) >= 0), default=None)
            parts.append(raw[at : hit[0] if hit else b])
            owner.append(i)
            if not hit:
                break
            found[i] += 1
            at = hit[0] - hit[1]
    sizes = np.cumsum([0, *map(len, parts)])
    return np.frombuffer(b"".join(parts), dtype=np.uint8), sizes, np.array(owner), found


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` and ``n_tokens`` of every text.

    A special string of the vocabulary inside a text is one token. A null text is an empty one: 0 and 0.
    Rows with equal ids are counted each for itself; other columns are left out.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"

    def run(batches):
        merges, splitter, cache = Merges(path), Splitter(), {}
        hashes = arrays.SpanHash(1), arrays.SpanHash(2)
        for batch in batches:
            for rows, whole, texts in arrays.pieces(batch, text_col):
                data, offsets, owner, found = cut_special(whole, texts, merges.special)
                begin = splitter.split(data, offsets)
                end = np.append(begin[1:], len(data))
                first, which = distinct_slices(data, begin, end, hashes)
                if len(cache) > CACHE:
                    cache.clear()
                raw = data.tobytes()
                words = [raw[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist())]
                todo = [w for w in words if w not in cache]
                if todo:
                    sizes = np.array([len(w) for w in todo])
                    left = merges.counts(np.frombuffer(b"".join(todo), dtype=np.uint8), sizes)
                    cache.update(zip(todo, left.tolist()))
                counts = np.array([cache[w] for w in words], dtype=np.int64)
                part = arrays.owners(offsets, begin)
                sums = np.bincount(owner[part], weights=counts[which], minlength=len(found)) if len(begin) else 0
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(texts)), pa.array((found + sums).astype(np.int64))],
                    names=[id_col, "n_bytes", "n_tokens"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
