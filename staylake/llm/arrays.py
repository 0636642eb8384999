"""Numpy helpers for tasks: a batch of texts as one byte array, word spans and hashes of spans.

A batch is worked on in pieces of about ``PIECE`` bytes, cut between texts, so a task's memory depends
on the longest text and not on the rows of a batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of `[^\x20\x09-\x0D]`: everything but the six blanks.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`: digits, lower-case letters and all beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def text_bytes(column: pa.Array, kind: pa.DataType = pa.large_string()) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts behind each other, and where each begins (nulls are empty).

    Byte strings have ``kind`` ``pa.large_binary()``.
    """
    column = pc.fill_null(column.cast(kind), "" if kind == pa.large_string() else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batch: pa.RecordBatch, text: str = "text", size: int = PIECE):
    """Runs of rows with about ``size`` bytes of text: (rows, bytes, begin of each text)."""
    if not batch.num_rows:
        return
    column = batch.column(batch.schema.get_field_index(text))
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    number = (np.cumsum(sizes, dtype=np.int64) - sizes) // size
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        data, offsets = text_bytes(column.slice(a, b - a))
        yield batch.slice(a, b - a), data, offsets


def owners(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Index of the text in which each byte position lies."""
    return np.searchsorted(offsets, at, side="right") - 1


def word_spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of word bytes; runs end with their text."""
    inside = in_word[data]
    if not len(inside):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64, fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHash:
    """Polynomial hash of byte spans modulo 2^64, over random codes of the bytes."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.codes = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1, 2**62)) * 8 + 5
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def load(self, data: np.ndarray) -> None:
        """Take the bytes whose spans are asked for next."""
        n = len(data) + 1
        if len(self.power) < n:
            for name, factor in (("power", self.base), ("inverse", pow(self.base, -1, 2**64))):
                row = np.full(n, factor, dtype=np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(self.codes[data] * self.power[: n - 1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def grams(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` neighbours, one for each place where a run can begin."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, np.uint64(0x9E3779B97F4A7C15 + seed), dtype=np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(0xD1342543DE82EF95) + hashes[k : k + n])
    return out


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of these lengths laid behind each other: row and place within the row of each cell."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def binaries(parts: np.ndarray, offsets: np.ndarray, kind=np.uint8) -> pa.Array:
    """A column of byte strings: row i is parts[offsets[i]:offsets[i + 1]] as ``kind``."""
    flat = np.ascontiguousarray(parts, dtype=kind)
    at = (np.asarray(offsets, dtype=np.int64) * flat.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(flat)])
