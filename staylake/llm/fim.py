"""Fill-in-middle transformation (operator 13).

A text is cut into units (a run of ASCII letters, or any other single code point) and parted at two of their
boundaries, chosen by a hash of its id. The cuts are found by a Fenwick tree over fixed blocks of the text: a
node holds how many units and how many code points begin in its blocks. The descent by falling powers of two
finds the block of a cut and the code points before it; only that block is looked at unit by unit. Trees of
all texts of a piece lie behind each other and are built and descended at once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm import arrays

BLOCK = 1024
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True


class Fenwick:
    """Prefix sums over the blocks of many texts. ``blocks[i]``: how many blocks text i has, at least one."""

    def __init__(self, blocks: np.ndarray, *counts: np.ndarray):
        self.blocks = blocks
        self.base = np.cumsum(blocks) - blocks - 1  # node k (from 1) of text i lies at base[i] + k
        _, place = arrays.ragged(blocks)
        node, size = place + 1, np.repeat(blocks, blocks)
        low = node & -node
        self.trees = [c.astype(np.int64).copy() for c in counts]
        step = 1
        while len(blocks) and step < blocks.max():
            at = np.flatnonzero((low == step) & (node + step <= size))
            for tree in self.trees:
                tree[at + step] += tree[at]
            step *= 2

    def descend(self, text: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """For the entry ``rank`` (from 0, by the first count) of each text: its block, its rank in the block,
        and the further counts of all blocks before."""
        block, left = np.zeros(len(text), dtype=np.int64), rank.astype(np.int64).copy()
        before = [np.zeros(len(text), dtype=np.int64) for _ in self.trees[1:]]
        step = 1 << (int(self.blocks.max()).bit_length() - 1) if len(text) else 0
        while step:
            at = np.minimum(block + step, self.blocks[text]) + self.base[text]
            go = (block + step <= self.blocks[text]) & (self.trees[0][at] <= left)
            left[go] -= self.trees[0][at[go]]
            for total, tree in zip(before, self.trees[1:]):
                total[go] += tree[at[go]]
            block[go] += step
            step //= 2
        return block, left, before


def cut_texts(data: np.ndarray, offsets: np.ndarray, choose, block: int = BLOCK):
    """Units of each text, and for the two cuts that ``choose(i, units)`` names: bytes and code points before."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    letter = LETTER[data]
    point = (data & 0xC0) != 0x80
    unit = point.copy()
    unit[1:] &= ~(letter[1:] & letter[:-1]) | first[1:-1]

    some = np.flatnonzero(sizes)
    blocks = -(-sizes[some] // block)
    row, place = arrays.ragged(blocks)
    begins = offsets[some][row] + place * block
    if len(some):
        of_unit, of_point = (np.add.reduceat(x, begins, dtype=np.int64) for x in (unit, point))
    else:
        of_unit = of_point = np.zeros(0, dtype=np.int64)
    tree = Fenwick(blocks, of_unit, of_point)
    units, points = (np.zeros(n, dtype=np.int64) for _ in range(2))
    np.add.at(units, some[row], of_unit)
    np.add.at(points, some[row], of_point)

    cuts = np.array([choose(i, int(units[i])) for i in range(n)], dtype=np.int64).reshape(n, 2)
    in_bytes, in_points = np.repeat(sizes, 2).reshape(n, 2), np.repeat(points, 2).reshape(n, 2)
    for k in range(2):
        asked = np.flatnonzero(cuts[some, k] < units[some])  # a cut behind all units is the end of the text
        number, rest, (before,) = tree.descend(asked, cuts[some[asked], k])
        for i, b, r, p in zip(some[asked].tolist(), number.tolist(), rest.tolist(), before.tolist()):
            low = int(offsets[i]) + b * block
            at = int(np.flatnonzero(unit[low : min(low + block, int(offsets[i + 1]))])[r])
            in_bytes[i, k] = b * block + at
            in_points[i, k] = p + int(np.count_nonzero(point[low : low + at]))
    return units, in_bytes, in_points


def hash_numbers(seed: int, id_: object) -> list[int]:
    """The first four groups of eight hex digits of SHA-256 over ``seed:id``."""
    digest = hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).digest()
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


def transform(
    docs: DataFrame, seed: int = 1, rate: int = 90, spm_rate: int = 20, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK
) -> DataFrame:
    """``id_col``, ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``rate`` per cent of the texts are transformed, of these ``spm_rate`` per cent with the suffix in front.
    A text that is empty or holds one of the marks stays plain, without counts of code points; a null text is
    an empty one. A row without an id is hashed with nothing for its id. Rows with equal ids and texts give
    equal rows; other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n", "form", "prefix_chars", "middle_chars", "output"]
    schema = f"`{id_col}` {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def run(batches):
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                numbers = [hash_numbers(seed, x) for x in rows.column(0).to_pylist()]
                units, cuts, points = cut_texts(data, offsets, lambda i, n: sorted(h % (n + 1) for h in numbers[i][:2]), block)
                raw, at = data.tobytes(), offsets.tolist()
                forms, out = [], []
                for i, h in enumerate(numbers):
                    text = raw[at[i] : at[i + 1]]
                    form = SPM if h[3] % 100 < spm_rate else PSM
                    if not text or h[2] % 100 >= rate or p in text or s in text or m in text:
                        form = PLAIN
                    a, b = cuts[i].tolist()
                    if form == PSM:
                        text = b"".join((p, text[:a], s, text[b:], m, text[a:b]))
                    elif form == SPM:
                        text = b"".join((s, text[b:], p, text[:a], m, text[a:b]))
                    forms.append(form)
                    out.append(text)
                plain = np.array([f == PLAIN for f in forms], dtype=bool)
                cells = [
                    rows.column(0),
                    pa.array(units),
                    pa.array(forms, pa.string()),
                    pa.array(points[:, 0], mask=plain),
                    pa.array(points[:, 1] - points[:, 0], mask=plain),
                    pa.array(out, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(cells, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text from which ``output`` was made. A transformed text holds no mark, so the first three part it."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == PSM, F.concat(part[1], part[3], part[2]))
        .when(form == SPM, F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
