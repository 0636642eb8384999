"""Near duplicates by SimHash and vantage-point trees (operator 12).

A fingerprint bit is 1 if it is set in over half the hashes of a text's shingles. Equal fingerprints are one
class from the start; classes within ``radius`` bits link.

Distances between unrelated 64-bit fingerprints lie closely around 32, so a tree over all bits prunes next to
nothing at radius 4. Trees are therefore grown over parts of the bits, where the Hamming distance is a metric
too: the bits are dealt to ``m`` parts, and fingerprints that differ in at most ``radius`` bits agree on some
``m - radius`` parts. For every such choice of parts there is a tree that asks for pairs at distance 0 on
those bits; m grows with the number of classes. A node holds a vantage point and a distance: one side lies
within it, the other beyond. Where all sampled points of a node agree on the tree's bits it goes on over all
64 bits: there a fingerprint beyond the distance also enters the inner side if the triangle bound lets a
partner be there, so a dense cluster is cut into shards that overlap at their boundaries. A leaf is a shard. Trees are grown on a
sample of at most ``2 * SAMPLE`` classes, which only balances the shards: every class is routed, and pairs
are exact.

Within a shard, classes that agree on the tree's bits meet; many of them in a local tree over all bits, whose
branches end where the triangle bound parts them or where all their points are joined already.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm import arrays
from staylake.llm.store import components, stored

SEED = 42
RADIUS = 4
#: Classes whose fingerprints are looked at to grow trees; classes of a shard; classes that agree on the bits
#: of a tree beyond which one more part is cut.
SAMPLE, SHARD, CROWD = 8192, 4000, 4096
#: Pairs compared at once; hashes whose bits are counted at once.
PAIRS, CHUNK = 1 << 21, 1 << 17


def _normalised(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased words with one blank between them: bytes, begin and end of each word, first word of each text."""
    data = arrays.LOWER[data]
    begin, end = arrays.word_spans(data, offsets, arrays.NOT_BLANK)
    first = np.searchsorted(begin, offsets)
    inside = arrays.NOT_BLANK[data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    place = np.concatenate([[0], np.cumsum(keep)])
    out = np.where(inside, data, np.uint8(32))[keep]
    return out, place[begin], place[end - 1] + 1 if len(end) else end, first


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint of each text as an unsigned number; 0 without words."""
    words, begin, end, first = _normalised(data, offsets)
    count = np.diff(first)
    size = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    row, place = arrays.ragged(size)
    at = first[:-1][row] + place
    last = np.minimum(at + n, first[1:][row]) - 1
    raw, digest = words.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(raw[a:b], SEED) for a, b in zip(begin[at].tolist(), end[last].tolist())), dtype=np.uint64, count=len(at)
    )
    sums = np.zeros((len(count), 64), dtype=np.int64)
    for low in range(0, len(hashes), CHUNK):
        part, owner = hashes[low : low + CHUNK], row[low : low + CHUNK]
        head = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums[owner[head]] += np.add.reduceat(bits, head, axis=0, dtype=np.int64)
    more = (2 * sums > size[:, None]).astype(np.uint64)
    return (more << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, n: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp`` (64 bits, as a signed number) of every row; a null text is an empty one."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                found = fingerprints_of(data, offsets, n).view(np.int64)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found)], names=["id", "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp bigint")


def distance(a, b, mask=np.uint64(2**64 - 1)) -> np.ndarray:
    return np.bitwise_count((a ^ b) & mask).astype(np.int64)


def masks(classes: int, radius: int) -> list[np.uint64]:
    """Bits of each tree: every choice of all but ``radius`` of m parts, m as small as crowds allow."""
    m = radius + 1
    while m < 2 * radius and classes / 2 ** (64 * (m - radius) / m) > CROWD:
        m += 1
    ends = [64 * k // m for k in range(m + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])]
    return [np.uint64(sum(chosen)) for chosen in itertools.combinations(parts, m - radius)]


class Tree:
    """A vantage-point tree whose leaves are shards. Pairs looked for agree on ``mask`` and differ in at most
    ``radius`` bits."""

    def __init__(self, sample: np.ndarray, mask: np.uint64, radius: int, leaf: int):
        self.mask, self.radius, self.leaves = mask, radius, 0
        self.root = self._grow(sample, leaf)

    def _leaf(self):
        self.leaves += 1
        return self.leaves - 1

    def _grow(self, points: np.ndarray, leaf: int):
        if len(points) <= leaf:
            return self._leaf()
        mask, reach = self.mask, 0
        if not ((points ^ points[0]) & mask).any():
            mask, reach = np.uint64(2**64 - 1), self.radius
        best = None
        for vantage in points[:: max(1, len(points) // 8)][:8]:
            d = distance(points, vantage, mask)
            for cut in {int(np.quantile(d, q)) for q in (0.25, 0.5, 0.75)}:
                inner, outer = np.count_nonzero(d <= cut + reach), np.count_nonzero(d > cut)
                if best is None or max(inner, outer) < best[0]:
                    best = max(inner, outer), vantage, cut, d
        size, vantage, cut, d = best
        if size > 0.8 * len(points) and reach or size == len(points):
            return self._leaf()
        return vantage, mask, cut, reach, self._grow(points[d <= cut + reach], leaf), self._grow(points[d > cut], leaf)

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the points and the leaves they enter, more than one for a point near a boundary."""
        index, leaf, todo = [], [], [(self.root, np.arange(len(points)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if isinstance(node, int):
                index.append(at)
                leaf.append(np.full(len(at), node))
                continue
            vantage, mask, cut, reach, inner, outer = node
            d = distance(points[at], vantage, mask)
            todo += [(inner, at[d <= cut + reach]), (outer, at[d > cut])]
        if not index:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(index), np.concatenate(leaf)


class Links:
    """Components among the points of a shard, joined by exact comparison."""

    def __init__(self, points: np.ndarray, radius: int):
        self.points, self.radius = points, radius
        self.root = np.arange(len(points))

    def top(self, x: np.ndarray) -> np.ndarray:
        up = self.root[x]
        while not np.array_equal(up, above := self.root[up]):
            up = above
        return up

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while True:
            a, b = self.top(x), self.top(y)
            apart = a != b
            if not apart.any():
                return
            x, y = a[apart], b[apart]
            self.root[np.maximum(x, y)] = np.minimum(x, y)

    def one(self, *groups: np.ndarray) -> bool:
        tops = [self.top(g) for g in groups]
        return all((t == tops[0][0]).all() for t in tops)

    def among(self, classes: np.ndarray) -> None:
        """Compare all points of each class; ``classes`` holds the end of the class of each point."""
        here = np.arange(len(classes))
        partners = classes - here - 1
        done = 0
        sums = np.concatenate([[0], np.cumsum(partners)])
        while done < len(classes):
            stop = max(done + 1, int(np.searchsorted(sums, sums[done] + PAIRS, side="right")) - 1)
            row, place = arrays.ragged(partners[done:stop])
            x = row + done
            y = x + 1 + place
            near = distance(self.points[x], self.points[y]) <= self.radius
            self.join(x[near], y[near])
            done = stop

    def within(self, at: np.ndarray) -> None:
        """All pairs of ``at``, by a tree: near points of the vantage are joined, parts beyond reach are not met."""
        if len(at) ** 2 <= 2 * PAIRS:
            self.between(at, at)
            return
        d = distance(self.points[at], self.points[at[0]])
        near = at[d <= self.radius]
        self.join(near, np.full(len(near), at[0]))
        if self.one(at):
            return
        cut = int(np.median(d))
        if d.max() == cut:
            cut -= 1
        inner, outer = at[d <= cut], at[d > cut]
        if not len(inner):
            self.between(at, at)
            return
        self.within(inner)
        self.within(outer)
        self.between(at[(d <= cut) & (d > cut - self.radius)], at[(d > cut) & (d <= cut + self.radius)])

    def between(self, left: np.ndarray, right: np.ndarray) -> None:
        if not len(left) or not len(right) or self.one(left, right):
            return
        if len(left) * len(right) <= 2 * PAIRS:
            x, y = np.nonzero(distance(self.points[left][:, None], self.points[right][None, :]) <= self.radius)
            self.join(left[x], right[y])
            return
        vantage = self.points[left[0] if len(left) >= len(right) else right[0]]
        a, b = distance(self.points[left], vantage), distance(self.points[right], vantage)
        cut = int(np.median(a if len(left) >= len(right) else b))
        r = self.radius
        parts = [
            (left[a <= cut], right[b <= cut]),
            (left[a > cut], right[b > cut]),
            (left[(a <= cut) & (a > cut - r)], right[(b > cut) & (b <= cut + r)]),
            (left[(a > cut) & (a <= cut + r)], right[(b <= cut) & (b > cut - r)]),
        ]
        if any(len(x) == len(left) and len(y) == len(right) for x, y in parts):  # no vantage parts these
            step = max(1, 2 * PAIRS // len(right))
            parts = [(left[k : k + step], right[j : j + PAIRS]) for k in range(0, len(left), step) for j in range(0, len(right), PAIRS)]
        for x, y in parts:
            self.between(x, y)


def joined(points: np.ndarray, mask: np.uint64, radius: int) -> np.ndarray:
    """For each point the smallest index of its component, among points that agree on ``mask``."""
    order = np.lexsort((np.arange(len(points)), points & mask))
    key = (points & mask)[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    end = np.append(head[1:], len(key))
    size = end - head
    links = Links(points[order], radius)
    ends = np.repeat(end, size)
    crowded = size * size > 2 * PAIRS
    ends[np.repeat(crowded, size)] = np.flatnonzero(np.repeat(crowded, size)) + 1  # these meet in trees
    links.among(ends)
    for c in np.flatnonzero(crowded).tolist():
        links.within(np.arange(head[c], end[c]))
    top = links.top(np.arange(len(points)))
    least = np.full(len(points), len(points))
    np.minimum.at(least, top, order)
    out = np.empty(len(points), dtype=np.int64)
    out[order] = least[top]
    return out


def near_classes(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a``, ``b`` that connect the classes (``fp``, all different, and ``rep``) within ``radius`` bits."""
    total = classes.count()
    share = min(0.25, SAMPLE / max(total, 1))
    drawn = classes.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).select("fp").limit(2 * SAMPLE)
    sample = np.sort(np.array([r.fp for r in drawn.collect()], dtype=np.int64)).view(np.uint64)
    leaf = max(8, math.ceil(SHARD * len(sample) / max(total, 1)))
    trees = [Tree(sample, mask, radius, leaf) for mask in masks(total, radius)]
    kind = classes.schema["rep"].dataType.simpleString()

    def route(batches):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, tree in enumerate(trees):
                index, shard = tree.route(points)
                rows = batch.take(pa.array(index))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), number, dtype=np.int32)), pa.array(shard.astype(np.int32)), *rows.columns],
                    names=["tree", "shard", "fp", "rep"],
                )

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("rep")
        points = table.column("fp").to_numpy().view(np.uint64)
        least = joined(points, trees[table.column("tree")[0].as_py()].mask, radius)
        other = np.flatnonzero(least != np.arange(len(points)))
        reps = table.column("rep").combine_chunks()
        return pa.table({"a": reps.take(pa.array(other)), "b": reps.take(pa.array(least[other]))})

    routed = classes.select("fp", "rep").mapInArrow(route, f"tree int, shard int, fp bigint, rep {kind}")
    return routed.groupBy("tree", "shard").applyInArrow(meet, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, n: int = 4, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id that can be reached by links, the row's own included. A null text or
    one without words has the fingerprint zero, which links like any other. Rows that share an id are one
    document; a row without an id has a fingerprint and no component. Other columns are left out.
    """
    rows = stored(fingerprints(docs, n, id_col, text_col), "fingerprints")
    classes = rows.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep"))
    classes = stored(classes, "classes")
    found = components(docs.sparkSession, near_classes(classes, radius))
    named = classes.join(found, classes.rep == found.node, "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    # Two plain tables, so that a fingerprint of very many documents can be split.
    return rows.join(stored(named, "named"), "fp", "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
