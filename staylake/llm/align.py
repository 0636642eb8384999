"""Alignment of two tokenizers' tokens by byte intervals (operator 11).

Both tokenizers see a blank and the text. No token of either spans the place before a blank that follows a
character which is no white space, so a text is a sequence of units parted there, and a unit's tokens do not
depend on its neighbours. Documents are worked on in blocks, in which each different unit is encoded and aligned
once (a task also keeps those of the blocks before, of too many those it met most).

Alignment is interval coalescing: the tokens of A and B, sorted together by where they start, and the running
maximum of their ends; a group ends where a start reaches that maximum. Overlaps are expanded within.

A block then is a list of units, where they stand in its documents, and the id pairs that each links. How often
an id pair is linked in the corpus is a sum over blocks; the counts of a block's pairs come back to it, as one
row a pair, and a document's share of them is a sum over its units.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylake.llm import arrays
from staylake.llm.store import bucketed, stored
from staylake.llm.token_count import byte_symbols

#: Text of a block of documents; units that a task remembers; units aligned at once.
BLOCK_BYTES, CACHE, AT_ONCE = 4 << 20, 200_000, 4000
BLANK_PIECE = "▁"


class ByteLevel:
    """Tokenizer A, from a ``.json`` file of byte-level BPE; special strings are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        of_symbol = {c: b for b, c in enumerate(byte_symbols())}
        vocab = self.tokenizer.get_vocab()
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, number in vocab.items():
            self.bytes[number] = bytes(of_symbol[c] for c in token) if all(c in of_symbol for c in token) else token.encode()
        self.sizes = np.array([len(x) for x in self.bytes], dtype=np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, units: list[bytes]) -> list[list[int]]:
        """``units`` begin with a blank. Those that do not end with white space are encoded behind each other in one
        text, in which their tokens are the same."""
        texts = [u.decode() for u in units]
        behind = [i for i, t in enumerate(texts) if t[-1:].isalnum() or "!" <= t[-1:] <= "~"]
        (row,) = self._ids(["".join([texts[i] for i in behind])])
        ends = np.cumsum(self.sizes[row])
        at = np.searchsorted(ends, np.cumsum([len(units[i]) for i in behind]), side="right").tolist()
        out: list = [None] * len(units)
        for i, a, b in zip(behind, [0, *at], at):
            out[i] = row[a:b]
        alone = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(alone, self._ids([texts[i] for i in alone])):
            out[i] = ids
        return out


class Pieces:
    """Tokenizer B, from a ``.model`` file, which sets a blank before what it is given."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(BLANK_PIECE in p.lstrip(BLANK_PIECE) for p in pieces):
            raise ValueError("units do not hold for a vocabulary with pieces that go on behind a blank")
        self.blank = self.model.piece_to_id(BLANK_PIECE)
        self.bytes = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(BLANK_PIECE, " ").encode() for i, p in enumerate(pieces)
        ]

    def encode(self, units: list[bytes]) -> list[list[int]]:
        """``units`` begin with a blank."""
        found = self.model.encode([u[1:].decode() for u in units], num_threads=1)
        return [ids if len(u) > 1 else [self.blank] for u, ids in zip(units, found)]


def units_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with a blank before each text that is not empty, the begin of each unit, and of each text."""
    sizes = np.diff(offsets)
    at = offsets + np.concatenate([[0], np.cumsum(sizes > 0)])
    out = np.full(at[-1], 32, dtype=np.uint8)
    some = np.flatnonzero(sizes)
    own = np.ones(len(out), dtype=bool)
    own[at[some]] = False
    out[own] = data
    back = lambda k: np.concatenate([np.zeros(k, dtype=np.uint8), out[:-k]])[: len(out)]
    one, two, three = back(1), back(2), back(3)
    # Beyond ASCII, any character that shares its first bytes with some white space is taken for one.
    odd = (two == 0xC2) | (np.isin(three, (0xE1, 0xE2, 0xE3)) & np.isin(two, (0x80, 0x81, 0x9A, 0xA0)))
    begins = (out == 32) & (one > 32) & (one != 127) & ~((one >= 128) & odd)
    begins[at[some]] = True
    return out, np.flatnonzero(begins), at


def coalesce(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of intervals by start, and for each, in that order, whether a group begins with it."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    begins = np.ones(len(order), dtype=bool)
    begins[1:] = start[order][1:] >= reach[:-1]
    return order, begins


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of an interval of A and one of B that overlap; either side is sorted and has no overlaps."""
    low = np.searchsorted(b_end, a_start, side="right")
    high = np.searchsorted(b_start, a_end, side="left")
    row, place = arrays.ragged(np.maximum(high - low, 0))
    return row, low[row] + place


def align(a_ids: list[list[int]], b_ids: list[list[int]], a_size: np.ndarray, b_size: np.ndarray):
    """For texts as ids of A and B: ``groups`` as text, how many there are, and the linked ids of each text."""
    a, b = (np.fromiter(itertools.chain.from_iterable(x), dtype=np.int64) for x in (a_ids, b_ids))
    a_end, b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    a_start, b_start = a_end - a_size[a], b_end - b_size[b]
    order, begins = coalesce(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]))
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(begins) - 1
    of_a, of_b = group[: len(a)], group[len(a) :]

    a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
    n = int(group.max()) + 1 if len(group) else 0
    cut_a, cut_b = (np.searchsorted(x, np.arange(n + 1)).tolist() for x in (of_a, of_b))
    written = [
        ",".join(a_text[i:j]) + "|" + ",".join(b_text[k:m]) for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])
    ]
    ends = np.cumsum([len(x) for x in a_ids])  # the first token of the next text begins a group
    to = np.append(of_a, n)[ends].tolist()
    groups = [";".join(written[i:j]) for i, j in zip([0, *to], to)]

    x, y = overlaps(a_start, a_end, b_start, b_end)
    links = np.searchsorted(x, np.concatenate([[0], ends]))
    return groups, np.diff([0, *to]), a[x], b[y], links


class Units:
    """Aligned units that a task has met, by number: their ``groups`` and, row by row, tokens and linked ids."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.sizes = [np.array([len(x) for x in side.bytes], dtype=np.int64) for side in (self.a, self.b)]
        self.clear()

    def clear(self) -> None:
        self.number, self.groups = {}, []
        self.counts = np.zeros((0, 4), dtype=np.int64)  # tokens of A and B, groups, links
        self.pairs = np.zeros(0, dtype=np.int64)
        self.sound = np.zeros(0, dtype=bool)
        self.uses = np.zeros(0, dtype=np.int64)

    def shrink(self) -> None:
        """Forget units until half of the cache is free: those met once, then those met least."""
        kept = np.argsort(-self.uses, kind="stable")[: CACHE // 2]
        kept = np.sort(kept[self.uses[kept] > 1])
        words, places = list(self.number), kept.tolist()
        self.number = {words[i]: k for k, i in enumerate(places)}
        self.groups = [self.groups[i] for i in places]
        self.pairs = self.pairs_of(kept)
        self.counts, self.sound = self.counts[kept], self.sound[kept]
        self.uses = self.uses[kept] // 2  # what is met no more gives way in time

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each unit; equal ones have one."""
        if len(self.number) > CACHE:
            self.shrink()
        find = self.number.get
        found = np.fromiter((find(w, -1) for w in words), dtype=np.int64, count=len(words))
        new = np.flatnonzero(found < 0).tolist()
        todo = list(dict.fromkeys([words[i] for i in new]))
        for low in range(0, len(todo), AT_ONCE):
            self._add(todo[low : low + AT_ONCE])
        found[new] = [find(words[i]) for i in new]
        self.uses += np.bincount(found, minlength=len(self.uses))
        return found

    def _add(self, words: list[bytes]) -> None:
        a, b = self.a.encode(words), self.b.encode(words)
        sound = np.array([b"".join([self.b.bytes[i] for i in ids]) == w for w, ids in zip(words, b)], dtype=bool)
        a, b = ([ids if ok else [] for ids, ok in zip(side, sound)] for side in (a, b))
        groups, n_groups, x, y, at = align(a, b, *self.sizes)
        counts = np.stack([[len(ids) for ids in a], [len(ids) for ids in b], n_groups, np.diff(at)], axis=1)
        self.number.update((w, len(self.groups) + i) for i, w in enumerate(words))
        self.groups += groups
        self.counts = np.concatenate([self.counts, counts])
        self.pairs = np.concatenate([self.pairs, x << 32 | y])
        self.sound = np.concatenate([self.sound, sound])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), dtype=np.int64)])

    def pairs_of(self, numbers: np.ndarray) -> np.ndarray:
        """The linked ids of these units behind each other, as ``a << 32 | b``."""
        size = self.counts[:, 3]
        row, place = arrays.ragged(size[numbers])
        return self.pairs[(np.cumsum(size) - size)[numbers][row] + place]


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """Documents in blocks of bounded size: their ``ids``, the block's different ``pairs`` of ids, how many ``times``
    each is linked, and a ``body``: units a document (``sizes``), the ``places`` of all their units in the block's
    list of different ones, whose ``groups`` and counts follow, and the places of each unit's ``links`` in ``pairs``.

    The body is a compressed Arrow stream of one row, as it is most of what is sent. A document whose pieces do not
    give its bytes back has no units.
    """
    kind = docs.schema[id_col].dataType
    schema = f"block bigint, ids array<{kind.simpleString()}>, body binary, pairs array<bigint>, times array<bigint>"

    def run(batches):
        units = Units(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, text, offsets in arrays.pieces(batch, text_col, BLOCK_BYTES):
                data, begin, texts = units_of(text, offsets)
                raw, edges = data.tobytes(), [*begin.tolist(), len(data)]
                known = units.numbers([raw[a:b] for a, b in zip(edges, edges[1:])])
                owner = arrays.owners(texts, begin)
                sound = units.sound[known]
                if not sound.all():
                    keep = ~np.isin(owner, owner[~sound])
                    known, owner = known[keep], owner[keep]
                own, which, times = np.unique(known, return_inverse=True, return_counts=True)
                used = np.argsort(-times, kind="stable")  # small places for frequent units
                place = np.empty(len(own), dtype=np.uint32)
                place[used] = np.arange(len(own))
                own, times = own[used], times[used]
                sizes = np.bincount(owner, minlength=rows.num_rows).astype(np.int32)
                of_units = units.counts[own]
                linked = units.pairs_of(own)
                pairs, links = np.unique(linked, return_inverse=True)
                weight = np.zeros(len(pairs), dtype=np.int64)
                np.add.at(weight, links, np.repeat(times, of_units[:, 3]))
                body = {
                    "sizes": pa.array([sizes], pa.list_(pa.int32())),
                    "places": pa.array([place[which]], pa.list_(pa.uint32())),
                    "groups": pa.array([[units.groups[i] for i in own.tolist()]], pa.list_(pa.string())),
                    "links": pa.array([links.astype(np.uint32)], pa.list_(pa.uint32())),
                } | {name: pa.array([column.astype(np.int32)], pa.list_(pa.int32())) for name, column in zip(COUNTS, of_units.T)}
                cells = [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(0)),
                    pa.array([_packed(body)], pa.binary()),
                    pa.array([pairs], pa.list_(pa.int64())),
                    pa.array([weight], pa.list_(pa.int64())),
                ]
                number += 1
                yield pa.RecordBatch.from_arrays(cells, names=["block", "ids", "body", "pairs", "times"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _packed(columns: dict[str, pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def counted_pairs(dealt: DataFrame) -> DataFrame:
    """``pair``, its ``count`` over all blocks, and whether that is the ``best`` of its B id (1 or 0)."""
    rows = dealt.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = rows.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    # As many rows a B id as there are A ids at most.
    top = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    return counts.withColumn("best", (F.col("count") == top).cast("long"))


SUMS = [*COUNTS, "n_best", "count_sum"]


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts of tokens of A and B, of groups and links, ``n_best`` and ``count_sum`` of every row,
    and ``groups``: ``a1,a2|b1;a3|b2,b3``, the ids of A and B in each group.

    A text that is null or empty, or whose pieces do not give it back byte by byte, has no tokens: zeros and an
    empty ``groups``, and it does not count towards the pairs. Rows count each for itself, also with equal ids
    or without one. Other columns are left out. ``path_a`` and ``path_b`` are read on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    dealt = bucketed(blocks(docs, path_a, path_b, id_col, text_col), "block", "blocks")
    counts = stored(counted_pairs(dealt), "pair-counts")
    back = dealt.select(F.col("block").alias("home"), F.posexplode("pairs").alias("place", "pair"))
    back = back.join(counts, "pair").select("home", "place", "count", "best")
    names = [id_col, *SUMS, "groups"]

    def gather(block: pa.Table, pairs: pa.Table) -> pa.Table:
        pairs = pairs.sort_by("place")
        body = pa.ipc.open_stream(block.column("body")[0].as_buffer()).read_all()
        cell = lambda name, rows=body: rows.column(name).combine_chunks().flatten()
        ids, ends = cell("ids", block), np.cumsum(cell("sizes").to_numpy())
        begins = np.concatenate([[0], ends[:-1]])
        places, links = cell("places").to_numpy(), cell("links").to_numpy()
        of_units = {c: cell(c).to_numpy().astype(np.int64) for c in COUNTS}
        edge = np.concatenate([[0], np.cumsum(of_units["n_links"])])
        for name, column in (("n_best", "best"), ("count_sum", "count")):
            sums = np.concatenate([[0], np.cumsum(pairs.column(column).to_numpy()[links], dtype=np.int64)])
            of_units[name] = np.diff(sums[edge])
        cells = [ids]
        for name in SUMS:
            sums = np.concatenate([[0], np.cumsum(of_units[name][places], dtype=np.int64)])
            cells.append(pa.array(sums[ends] - sums[begins]))
        texts, parts = cell("groups").to_pylist(), places.tolist()
        cells.append(pa.array([";".join([texts[p] for p in parts[i:j]]) for i, j in zip(begins.tolist(), ends.tolist())], pa.string()))
        return pa.table(cells, names=names)

    sums = ", ".join(f"{c} bigint" for c in SUMS)
    whole = dealt.drop("pairs", "times").groupBy("block")
    return whole.cogroup(back.groupBy("home")).applyInArrow(gather, f"`{id_col}` {kind}, {sums}, groups string")
