"""Benchmark passages in documents by a prefix-filtered set join (operator 6).

An item's windows are its runs of ``width`` words, or all its words if it has fewer. A window is a set of
shingles with positions. Shingles are ordered by rarity, counted over all documents; as a window counts
only when all of it occurs, its prefix is the one rarest shingle. A document's shingles meet the prefixes;
the place of the shingle bounds where the window must begin and end in the document, and the words there
are compared one by one.

The prefixes are a table of the benchmark. Beneath ``broadcast_bytes``, checked on the table itself, they
travel to the tasks, and documents stay where they are. Beyond it shingles and prefixes meet in a shuffle
join and only places that met go on; both ways give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm import arrays
from staylake.llm.store import stored

SHINGLE = 3
BROADCAST_BYTES = 64 << 20


def _words(data, offsets, hashes):
    """Hash and owner of each word, and the first word of each text."""
    data = arrays.LOWER[data]
    begin, end = arrays.word_spans(data, offsets, arrays.ALNUM)
    hashes.load(data)
    return hashes.of(begin, end), np.searchsorted(begin, offsets)


def _shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every run of ``width`` words that lies in one text."""
    found = arrays.grams(words, width)
    last = np.repeat(first[1:], np.diff(first))[: len(found)]
    place = np.flatnonzero(np.arange(len(found)) + width <= last)
    return found[place], place


def windows(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Different windows: ``window`` (hashes of its words), ``items``, and per shingle ``shingle``, ``shift``, ``size``.

    Windows of fewer words than a shingle have shingles of their own length.
    """
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches):
        hashes = arrays.SpanHash(1)
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                words, first = _words(data, offsets, hashes)
                out = {"item": [], "window": [], "shingle": [], "shift": [], "size": []}
                for item, a, b in zip(rows.column(0).to_pylist(), first.tolist(), first[1:].tolist()):
                    for k in range(a, max(b - width, a) + 1) if b > a else ():
                        window = words[k : min(k + width, b)]
                        size = min(SHINGLE, len(window))
                        for shift, shingle in enumerate(arrays.grams(window, size).view(np.int64).tolist()):
                            for name, value in zip(out, (item, window.tobytes(), shingle, shift, size)):
                                out[name].append(value)
                item_type = batch.schema.field(0).type
                types = item_type, pa.binary(), pa.int64(), pa.int32(), pa.int32()
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    schema = f"item {kind}, window binary, shingle bigint, shift int, size int"
    rows = items.select(id_col, text_col).mapInArrow(run, schema)
    return rows.groupBy("window", "shingle", "shift", "size").agg(F.collect_set("item").alias("items"))


def _count(docs: DataFrame, wanted: np.ndarray, sizes: list[int], text_col: str) -> DataFrame:
    """``shingle``, ``n``: how often each wanted shingle occurs in all documents."""

    def run(batches):
        hashes, total = arrays.SpanHash(1), np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for _, data, offsets in arrays.pieces(batch, text_col):
                words, first = _words(data, offsets, hashes)
                for size in sizes:
                    found, _ = _shingles(words, first, size)
                    at = lookup(wanted, found.view(np.int64))
                    total += np.bincount(at[at >= 0], minlength=len(wanted))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted[seen]), pa.array(total[seen])], names=["shingle", "n"])

    return docs.select(text_col).mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))


def lookup(keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted ``keys``, or -1. A table of bits turns most values away first."""
    out = np.full(len(values), -1, dtype=np.int64)
    if not len(keys) or not len(values):
        return out
    bits = max(16, int(len(keys)).bit_length() + 4)
    table = np.zeros(1 << bits, dtype=bool)
    shift = np.uint64(64 - bits)
    table[keys.view(np.uint64) >> shift] = True
    maybe = np.flatnonzero(table[values.view(np.uint64) >> shift])
    at = np.minimum(np.searchsorted(keys, values[maybe]), len(keys) - 1)
    same = keys[at] == values[maybe]
    out[maybe[same]] = at[same]
    return out


def prefixes(docs: DataFrame, table: DataFrame, text_col: str, small: bool) -> DataFrame:
    """The rarest shingle of each window: ``window``, ``items``, ``shingle``, ``shift``, ``size``."""
    if small:
        keys = table.select("shingle", "size").distinct().toPandas()
        wanted = np.sort(keys["shingle"].unique().astype(np.int64))
        counts = _count(docs, wanted, sorted({int(x) for x in keys["size"]}), text_col)
    else:
        counts = shingle_rows(docs.select(F.lit(0).cast("long").alias("id"), text_col), "id", text_col)
        counts = counts.join(table.select("shingle").distinct(), "shingle", "left_semi").groupBy("shingle").agg(
            F.count(F.lit(1)).alias("n")
        )
    ranked = table.join(counts, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    rarest = F.min(F.struct("n", "shingle", "shift", "size", "items")).alias("p")
    return ranked.groupBy("window").agg(rarest).select("window", "p.items", "p.shingle", "p.shift", "p.size")


def shingle_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, ``shingle``, ``place`` of every shingle of one to ``SHINGLE`` words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        hashes = arrays.SpanHash(1)
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                words, first = _words(data, offsets, hashes)
                for size in range(1, SHINGLE + 1):
                    found, place = _shingles(words, first, size)
                    row = np.searchsorted(first, place, side="right") - 1
                    ids = rows.column(0).take(pa.array(row))
                    cells = [ids, pa.array(found.view(np.int64)), pa.array((place - first[row]).astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cells, names=[id_col, "shingle", "place"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, shingle bigint, place int")


class Index:
    """Prefixes sorted by shingle, with the words of their windows behind each other."""

    def __init__(self, rows):
        rows = rows.sort_values("shingle", kind="stable")
        self.items = [sorted(x) for x in rows["items"]]
        self.shingle = rows["shingle"].to_numpy(dtype=np.int64)
        self.shift = rows["shift"].to_numpy(dtype=np.int64)
        self.sizes = sorted({int(x) for x in rows["size"]})
        self.length = np.array([len(x) // 8 for x in rows["window"]], dtype=np.int64)
        self.words = np.frombuffer(b"".join(rows["window"]), dtype=np.uint64)
        self.begin = np.cumsum(self.length) - self.length
        self.keys, self.head = np.unique(self.shingle, return_index=True)
        self.many = np.diff(np.append(self.head, len(self.shingle)))

    @classmethod
    def of(cls, parts: dict) -> Index:
        index = cls.__new__(cls)
        index.__dict__.update(parts)
        return index

    def occurrences(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix and first word of each window that occurs."""
        window, start = [], []
        for size in self.sizes:
            found, place = _shingles(words, first, size)
            at = lookup(self.keys, found.view(np.int64))
            hit = np.flatnonzero(at >= 0)
            row, nth = arrays.ragged(self.many[at[hit]])
            window.append(self.head[at[hit]][row] + nth)
            start.append(place[hit][row])
        window = np.concatenate(window) if window else np.zeros(0, dtype=np.int64)
        place = np.concatenate(start) if start else np.zeros(0, dtype=np.int64)
        return self.verified(words, first, window, place - self.shift[window], place)

    def verified(self, words, first, window, start, place):
        text = np.searchsorted(first, place, side="right") - 1
        fits = (start >= first[text]) & (start + self.length[window] <= first[text + 1])
        window, start = window[fits], start[fits]
        row, nth = arrays.ragged(self.length[window])
        differs = words[start[row] + nth] != self.words[self.begin[window][row] + nth]
        good = np.bincount(row[differs], minlength=len(window)) == 0
        pairs = np.unique(np.stack([window[good], start[good]], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]


OUT = "n_words bigint, n_hit bigint, items array<{item}>, hits array<int>"


def _report(rows, words, first, window, start, length, items, item_type, id_col, keep):
    """A row for each text: its words, how many are hit, the items, and the runs of hit words."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + length, -1)
    hit = np.cumsum(edge)[:-1] > 0
    n_hit = np.diff(np.concatenate([[0], np.cumsum(hit)])[first])
    found = [set() for _ in range(rows.num_rows)]
    for text, w in zip((np.searchsorted(first, start, side="right") - 1).tolist(), window.tolist()):
        found[text].update(items[w])
    runs = [[] for _ in range(rows.num_rows)]
    for text in np.flatnonzero(n_hit).tolist():
        inside = np.concatenate([[0], hit[first[text] : first[text + 1]].view(np.int8), [0]])
        runs[text] = np.flatnonzero(np.diff(inside)).tolist()
    cells = [
        rows.column(0),
        *rows.columns[len(rows.columns) - len(keep) :],
        pa.array(np.diff(first)),
        pa.array(n_hit),
        pa.array([sorted(x) for x in found], pa.list_(item_type)),
        pa.array(runs, pa.list_(pa.int32())),
    ]
    return pa.RecordBatch.from_arrays(cells, names=[id_col, *keep, "n_words", "n_hit", "items", "hits"])


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``id_col``, ``n_words``, ``n_hit``, ``items`` (ids of items with a window in the text), ``hits``.

    The columns in ``keep`` are passed through. ``hits`` holds begin and end of each run of hit words. A null or empty text has no words and no hit,
    an empty benchmark hits nothing, an item without words has no window; items may repeat. Every row is
    judged by its text, whatever its id; equal texts have equal hits.
    """
    table = stored(windows(items, width, item_col, item_text), "windows")
    size = table.select(F.sum(F.octet_length("window") + 8 * F.size("items") + 64)).first()[0] or 0
    small = size <= broadcast_bytes
    chosen = stored(prefixes(docs, table, text_col, small), "prefixes")
    kind, item = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType
    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    schema = f"`{id_col}` {kind}, {kept}" + OUT.format(item=item.simpleString())
    return (_in_place if small else _shuffled)(docs, chosen, schema, item, id_col, text_col, keep)


def _in_place(docs, chosen, schema, item, id_col, text_col, keep):
    from pyspark.sql.pandas.types import to_arrow_type

    index = docs.sparkSession.sparkContext.broadcast(vars(Index(chosen.toPandas())))
    item = to_arrow_type(item)

    def run(batches):
        hashes, table = arrays.SpanHash(1), Index.of(index.value)
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                words, first = _words(data, offsets, hashes)
                window, start = table.occurrences(words, first)
                yield _report(rows, words, first, window, start, table.length[window], table.items, item, id_col, keep)

    return docs.select(id_col, text_col, *keep).mapInArrow(run, schema)


def _shuffled(docs, chosen, schema, item, id_col, text_col, keep):
    """Texts, by their SHA-256, get the places where a prefix met them as a list, which is as long as the text at
    most allows; a text without one gets none."""
    from pyspark.sql.pandas.types import to_arrow_type

    item = to_arrow_type(item)
    whole = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    texts = docs.select(whole.alias("whole"), F.col(text_col).alias("text")).groupBy("whole").agg(F.first("text").alias("text"))
    met = shingle_rows(texts, "whole", "text").join(chosen, "shingle")
    met = met.where("place >= shift").groupBy("whole").agg(
        F.collect_list(F.struct((F.col("place") - F.col("shift")).alias("start"), "window", "items")).alias("met")
    )

    def run(batches):
        hashes = arrays.SpanHash(1)
        for batch in batches:
            for row in range(batch.num_rows):
                for rows, data, offsets in arrays.pieces(batch.slice(row, 1), text_col):
                    words, first = _words(data, offsets, hashes)
                    start, length, found = [], [], []
                    for x in rows.column(2)[0].as_py() or ():
                        wanted = np.frombuffer(x["window"], dtype=np.uint64)
                        if np.array_equal(words[x["start"] : x["start"] + len(wanted)], wanted):
                            start.append(x["start"])
                            length.append(len(wanted))
                            found.append(x["items"])
                    start, length = np.array(start, dtype=np.int64), np.array(length, dtype=np.int64)
                    yield _report(rows, words, first, np.arange(len(start)), start, length, found, item, id_col, keep)

    own = [F.col(f"`{c}`") for c in (id_col, text_col, *keep)]
    rows = docs.select(F.struct(*own).alias("row"), whole.alias("own"))
    rows = rows.join(met, F.col("own") == F.col("whole"), "left")
    row = lambda c: F.col("row")[c].alias(c)
    return rows.select(row(id_col), row(text_col), "met", *[row(c) for c in keep]).mapInArrow(run, schema)
