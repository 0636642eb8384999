"""Removal of repeated byte strings with a sparse suffix array (operator 4).

Every byte covered by a string of ``length`` bytes that also starts earlier goes. Suffixes are not sorted
from every byte: each window of ``length`` bytes is stood for by an anchor in it, the place whose next
``GRAM`` bytes hash lowest (the leftmost of equals), and equal windows have their anchor at the same place.
A document has about one anchor for each 38 bytes.

0. Texts that equal an earlier one go whole and take no further part.
1. Anchors whose hash occurs once are dropped: their windows are unique. Hashes are compared within blocks
   of anchors first, then one row for each block and hash goes to a shuffle.
2. For each other anchor, the bytes of all its windows go to a bucket. Spark samples splitters and
   range-partitions by the leading bytes at the anchor, then by document and place, so a passage that very
   many documents share is cut over several buckets.
3. A bucket sorts its suffixes by multikey quicksort: by one 8-byte word at a time, and only those still
   equal go on to the next word. Of equal neighbours all but the earliest are repeats with all their
   windows; the different ones of an anchor are compared window by window.
4. Only the first and the last anchor of a bucket can go on in a neighbouring bucket. For these the
   windows that are new in the bucket are compared across buckets by an aggregation over their hashes.
5. The spans of each document are merged and cut out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylake.llm import arrays
from staylake.llm.store import partitions_for, stored

GRAM = 20
#: Input for each bucket of suffixes, and for each task that compares hashes of anchors.
BUCKET_BYTES = 7 << 19
DEAL_BYTES = 28 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, hashes: arrays.SpanHash):
    """Hash, place, and first and last window begin, of each anchor of all texts.

    A place that is the lowest for several runs of windows is one anchor for each run; runs are merged, as
    the windows between them have the same gram elsewhere and cost only a little more to carry.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none.view(np.uint64), none, none, none
    hashes.load(data)
    begin = np.arange(len(data) - GRAM + 1)
    gram = hashes.of(begin, begin + GRAM)
    width = length - GRAM + 1
    # One number orders places by the upper bits of their hash, then from left to right.
    bits = np.uint64(max(24, len(data).bit_length()))
    low, step = gram >> bits << bits | begin.view(np.uint64), 1  # the lowest of ``step`` neighbours
    while step < width:
        by = min(step, width - step)
        low = np.minimum(low[:-by], low[by:])
        step += by
    at = (low & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    text = arrays.owners(offsets, begin[: len(at)])
    inside = begin[: len(at)] + length <= offsets[text + 1]
    window, at = begin[: len(at)][inside], at[inside]
    if not len(window):
        return none.view(np.uint64), none, none, none
    head = np.flatnonzero(np.concatenate([[True], np.diff(at) != 0]))
    tail = np.append(head[1:], len(at)) - 1
    return gram[at[head]], at[head], window[head], window[tail]


BLOCK = 1 << 20
ONCE, OFTEN, SURE = 0, 1, 2


def _marked(docs, length, id_col, text_col):
    """``id``, ``gram``, ``mark``: of each block of anchors, every hash once, to be looked for elsewhere.

    A hash that stands several times in its block is known to repeat: all its rows come out as ``SURE``,
    and the one that is looked for elsewhere as ``OFTEN``. So however many documents share a passage, a
    hash has one row a block to be compared.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def block(ids, grams, id_type):
        ids, grams = pa.concat_arrays(ids), np.concatenate(grams)
        _, first, inverse, count = np.unique(grams, return_index=True, return_inverse=True, return_counts=True)
        sure = np.flatnonzero(count[inverse] > 1)
        at = np.concatenate([first, sure])
        mark = np.concatenate([np.where(count > 1, OFTEN, ONCE), np.full(len(sure), SURE)]).astype(np.int8)
        cells = [ids.take(pa.array(at)), pa.array(grams[at].view(np.int64)), pa.array(mark)]
        return pa.RecordBatch.from_arrays(cells, names=["id", "gram", "mark"])

    def run(batches):
        hashes, ids, grams, size = arrays.SpanHash(3), [], [], 0
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                gram, place, _, _ = anchors(data, offsets, length, hashes)
                ids.append(rows.column(0).take(pa.array(arrays.owners(offsets, place))))
                grams.append(gram)
                size += len(gram)
                if size >= BLOCK:
                    yield block(ids, grams, batch.schema.field(0).type)
                    ids, grams, size = [], [], 0
        if size:
            yield block(ids, grams, ids[0].type)

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, gram bigint, mark tinyint")


def _copies(docs, id_col, text_col) -> DataFrame:
    """``id`` and ``stop``, the size, of texts that equal one of a smaller id.

    They go whole, and nothing needs to be compared with them: what they hold starts earlier elsewhere.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).alias("id"), F.sha2(text.cast("binary"), 256).alias("name"), F.octet_length(text).alias("stop"))
    first = stored(named.groupBy("name").agg(F.min("id").alias("first")), "names")
    return named.join(first, "name").where(F.col("id") != F.col("first")).select("id", "stop").distinct()


def _repeated(marked: DataFrame, partitions: int) -> DataFrame:
    """``id`` and ``grams``, its hashes that stand somewhere else too."""
    kind = marked.schema["id"].dataType.simpleString()
    key = F.when(F.col("mark") == SURE, F.xxhash64("id")).otherwise(F.col("gram"))

    def run(batches):
        batches = list(batches)
        if not sum(b.num_rows for b in batches):
            return
        rows = pa.Table.from_batches(batches).combine_chunks()
        grams, mark = rows.column("gram").to_numpy(), rows.column("mark").to_numpy()
        asked = np.flatnonzero(mark != SURE)
        _, inverse, count = np.unique(grams[asked], return_inverse=True, return_counts=True)
        often = np.bincount(inverse, weights=mark[asked] == OFTEN, minlength=len(count)) > 0
        known = asked[((count > 1) | often)[inverse]]
        at = np.concatenate([np.flatnonzero(mark == SURE), known])
        if not len(at):
            return
        ids = rows.column("id").to_numpy()[at]
        order = np.argsort(ids, kind="stable")
        ids, grams = ids[order], grams[at][order]
        head = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(head, len(ids)).astype(np.int32)), pa.array(grams))
        yield pa.RecordBatch.from_arrays([pa.array(ids[head], rows.schema.field("id").type), lists], names=["id", "grams"])

    found = marked.repartition(partitions, key).mapInArrow(run, f"id {kind}, grams array<bigint>")
    return found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("grams"))).alias("grams"))


SEGMENT = "id {kind}, place int, first int, last int, bytes binary"


def _segments(docs, length, id_col, text_col, kind):
    """For each anchor in ``grams``: its windows' bytes. Windows of an anchor: first to last begin."""

    def run(batches):
        hashes = arrays.SpanHash(3)
        for batch in batches:
            grams = batch.column(2)
            done = 0
            for rows, data, offsets in arrays.pieces(batch, text_col):
                gram, place, first, last = anchors(data, offsets, length, hashes)
                wanted = grams.slice(done, rows.num_rows)
                done += rows.num_rows
                text = arrays.owners(offsets, place)
                names = np.unique(wanted.flatten().to_numpy(zero_copy_only=False))
                keep = np.flatnonzero(np.isin(gram.view(np.int64), names))
                place, first, last, text = place[keep], first[keep], last[keep], text[keep]
                raw = data.tobytes()
                parts = [raw[a:b] for a, b in zip(first.tolist(), (last + length).tolist())]
                cells = [
                    rows.column(0).take(pa.array(text)),
                    *(pa.array((x - offsets[text]).astype(np.int32)) for x in (place, first, last)),
                    pa.array(parts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(cells, names=["id", "place", "first", "last", "bytes"])

    return docs.select(id_col, text_col, "grams").mapInArrow(run, SEGMENT.format(kind=kind))


def multikey_sort(words: np.ndarray, tie: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words``, one column at a time, then by ``tie``; and the class of equal rows.

    Rows that a column tells apart are not looked at again: only classes of several rows go on.
    """
    n = len(words)
    order = np.lexsort(tie[::-1]) if tie else np.arange(n)
    group = np.zeros(n, dtype=np.int64)  # by position in the order; numbers grow, with gaps
    todo = np.arange(n)
    for k in range(words.shape[1]):
        rows = order[todo]
        by = np.lexsort((words[rows, k], group[todo]))
        order[todo] = rows[by]
        word, own = words[order[todo], k], group[todo]
        new = np.ones(len(todo), dtype=bool)
        new[1:] = (np.diff(own) != 0) | (word[1:] != word[:-1])
        group[todo] = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
        size = np.diff(np.append(np.flatnonzero(new), len(todo)))
        todo = todo[np.repeat(size > 1, size)]
        if not len(todo):
            break
    return order, group


CHUNK = 4096


def _suffix_words(data, at, sizes, left, length) -> np.ndarray:
    """Each string as words to sort by: rightwards from its anchor, then leftwards from it, then its extent.

    String i is ``data[at[i]:at[i] + sizes[i]]`` with ``left[i]`` bytes before the anchor.
    """
    right, wide = -(-length // 8) * 8, -(-(length - GRAM) // 8) * 8
    grid = np.zeros((len(at), right + wide + 8), dtype=np.uint8)
    for low in range(0, len(at), CHUNK):
        s = slice(low, low + CHUNK)
        row, nth = arrays.ragged(sizes[s])
        value = data[at[s][row] + nth]
        nth -= left[s][row]
        grid[s][row, np.where(nth >= 0, nth, right - 1 - nth)] = value
    words = grid.view(">u8").astype(np.uint64)
    words[:, -1] = left.astype(np.uint64) << np.uint64(32) | sizes.astype(np.uint64)
    return words


def _bucket(batches, length, id_type):
    """Repeats among the suffixes of one bucket; the windows of its outer anchors for the other buckets."""
    batches = list(batches)
    if not sum(b.num_rows for b in batches):
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    del batches
    ids = rows.column("id").to_numpy()
    _, once = np.unique(np.stack([ids, rows.column("first").to_numpy()], 1), axis=0, return_index=True)
    if len(once) < len(ids):  # rows of documents that stand in the table twice
        rows = rows.take(pa.array(once)).combine_chunks()
        ids = rows.column("id").to_numpy()
    place, first, last = (rows.column(c).to_numpy().astype(np.int64) for c in ("place", "first", "last"))
    data, at = arrays.text_bytes(rows.column("bytes").chunk(0), pa.large_binary())
    at, sizes = at[:-1], np.diff(at)
    words = _suffix_words(data, at, sizes, place - first, length)
    order, same = multikey_sort(words, (ids, first))
    head = np.concatenate([[True], np.diff(same) != 0])
    lead = words[order, : GRAM // 8]
    del words
    anchor = np.cumsum(np.concatenate([[True], (lead[1:] != lead[:-1]).any(axis=1)])) - 1
    outer = (anchor == 0) | (anchor == anchor[-1])

    again = order[~head]  # an equal neighbour is earlier
    yield from _spans(id_type, ids[again], first[again], last[again] + length)
    many = np.bincount(anchor[head], minlength=anchor[-1] + 1) > 1
    rest = np.flatnonzero(head & (many[anchor] | outer))
    hashes = arrays.SpanHash(4), arrays.SpanHash(5)
    waiting: list = []
    for low in range(0, len(rest), CHUNK):
        chosen = rest[low : low + CHUNK]
        own = anchor[chosen]
        done = np.searchsorted(own, anchor[rest[low + CHUNK]]) if low + CHUNK < len(rest) else len(own)
        found = _windows(data, at, sizes, first, order[chosen], length, hashes)
        side = np.repeat(outer[chosen], sizes[order[chosen]] - length + 1)
        cut = int((sizes[order[chosen[:done]]] - length + 1).sum())
        found = (*found, side)
        if not done:  # one anchor beyond this chunk
            waiting.append(found)
            continue
        whole = [np.concatenate(x) for x in zip(*waiting, tuple(f[:cut] for f in found))]
        waiting = [tuple(f[cut:] for f in found)]
        yield from _compared(id_type, ids, whole, length)


def _windows(data, at, sizes, first, who, length, hashes):
    """Two hashes, row and begin of every window of the strings ``who``."""
    row, nth = arrays.ragged(sizes[who])
    text = data[at[who][row] + nth]
    begin = np.cumsum(sizes[who]) - sizes[who]
    row, nth = arrays.ragged(sizes[who] - length + 1)
    begin = begin[row] + nth
    found = []
    for h in hashes:
        h.load(text)
        found.append(h.of(begin, begin + length))
    return *found, who[row].astype(np.int32), (first[who][row] + nth).astype(np.int32)


def _compared(id_type, ids, windows, length):
    """Of equal windows all but the earliest are repeats; the earliest of outer anchors go on."""
    one, two, who, begin, side = windows
    by = np.lexsort((begin, ids[who], two, one))
    one, two, who, begin, side = one[by], two[by], who[by], begin[by], side[by]
    fresh = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    yield from _spans(id_type, *_runs(ids[who[~fresh]], begin[~fresh], length))
    far = fresh & side
    yield from _spans(id_type, ids[who[far]], begin[far], begin[far] + length, one[far], two[far])


def _spans(id_type, ids, begin, stop, one=None, two=None):
    if not len(ids):
        return
    hashes = [pa.nulls(len(ids), pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in (one, two)]
    cells = [pa.array(ids, id_type), pa.array(begin.astype(np.int32)), pa.array(stop.astype(np.int32)), *hashes]
    yield pa.RecordBatch.from_arrays(cells, names=["id", "begin", "stop", "one", "two"])


def _runs(ids, begin, length):
    """Spans covered by windows at these begins, windows of neighbouring begins together."""
    if not len(ids):
        return ids, begin, begin
    by = np.lexsort((begin, ids))
    ids, begin = ids[by], begin[by]
    new = np.concatenate([[True], (np.diff(ids) != 0) | (np.diff(begin) > 1)])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(ids)) - 1
    return ids[head], begin[head], begin[tail] + length


def repeated_spans(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``begin``, ``stop``: byte spans to remove, which may overlap.

    The earlier of two places is that of the smaller id, or in one text the one that begins first. Ids are
    integers and differ where texts do; a row that repeats is one document. A row without an id is compared
    with none. Texts under ``length`` bytes, empty and null ones have no spans.
    """
    docs = docs.where(F.col(id_col).isNotNull())
    if length < GRAM + 8:
        raise ValueError(f"strings of at least {GRAM + 8} bytes")
    kind = docs.schema[id_col].dataType.simpleString()
    copies = stored(_copies(docs, id_col, text_col), "copies")
    marked = _marked(docs, length, id_col, text_col)
    kept = _repeated(marked, partitions_for(docs, text_col, DEAL_BYTES)).join(copies, "id", "left_anti")
    kept = stored(kept, "anchors")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(kept.hint("merge"), "id")
    parts = _segments(texts, length, "id", "text", kind)
    lead = F.substring("bytes", F.col("place") - F.col("first") + 1, F.lit(GRAM))
    parts = parts.repartitionByRange(partitions_for(docs, text_col, BUCKET_BYTES), lead, "id", "first")
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    found = parts.mapInArrow(
        lambda batches: _bucket(batches, length, id_type), f"id {kind}, begin int, stop int, one bigint, two bigint"
    )
    found = stored(found, "repeats")
    edges = found.where("one is not null")
    least = edges.groupBy("one", "two").agg(F.min(F.struct("id", "begin")).alias("earliest"))
    far = edges.join(least, ["one", "two"]).where("id <> earliest.id or begin <> earliest.begin")
    whole = copies.where(F.col("stop") >= length).select("id", F.lit(0).alias("begin"), "stop")
    return found.where("one is null").select("id", "begin", "stop").union(far.select("id", "begin", "stop")).union(whole)


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (the bytes left).

    The bytes left may break a character in two, so they are binary. A null text is an empty one; a row
    without an id keeps its bytes; other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    spans = repeated_spans(docs, length, id_col, text_col).groupBy("id").agg(
        F.collect_list(F.struct("begin", "stop")).alias("spans")
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(spans.hint("merge"), "id", "left")

    def run(batches):
        for batch in batches:
            done = 0
            for rows, data, offsets in arrays.pieces(batch, "text"):
                spans = batch.column(2).slice(done, rows.num_rows)
                done += rows.num_rows
                sizes = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat, edge = spans.flatten(), np.zeros(len(data) + 1, dtype=np.int64)
                base = np.repeat(offsets[:-1], sizes)
                for name, sign in (("begin", 1), ("stop", -1)):
                    at = flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64) + base
                    # A run that ends with its text and one that begins the next text stay two runs.
                    np.add.at(edge, at, sign)
                gone = np.cumsum(edge)[:-1] > 0
                start = gone.copy()
                start[1:] &= ~gone[:-1]
                start[offsets[:-1][offsets[:-1] < len(data)]] = gone[offsets[:-1][offsets[:-1] < len(data)]]
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
                removed, runs = total(gone), total(start)
                left = data[~gone]
                at = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)])
                cells = [rows.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(runs), arrays.binaries(left, at)]
                yield pa.RecordBatch.from_arrays(cells, names=[id_col, "n_bytes", "n_removed", "n_spans", "kept"])

    return texts.mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
