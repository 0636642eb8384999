"""Similarity join on word n-grams by PartEnum signatures (operator 1).

A text is the set of its n-grams (all its words as one if it has fewer). Two texts link when
``100 * intersection >= percent * union``. Sets fall into bands of size; if the larger of two linked sets has at
most r n-grams they differ in at most ``k = 2 * r * (100 - percent) / (100 + percent)`` of them. The domain of
n-grams is cut into ``n1 * n2`` parts by hash. With ``n1 = ceil((k + 1) / (k2 + 1))`` one of the n1 groups of
parts holds at most k2 differences, so in it n2 - k2 parts are alike: every choice of n2 - k2 parts of a group
is a signature, and linked sets share one. A set whose partner may lie in the next band signs for that one too.
Unrelated sets meet where all chosen parts are empty, so n2 and k2 are chosen for each band and the number of
sets: as few signatures as keep such meetings rare.

Below ``FILTERED`` per cent sets have more signatures than n-grams, so only those sign that can have a link: of a
linked set at most ``100 - percent`` per cent of the n-grams are in no other set. Such n-grams are counted in a part
of the domain, the same for all sets; a set that has too many there already is linked with nothing.

Documents that share a signature meet through the smallest id of each signature, never as pairs. Signatures
that hold several n-grams are strong: they build candidate groups. A group that one task can hold is compared
as a whole. In a larger one each document is first compared with the document whose signatures it shares most;
what is linked is one label, and only signatures that still hold several labels are compared further, in blocks
of bounded size and never two blocks of one label, so a large group of near copies costs about as many rows as
it has members. Weak signatures (few or no n-grams) would run the whole corpus together as groups; across groups
each of them is compared by itself. Exact intersections come from a
product of membership matrices, and each task returns one row a member. The components of the links follow.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staylake.llm import arrays
from staylake.llm.store import components, stored

#: Sets and n-grams that a task compares with as many others.
BLOCK, FEATURES = 800, 1 << 21
#: Sets of which a task drops equal ones before it sends signatures; n-grams that make a signature strong.
SIGNED, STRONG = 4096, 4
#: From so many per cent on signatures are few, and all sets sign.
FILTERED = 90
#: Bits for each id, and at most, of the bitmap by which rows are parted before they are joined with a list of ids.
ID_BITS, MOST_BITS = 16, 1 << 28
SELF, STAR, WEAK, SIGNATURE, GROUP = range(5)


class Signer:
    """Signatures of sets of 64-bit features at a threshold in per cent, for about so many ``sets``."""

    def __init__(self, percent: int, sets: int = 1 << 20):
        self.percent, self.sets = percent, max(sets, 1)
        self.ends, self.plans = [0, 1], {}
        self.bits = np.uint64(max(0, 64 - (self.sets.bit_length() + 26)))

    def band(self, size: int) -> int:
        """Bands end at 1, 2, 3, ...: the largest partner of a set lies in its own band or in the next."""
        while self.ends[-1] < size:
            self.ends.append(max(self.ends[-1] + 1, self.ends[-1] * 100 // self.percent))
        return int(np.searchsorted(self.ends, size))

    def plan(self, band: int) -> tuple[int, int, list[tuple[int, ...]]]:
        """n1, n2 and the choices of parts. The cost of a way counts its signatures, and texts to be sent and
        compared for meetings by chance, at the smallest sets of the band."""
        if band not in self.plans:
            low, high = self.ends[band - 1] + 1, self.ends[band]
            k = 2 * high * (100 - self.percent) // (100 + self.percent)
            ways = []
            for n2 in range(1, 10):
                for k2 in range(min(n2, 4)):
                    n1 = -(-(k + 1) // (k2 + 1))
                    number = n1 * math.comb(n2, k2)
                    empty = math.exp(-low * (n2 - k2) / (n1 * n2))
                    crowd = self.sets / 5 * empty
                    cost = number * (1 + empty * min(1, crowd) * low / 4 + empty * crowd * low / 400)
                    ways.append((cost, n1, n2, k2))
            _, n1, n2, k2 = min(ways)
            self.plans[band] = n1, n2, list(itertools.combinations(range(n2), n2 - k2))
        return self.plans[band]

    def _sign(self, features: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
        n1, n2, choices = self.plan(band)
        part = ((arrays.mix(features ^ np.uint64(band + 1)) >> np.uint64(32)) % np.uint64(n1 * n2)).astype(np.int64)
        sums = np.zeros(n1 * n2, dtype=np.uint64)
        np.add.at(sums, part, arrays.mix(features))
        sums, held = sums.reshape(n1, n2), np.bincount(part, minlength=n1 * n2).reshape(n1, n2)
        group = np.arange(n1, dtype=np.uint64) + np.uint64(band << 32)
        out, strong = [], []
        for c, chosen in enumerate(choices):
            sign = arrays.mix(group + np.uint64(c << 48))
            for i in chosen:
                sign = arrays.mix(sign * np.uint64(0xD1342543DE82EF95) + sums[:, i])
            out.append(sign)
            strong.append(held[:, list(chosen)].sum(axis=1) >= min(STRONG, self.ends[band - 1] + 1))
        return np.concatenate(out) >> self.bits, np.concatenate(strong)

    def signed(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``features``: different ones, at least one. Signatures, cut to as many bits as keep them apart, and
        which are strong."""
        size = len(features)
        band = self.band(size)
        found = [self._sign(features, band)]
        if size * 100 >= self.percent * (self.ends[band] + 1):  # a partner may be in the next band
            self.band(self.ends[band] + 1)
            found.append(self._sign(features, band + 1))
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def signatures(self, features: np.ndarray) -> np.ndarray:
        return self.signed(features)[0]


def shingle_sets(data, offsets, n: int, hashes: arrays.SpanHash):
    """For each text the sorted different hashes of its n-grams, or of all its words."""
    data = arrays.LOWER[data]
    begin, end = arrays.word_spans(data, offsets, arrays.NOT_BLANK)
    hashes.load(data)
    words = hashes.of(begin, end)
    first = np.searchsorted(begin, offsets).tolist()
    whole = arrays.grams(words, n)
    for a, b in zip(first, first[1:]):
        if b - a >= n:
            yield np.unique(whole[a : b - n + 1])
        elif b > a:
            yield arrays.grams(words[a:b], b - a, seed=b - a)
        else:
            yield whole[:0]


def _tag(features: np.ndarray) -> np.uint64:
    """A number that stands for the set."""
    return np.add.reduce(arrays.mix(features), dtype=np.uint64)


def _profiles(docs, n, id_col, text_col):
    """``n_shingles``, ``tag`` and, as bytes, it and a second number that stand for the set."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        hashes = arrays.SpanHash(1)
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                size, tag, key = [], [], []
                for features in shingle_sets(data, offsets, n, hashes):
                    size.append(len(features))
                    one = _tag(features)
                    two = np.add.reduce(arrays.mix(features ^ np.uint64(0x5DEECE66D)), dtype=np.uint64)
                    tag.append(one)
                    key.append(one.tobytes() + two.tobytes())
                cells = [rows.column(0), pa.array(size, pa.int64()), pa.array(np.array(tag, dtype=np.uint64).view(np.int64)), pa.array(key, pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, names=["id", "n_shingles", "tag", "key"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_shingles bigint, tag bigint, key binary")


def _may_link(docs, classes, n, percent, sets, id_col, text_col) -> DataFrame:
    """``rep`` of the classes of equal sets that can be linked with another one.

    N-grams are cut to as many bits as keep them apart; two that fall together count as one that sets share, which
    loses no link.
    """
    part = np.uint64(min(1.0, 1.5 * (100 - percent) / 100) * (2**64 - 2**12))
    bits = np.uint64(max(0, 64 - (max(sets, 1).bit_length() + 26)))

    def looked(batches):
        hashes = arrays.SpanHash(1)
        for batch in batches:
            for _, data, offsets in arrays.pieces(batch, text_col):
                found = {}
                for features in shingle_sets(data, offsets, n, hashes):
                    places = arrays.mix(features ^ np.uint64(0x2545F4914F6CDD1D))
                    found.setdefault(_tag(features), places[places <= part] >> bits)
                tags = np.repeat(np.array(list(found), dtype=np.uint64), [len(x) for x in found.values()])
                cells = [np.concatenate(list(found.values())), tags]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cells], names=["gram", "tag"])

    rows = docs.select(id_col, text_col).where(F.col(id_col).isNotNull()).mapInArrow(looked, "gram bigint, tag bigint")
    held = rows.groupBy("gram").agg(F.min("tag").alias("tag"), F.max("tag").alias("other"))
    lone = held.where("tag = other").groupBy("tag").agg(F.count(F.lit(1)).alias("lone"))
    # Counted in another way, equal sets would be each other's partner: ``tag`` is the same for all of them.
    return classes.join(lone, "tag", "left").where(F.coalesce("lone", F.lit(0)) * 100 <= (100 - percent) * F.col("n_shingles")).select("rep")


def _parted(docs: DataFrame, ids: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose id may be in ``ids`` (one column, stored), and others, whose id surely is not.

    Only the former need to be sent for a join. Hashes of the ids are bits of a bitmap, which is broadcast; it has a
    bounded size, with very many ids more rows may be among them.
    """
    spread = F.lit(min(max(ids.count(), 1) * ID_BITS, MOST_BITS))
    bucket, bits = itertools.islice((c for k in itertools.count() if (c := f"bits{k}") not in docs.columns), 2)
    at = lambda c: F.pmod(F.xxhash64(F.col(f"`{c}`")), spread) + 1
    own = at(ids.columns[0])
    maps = ids.groupBy(F.bitmap_bucket_number(own).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias(bits))
    names = [F.col(f"`{c}`") for c in docs.columns]
    place = F.bitmap_bit_position(at(id_col))
    byte = F.conv(F.hex(F.substring(F.col(bits), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    both = docs.withColumn(bucket, F.bitmap_bucket_number(at(id_col))).join(F.broadcast(maps), bucket, "left")
    return both.where(found).select(*names), both.where(~found).select(*names)


def _buckets(docs, n, percent, sets, id_col, text_col) -> DataFrame:
    """``sign``, ``strong``, ``id`` and ``least`` for signatures that several documents share; ``least`` is the
    smallest of their ids. Of documents of a block with equal sets only the smallest id signs."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches):
        hashes, signer = arrays.SpanHash(1), Signer(percent, sets)
        for batch in batches:
            for rows, data, offsets in arrays.pieces(batch, text_col):
                own = rows.column(0).to_pylist()
                found = {}
                for i, features in sorted(zip(own, shingle_sets(data, offsets, n, hashes)), key=lambda x: x[0]):
                    if len(features):
                        found.setdefault(features.tobytes(), (i, features))
                yield from block(found.values(), signer, rows.column(0).type)

    def block(found, signer, id_type):
        for some in itertools.batched(found, SIGNED):
            signs = [signer.signed(features) for _, features in some]
            ids = np.repeat([i for i, _ in some], [len(s) for s, _ in signs])
            cells = [np.concatenate([s for s, _ in signs]).view(np.int64), np.concatenate([x for _, x in signs])]
            yield pa.RecordBatch.from_arrays([pa.array(cells[0]), pa.array(cells[1]), pa.array(ids, id_type)], names=["sign", "strong", "id"])

    signed = docs.select(id_col, text_col).where(F.col(id_col).isNotNull())
    rows = signed.mapInArrow(sign, f"sign bigint, strong boolean, id {kind}")
    shared = Window.partitionBy("sign")
    rows = rows.withColumns({"least": F.min("id").over(shared), "most": F.max("id").over(shared)})
    return rows.where("least < most").drop("most")


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all intersections between the sets of two blocks, some features at a time."""
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    a, b = np.concatenate(left), np.concatenate(right)
    row_a, row_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (left, right))
    names = np.intersect1d(a, b)
    at_a, at_b = (np.minimum(np.searchsorted(names, x), max(len(names) - 1, 0)) for x in (a, b))
    in_a, in_b = (names[at] == x if len(names) else np.zeros(len(x), dtype=bool) for at, x in ((at_a, a), (at_b, b)))
    row_a, at_a, row_b, at_b = row_a[in_a], at_a[in_a], row_b[in_b], at_b[in_b]
    order_a, order_b = np.argsort(at_a, kind="stable"), np.argsort(at_b, kind="stable")
    row_a, at_a, row_b, at_b = row_a[order_a], at_a[order_a], row_b[order_b], at_b[order_b]
    for low in range(0, len(names), width):
        m = []
        for rows, at, n in ((row_a, at_a, len(left)), (row_b, at_b, len(right))):
            s = slice(*np.searchsorted(at, [low, low + width]))
            grid = np.zeros((n, min(width, len(names) - low)), dtype=np.float32)
            grid[rows[s], at[s] - low] = 1
            m.append(grid)
        out += m[0] @ m[1].T
    return out


def shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections among the sets of a block. A feature of a single set counts for that one alone."""
    names, counts = np.unique(np.concatenate(sets), return_counts=True)
    common = names[counts > 1]
    some = [x[np.isin(x, common, assume_unique=True)] for x in sets] if len(common) < len(names) else sets
    out = overlaps(some, some)
    np.fill_diagonal(out, [len(x) for x in sets])
    return out


def _links(ids, copies, left, right, sets, percent) -> pa.Table:
    """For each member a partner that stands for its links, how many it has, and whether it is ``near`` a single
    left one.

    ``left`` and ``right`` are the places of the members to be compared, alike if a block meets itself. Members
    that are linked, directly or through others, get one partner: the smallest id among them.
    """
    root = np.arange(len(ids))
    many = np.zeros(len(ids), dtype=np.int64)
    if len(left) and len(right):
        same = left is right
        shared = shared_sizes([sets[x] for x in left]) if same else overlaps([sets[x] for x in left], [sets[x] for x in right])
        shared = shared.astype(np.int64)
        size = np.array([len(s) for s in sets])
        union = size[left][:, None] + size[right][None, :] - shared
        x, y = np.nonzero(100 * shared >= percent * union)
        x, y = left[x], right[y]
        keep = x != y
        x, y = x[keep], y[keep]
        np.add.at(many, x, copies[y])
        if not same:
            np.add.at(many, y, copies[x])
        while len(x):  # the smaller label wins until nothing changes
            low = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            root = root[root]
            if np.array_equal(before, root):
                break
    near = root == root[left[0]] if len(left) == 1 else np.zeros(len(ids), dtype=bool)
    return pa.table({"id": ids, "partner": ids[root], "links": many, "near": near})  # ids are in order


JOB = ["kind", "key", "i", "j"]


def _compared(jobs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``id``, ``partner``, ``links`` and ``near`` of the members of each job; side ``i`` of a job meets side ``j``.

    Texts and jobs meet by shuffle at every size.
    """
    hashes = arrays.SpanHash(1)

    def run(table: pa.Table) -> pa.Table:
        ids, first = np.unique(table.column("id").to_numpy(), return_index=True)
        table = table.take(pa.array(first)).combine_chunks()
        sets = []
        for batch in table.select(["text"]).to_batches():
            for _, data, offsets in arrays.pieces(batch):
                sets += shingle_sets(data, offsets, n, hashes)
        side, one, two = table.column("side").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        left = np.flatnonzero(side == one)
        right = left if one == two else np.flatnonzero(side == two)
        return _links(ids, table.column("copies").to_numpy(), left, right, sets, percent)

    def named(table: pa.Table) -> pa.Table:
        found = run(table)
        first = [pa.array([table.column(c)[0].as_py()] * found.num_rows, t) for c, t in (("kind", pa.int32()), ("key", pa.int64()))]
        return pa.table([*first, *found.columns], names=["kind", "key", *found.column_names])

    kind = texts.schema["id"].dataType.simpleString()
    rows = texts.select("id", "text").join(jobs.hint("merge"), "id").groupBy(*JOB)
    return rows.applyInArrow(named, f"kind int, key bigint, id {kind}, partner {kind}, links bigint, near boolean")


def _parts(n: str, features: str, block: int):
    return F.ceil(F.greatest(F.col(n) / block, F.col(features) / FEATURES)).cast("long")


def _dealt(groups: DataFrame, block: int) -> DataFrame:
    """Jobs that compare all members of each group (``kind``, ``key``) whose ``label`` differs.

    A group of one block is one job. In a larger one a label of more than a block has blocks of its own, all
    others share blocks; every two blocks meet, but not those of one label.
    """
    at = ["kind", "key"]
    total = groups.groupBy(at).agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("f"))
    total = total.select(*at, _parts("n", "f", block).alias("parts"))
    sized = groups.join(total, at)
    zero = F.lit(0).cast("long")
    one = sized.where("parts = 1").select(*at, zero.alias("i"), zero.alias("j"), "id", "copies", zero.alias("side"))

    many = sized.where("parts > 1").drop("parts")
    labels = many.groupBy(*at, "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("f"))
    labels = stored(labels.withColumn("own", _parts("n", "f", block)), "labels")
    mixed = labels.where("own = 1").groupBy(at).agg(F.sum("n").alias("n"), F.sum("f").alias("f"))
    mixed = mixed.select(*at, _parts("n", "f", block).alias("rest"))
    many = many.join(labels.select(*at, "label", "own"), [*at, "label"]).join(mixed, at, "left")
    owner = F.when(F.col("own") > 1, F.col("label"))
    part = F.pmod(F.xxhash64("id"), F.when(F.col("own") > 1, F.col("own")).otherwise(F.col("rest")))
    many = many.withColumn("owner", owner).withColumn("side", F.xxhash64("owner", part)).drop("own", "rest", "label")
    many = stored(many, "members")
    blocks = many.select(*at, "owner", "side").distinct()
    left, right = (blocks.select(*at, F.col("owner").alias(o), F.col("side").alias(s)) for o, s in (("x", "i"), ("y", "j")))
    pairs = left.join(right, at).where("i <= j and not coalesce(x = y, false)")
    pairs = pairs.select(*JOB, F.explode(F.array_distinct(F.array("i", "j"))).alias("side"))
    return one.unionByName(many.join(pairs, [*at, "side"]).select(*JOB, "id", "copies", "side"))


def _stars(strong: DataFrame, members: DataFrame, block: int) -> DataFrame:
    """Jobs that compare each member of a large group with one other: of the members of each signature the one that
    shares the most signatures is its centre, and a member meets the centre of most of its signatures."""
    rows = strong.select("sign", "id").join(members.select("id", "n_shingles"), "id")
    rows = rows.withColumn("shared", F.count(F.lit(1)).over(Window.partitionBy("id")))
    centre = F.max(F.struct("shared", (-F.col("id")).alias("id"))).over(Window.partitionBy("sign"))
    rows = rows.withColumn("root", -centre["id"]).where("id <> root")
    counts = rows.groupBy("id", "root").agg(F.count(F.lit(1)).alias("n"), F.first("n_shingles").alias("n_shingles"))
    most = F.max_by("root", F.struct("n", -F.col("root")))
    chosen = stored(counts.groupBy("id").agg(most.alias("root"), F.first("n_shingles").alias("n_shingles")), "stars")
    roots = chosen.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("f"))
    roots = roots.select("root", _parts("n", "f", block).alias("parts"))
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    spread = chosen.join(roots, "root").select(
        F.lit(STAR).alias("kind"), F.col("root").cast("long").alias("key"), zero.alias("i"), (F.pmod(F.xxhash64("id"), "parts") + 1).alias("j"), "id", one.alias("copies")
    )
    centres = roots.select("root", F.explode(F.sequence(one, F.col("parts"))).alias("j")).select(
        F.lit(STAR).alias("kind"), F.col("root").cast("long").alias("key"), zero.alias("i"), "j", F.col("root").alias("id"), one.alias("copies")
    )
    return spread.withColumn("side", F.col("j")).unionByName(centres.withColumn("side", zero))


def _apart(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of signatures that hold several labels."""
    shared = Window.partitionBy(*by)
    rows = rows.withColumns({"low": F.min("label").over(shared), "high": F.max("label").over(shared)})
    return rows.where("low < high").drop("low", "high")


def _remaining(buckets: DataFrame, members: DataFrame, found: DataFrame, block: int) -> DataFrame:
    """Groups of large candidate groups that still hold several labels: whole, or signature by signature where
    that sends fewer copies of texts."""
    centres = found.where((F.col("kind") == STAR) & F.col("near") & (F.col("id") != F.col("key")))
    centres = centres.groupBy("id").agg(F.min("key").alias("centre"))
    label = F.coalesce("centre", "id").cast(members.schema["id"].dataType)
    labelled = members.join(centres, "id", "left").select("id", "copies", "n_shingles", "component", label.alias("label"))
    rows = stored(_apart(buckets.select("sign", "id").join(labelled, "id"), "sign", "component"), "apart")
    single = rows.select("component", "id", "copies", "n_shingles", "label").distinct()
    whole = single.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("f"))
    whole = whole.withColumn("sent", F.col("n") * _parts("n", "f", block)).select("component", "sent")
    ways = rows.groupBy("component").agg(F.count(F.lit(1)).alias("rows")).join(whole, "component")
    ways = stored(ways.select("component", (F.col("rows") < F.col("sent")).alias("by_sign")), "ways")
    columns = ["id", "copies", "n_shingles", "label"]
    by_sign = rows.join(ways.where("by_sign"), "component").select(F.lit(SIGNATURE).alias("kind"), F.xxhash64("sign", "component").alias("key"), *columns)
    by_group = single.join(ways.where("not by_sign"), "component")
    return by_sign.unionByName(by_group.select(F.lit(GROUP).alias("kind"), F.col("component").cast("long").alias("key"), *columns))


def similar_groups(
    docs: DataFrame,
    n: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    count_links: bool = True,
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and, if asked for, ``n_links`` of every document.

    ``component_id`` is the smallest id that can be reached by links, the document's own included;
    ``n_links`` counts linked documents, copies each for itself, for which all pairs of a candidate group have to
    be compared; components alone need far fewer. A null text or one without words has an empty set: no links.
    Sets are compared by 64-bit hashes of their n-grams. Ids are integers and differ where texts do; a repeated
    row counts as a copy, rows without an id are left out of all groups. Other columns are left out.
    """
    spark = docs.sparkSession
    profile = stored(_profiles(docs, n, id_col, text_col), "profiles")
    full = profile.where("n_shingles > 0 and id is not null")
    classes = full.groupBy("key").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("tag").alias("tag"), F.first("n_shingles").alias("n_shingles")
    )
    # Stored, so that the join meets two plain tables and a very common key can be split.
    classes = stored(classes, "classes")
    members = full.select("id", "n_shingles", "key").join(classes.select("key", "rep", "copies"), "key")
    members = members.groupBy("id").agg(F.min(F.struct("rep", "copies", "n_shingles")).alias("c"))
    members = stored(members.select("id", "c.*"), "members")
    reps = members.where("id = rep").select("id", "copies", "n_shingles")

    sets = classes.count()
    if percent < FILTERED:
        able = stored(_may_link(docs, classes, n, percent, sets, id_col, text_col), "able")
        sets = able.count()
        able = able.select(F.col("rep").alias(id_col))
        some, _ = _parted(docs.select(id_col, text_col), able, id_col)
        docs = stored(some.join(able.hint("merge"), id_col, "left_semi"), "able-texts")
    buckets = stored(_buckets(docs, n, percent, sets, id_col, text_col), "buckets")
    strong = buckets if count_links else buckets.where("strong")
    near = components(spark, strong.select(F.col("id").alias("a"), F.col("least").alias("b")))
    group = near.join(reps, near.node == reps.id).select("id", "copies", "n_shingles", "component")
    sizes = group.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("f"))
    sizes = sizes.select("component", (_parts("n", "f", block) > 1).alias("large"))
    group = stored(group.join(sizes, "component"), "groups")

    def whole(rows):
        return rows.select(F.lit(SELF).alias("kind"), F.col("component").cast("long").alias("key"), "id", "copies", "n_shingles", F.col("id").alias("label"))

    def texts_of(wanted):
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        return stored(texts.join(wanted.hint("merge"), "id"), "texts")

    if count_links:
        texts = texts_of(group.select("id"))
        found = stored(_compared(_dealt(whole(group), block), texts, n, percent), "found")
    else:
        placed = reps.join(group.select("id", "component"), "id", "left")
        placed = placed.withColumn("label", F.coalesce("component", "id"))
        weak = _apart(buckets.where("not strong").select("sign", "id").join(placed, "id"), "sign")
        weak = weak.select(F.lit(WEAK).alias("kind"), F.col("sign").alias("key"), "id", "copies", "n_shingles", "label")
        large = group.where("large")
        jobs = _dealt(whole(group.where("not large")).unionByName(weak), block)
        jobs = stored(jobs.unionByName(_stars(strong, large, block)), "jobs")
        wanted = jobs.select("id").union(large.select("id")).distinct().join(large.select("id", "large"), "id", "left")
        texts = texts_of(wanted)
        found = stored(_compared(jobs, texts, n, percent), "found")
        if not large.isEmpty():
            jobs = _dealt(_remaining(buckets, large, found, block), block)
            found = found.union(stored(_compared(jobs, texts.where("large"), n, percent), "found"))
    joined = components(spark, found.select(F.col("id").alias("a"), F.col("partner").alias("b")))
    of_rep = members.join(joined, members.rep == joined.node, "left")
    if count_links:
        links = found.groupBy("id").agg(F.sum("links").alias("links"))
        of_rep = of_rep.join(links.withColumnRenamed("id", "linked"), F.col("rep") == F.col("linked"), "left")
        counted = [(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")]
    else:
        counted = []
    of_rep = of_rep.select(members.id, F.coalesce("component", "rep").alias("component_id"), *counted)
    return profile.join(of_rep, "id", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("component_id", "id").alias("component_id"),
        *[F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links") for _ in counted],
    )


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of the document of smallest id of each group, all columns as they are.

    Rows that repeat with id and text stay once: the one whose other columns come first as JSON. Rows without an
    id are in no group: they stay, once for each text.
    """
    groups = similar_groups(docs, n, percent, id_col, text_col, count_links=False)
    first = F.first(F.col(id_col) == F.col("component_id"))
    stay = groups.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("rows"), first.alias("first"))
    aside = stored(stay.where("not first or rows > 1"), "aside")  # all others stay once
    often = aside.where("first").select(id_col)
    names = [F.col(f"`{c}`") for c in docs.columns]
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)], F.lit(0).alias("_")))
    place = next(name for k in itertools.count() if (name := f"place{k}") not in docs.columns)
    with_id = docs.where(F.col(id_col).isNotNull())
    some, kept = _parted(with_id, aside.select(id_col), id_col)
    kept = kept.unionByName(some.join(aside.select(id_col), id_col, "left_anti").select(*names))
    for rows in (some.join(often, id_col, "left_semi"), docs.where(F.col(id_col).isNull())):
        first = F.row_number().over(Window.partitionBy(F.col(id_col), F.xxhash64(text_col), F.col(text_col)).orderBy(others))
        kept = kept.unionByName(rows.withColumn(place, first).where(F.col(place) == 1).select(*names))
    return kept
