"""Similarity join of texts by Jaccard similarity of their word n-grams, as components.

Two texts link if ``100 * intersection >= percent * union`` of their sets of distinct
n-grams. Sets are kept as 64-bit hashes of the n-grams.

1. Texts with equal sets are one class. From here on a class is a node, once.
2. A table of counts of all n-grams, by a hash of bounded width, gives one order of
   the n-grams, rare ones first. Of two sets that link, the beginnings of length
   ``n - need + k`` in that order share k n-grams, where ``need`` is the least overlap
   that a set of n can link with.
3. Size-aware keys. A light (small) set enumerates the pairs, subsets of fixed size 2,
   of its beginning for k = 2. A heavy (large) set has too many pairs: its keys are the
   single n-grams of its beginning for k = 1, whose inverted lists are scanned. The
   boundary is where the number of pairs passes what the scan of the lists would cost;
   sets just below it have keys of both kinds, to meet those above.
4. The sets with a common key are a group; groups with the same smallest member are
   one. A group above CELL members is first cut into cells of one chunk each, all with the same
   HUBS members besides, through which the near copies of all chunks connect. What is then
   apart from the group's largest component meets, in cells of two chunks, each other
   and that component, where sizes allow a link: so the rows of the cells grow
   with the group, and with its square only as far as its sets are really apart. A task
   never has more than two chunks. Within a cell sets are compared by parity bitmaps: the
   number of different bits never exceeds the number of different n-grams, so a pair
   that has too many has no link. Clear links give a spanning forest: what is found
   is not compared again, so near copies cost about a comparison each, and not one for
   each pair. Each set that is still apart from others it may link to, within what a
   bitmap can tell, adds the nearest ALTERNATIVES of each part of the cell.
5. These possible links are checked on whole sets. Those of all members that may link to
   any other by their bitmaps are made from the texts beforehand, so cells are done again
   without reading a text: the texts are read once for the first cells, and once for
   those of two chunks if there are any. A cell that loses one is done again with its
   whole sets, knowing the components found, which leaves nothing open. Where these are
   more than a task should hold (SET_VALUES), it is done again by bitmaps, without the lost
   links, until none is lost: then any two sets of a cell are either connected or known
   to have no link.
6. Components by alternating stars, on links of ids only.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, log, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterism.llm.common import give_back, in_parts, small, to_arrow
from asterism.llm.spans import MULTIPLIERS, PIECE, mix, span_hashes
from asterism.operators.lookup import BROADCAST_LIMIT
from asterism.sources.staging import stage

NGRAM, PERCENT = 3, 90
# counters of the table that orders the n-grams; a number a byte is sent to the executors
COUNTERS, BLOCKS = 1 << 22, 16
# members of a chunk of a group
CELL = 1024
# members that all chunks of a group have, about
HUBS = 32
# uncertain links to each part of a cell that a set adds at once, and how many times more in each
# further round, so that rounds grow with the logarithm of what turns out to be no link
ALTERNATIVES, FURTHER = 8, 4
# beginnings of more n-grams than this have no pairs
MOST_LIGHT = 64
# edges that one task reduces to stars
EDGES = 500_000
# n-grams, of eight bytes, of the sets of a cell that are compared at once
SET_VALUES = 1 << 22
# bits of the filter for some of the documents: so many for each, in all as many as a broadcast may have
SPOTS_EACH = 16

NODE = (
    "doc_id long, m1 long, m2 long, n int, digest binary, start array<long>, bitmap binary, scan double"
)
CELL_KEY = ["anchor", "i", "j"]
EDGE = "anchor long, i int, j int, a long, b long"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


# -- sets ---------------------------------------------------------------------------


def _word_hashes(piece: bytes) -> np.ndarray:
    """Hashes of the words of a piece of text."""
    data = np.frombuffer(piece, np.uint8)
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    return span_hashes(data, edges[::2], edges[1::2])


def ngram_set(text: str | None, ngram: int = NGRAM) -> np.ndarray:
    """Ascending hashes of the distinct n-grams of a text.

    Letters A-Z are lowered. A text of fewer words is one n-gram of its own, and one
    without words has none.
    """
    raw = (text or "").encode().lower()  # of bytes: A-Z only
    hashes, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE)
        if end < len(raw):
            cut = max(raw.rfind(b" ", at, end), raw.rfind(b"\n", at, end))
            if cut < 0:  # no white space: go on to the next
                ahead = [p for p in (raw.find(b" ", end), raw.find(b"\n", end)) if p >= 0]
                cut = min(ahead) if ahead else len(raw) - 1
            end = cut + 1
        hashes.append(_word_hashes(raw[at:end]))
        at = end
    words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    if not len(words):
        return words
    size = min(ngram, len(words))
    value = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        value = value + words[k : len(words) - size + 1 + k] * MULTIPLIERS[1 + k]
    return np.unique(mix(value))


def links(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def parity_bitmap(values: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of values end in i; at least two bits a value."""
    bits = 64
    while bits < 2 * len(values):
        bits *= 2
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _fold(bitmaps: np.ndarray) -> np.ndarray:
    """The bitmaps of half as many bits for the same values."""
    half = bitmaps.shape[-1] // 2
    return bitmaps[..., :half] ^ bitmaps[..., half:]


def needed(n: int, percent: int = PERCENT) -> int:
    """Least overlap with which a set of ``n`` can link."""
    return -(-percent * n // 100)


# -- order of the n-grams -------------------------------------------------------------


def count_table(docs: DataFrame, ngram: int = NGRAM) -> np.ndarray:
    """Occurrences of all n-grams of ``docs`` (text) by COUNTERS hash values.

    Tasks give blocks of their counts; blocks are added in two steps, so no task adds
    more than about the root of their number.
    """
    spark = docs.sparkSession
    schema = "task int, block int, counts binary"
    arrow = to_arrow(spark, schema)
    width = COUNTERS // BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(COUNTERS, np.uint32)
        for batch in in_parts(batches):
            spots = np.concatenate([ngram_set(text, ngram) for text in batch.column(0).to_pylist()])
            some, often = np.unique((spots & np.uint64(COUNTERS - 1)).astype(np.uint32), return_counts=True)
            counts[some] += often.astype(np.uint32)
        if counts.any():
            task = TaskContext.get().partitionId()
            packed = [zlib.compress(part.tobytes(), 1) for part in counts.reshape(BLOCKS, width)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * BLOCKS, pa.int32()),
                    pa.array(range(BLOCKS), pa.int32()),
                    pa.array(packed, pa.binary()),
                ],
                schema=arrow,
            )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.uint64)
        for packed in rows["counts"]:
            part = np.frombuffer(zlib.decompress(packed), np.uint32)
            total = np.minimum(total + part, np.uint64(0xFFFFFFFF))
        packed = zlib.compress(total.astype(np.uint32).tobytes(), 1)
        return pd.DataFrame({"task": rows["task"].iloc[:1], "block": rows["block"].iloc[:1], "counts": [packed]})

    parts = stage(docs.select("text").mapInArrow(count, schema))
    steps = max(1, ceil(sqrt(parts.count() / BLOCKS)))
    some = parts.withColumn("task", F.col("task") % steps).groupBy("block", "task").applyInPandas(add, schema)
    whole = some.groupBy("block").applyInPandas(add, schema)
    counts = np.zeros((BLOCKS, width), np.uint32)
    for row in whole.toLocalIterator():  # BLOCKS rows
        counts[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return counts.ravel()


def _levels(counts: np.ndarray) -> np.ndarray:
    """Quarters of a power of two, a byte for each counter."""
    return np.minimum(255, np.log2(counts + 1.0) * 4).astype(np.uint8)


# -- nodes ------------------------------------------------------------------------------


def _marked(docs: DataFrame) -> DataFrame:
    """``docs`` with two hashes, m1 and m2, that stand for id and text of a row."""
    return docs.withColumns(
        {"m1": F.xxhash64("doc_id", "text"), "m2": F.xxhash64(F.lit(7), F.col("text"), F.col("doc_id"))}
    )


def _nodes(docs: DataFrame, counts: np.ndarray, percent: int, ngram: int) -> DataFrame:
    """A row for each document: its set's size, digest, beginning, bitmap and cost to scan."""
    spark = docs.sparkSession
    arrow = to_arrow(spark, NODE)
    shared = spark.sparkContext.broadcast(_levels(counts))  # COUNTERS bytes
    usual = float(counts.mean())
    give_back()  # what the driver took for the table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in in_parts(batches):
            sizes, digests, starts, bitmaps, scans = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                values = ngram_set(text, ngram)
                n = len(values)
                level = levels[(values & np.uint64(COUNTERS - 1)).astype(np.int64)]
                first = np.argsort(level, kind="stable")[: n - needed(n, percent) + 2]
                sizes.append(n)
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                starts.append(values[first].view(np.int64))
                bitmaps.append(parity_bitmap(values).tobytes())
                listed = np.maximum(0, np.exp2(level[first[:-1]] / 4.0) - 1 - usual)
                scans.append(float(listed.sum()))
            flat = np.concatenate(starts) if starts else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in starts])]).astype(np.int32)
            columns = [
                *(batch.column(name) for name in ("doc_id", "m1", "m2")),
                pa.array(sizes, pa.int32()),
                pa.array(digests, pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                pa.array(bitmaps, pa.binary()),
                pa.array(scans, pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return _marked(docs.select("doc_id", "text")).mapInArrow(run, NODE)


def _classes(nodes: DataFrame) -> DataFrame:
    """One row for each set that is not empty, with a number ``cid`` and one document that has it."""
    grouped = (
        nodes.where("n > 0")
        .groupBy("digest", "n")
        .agg(
            F.min("doc_id").alias("low"),
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("doc_id", "m1", "m2")).alias("one"),
            F.any_value("start").alias("start"),
            F.any_value("bitmap").alias("bitmap"),
            F.any_value("scan").alias("scan"),
        )
    )
    return stage(grouped.withColumn("cid", F.monotonically_increasing_id()))


# -- candidates -----------------------------------------------------------------------


def _boundary(classes: DataFrame) -> int:
    """The largest size up to which pairs cost no more than the scan of single lists."""
    length = F.size("start")
    costs = (
        classes.where(length <= MOST_LIGHT)
        .groupBy(length.alias("length"))
        .agg(F.avg("scan").alias("scan"), F.max("n").alias("n"))
        .orderBy("length")
        .collect()  # at most MOST_LIGHT rows
    )
    boundary = 0
    for row in costs:
        k = row["length"]
        if k * (k - 1) / 2 > k - 1 + row["scan"]:
            break
        boundary = row["n"]
    return boundary


def _entries(classes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(key, cid, n) for each key of each class that can link to another one.

    A set of fewer than percent / (100 - percent) n-grams links to none but its equals.
    """
    singles = F.expr("slice(start, 1, size(start) - 1)")
    pairs = F.expr(
        "flatten(transform(sequence(1, size(start) - 1), i ->"
        " transform(slice(start, i + 1, size(start)), t -> xxhash64(element_at(start, i), t))))"
    )
    none = F.expr("cast(array() as array<bigint>)")
    meets_heavy = 100 * F.col("n") >= percent * (boundary + 1)
    keys = F.concat(
        F.when(meets_heavy, singles).otherwise(none),
        F.when((F.col("n") <= boundary) & (F.size("start") > 1), pairs).otherwise(none),
    )
    able = classes.where((100 - percent) * F.col("n") >= percent)
    return able.select(F.explode(F.array_distinct(keys)).alias("key"), "cid", "n")


def _groups(entries: DataFrame) -> DataFrame:
    """(anchor, cid, n): the groups of sets that share a key.

    A group is named by the smallest of its members, and groups of one name are one,
    so a set is in it once, however many keys it shares with the others.
    """
    shared = entries.groupBy("key").agg(F.min("cid").alias("anchor"), F.max("cid").alias("last"))
    shared = stage(shared.where("anchor < last").drop("last"))
    return stage(entries.join(shared, "key").select("anchor", "cid", "n").distinct())


def _large(groups: DataFrame) -> DataFrame:
    """(anchor, members) of the groups above CELL members."""
    return stage(groups.groupBy("anchor").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > CELL))


def _first_cells(groups: DataFrame, large: DataFrame, classes: DataFrame) -> DataFrame:
    """(anchor, i, j, cid, n, bitmap): small groups whole, large ones by chunks with the hubs in each."""
    joined = groups.join(small(large), "anchor", "left")
    chunks = F.coalesce(F.ceil(F.col("members") / CELL), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("cid"), chunks).cast("int")
    hub = F.pmod(F.xxhash64(F.lit("hub"), "cid"), F.ceil(F.col("members") / HUBS)) == 0
    every = F.when(F.coalesce(hub, F.lit(False)), F.sequence(F.lit(0), chunks - 1)).otherwise(F.array(own))
    members = joined.withColumn("i", F.explode(every)).select("anchor", "i", F.col("i").alias("j"), "cid", "n")
    return _with_bitmaps(members, classes)


def _further_cells(
    groups: DataFrame, large: DataFrame, classes: DataFrame, found: DataFrame, percent: int
) -> DataFrame | None:
    """The cells that large groups still need, given the components that were ``found``.

    Of a group, the members that aren't in its largest component are its rest. Blocks of
    rest and other members, of sizes between two powers of the least ratio that a link
    allows, meet if one of them is of the rest and their powers are the same or
    neighbours. None if no group has a rest.
    """
    members = groups.join(small(large.select("anchor")), "anchor").join(found, "cid", "left")
    members = stage(members.withColumn("component", F.coalesce("component", "cid")))
    sizes = members.groupBy("anchor", "component").agg(F.count(F.lit(1)).alias("rows"))
    main = sizes.groupBy("anchor").agg(
        F.max(F.struct("rows", "component")).alias("main"), F.count(F.lit(1)).alias("components")
    )
    main = stage(main.where("components > 1").select("anchor", "main.component").withColumnRenamed("component", "main"))
    if not main.take(1):
        return None
    # a little above the ratio, so that rounding can't put two sizes too far apart
    unit = max(log(100 / percent), 1e-6) * (1 + 1e-9)
    power = F.floor(F.log(F.col("n").cast("double")) / unit).cast("int")
    members = members.join(small(main), "anchor").withColumns({"rest": F.col("component") != F.col("main"), "power": power})
    kinds = ["anchor", "rest", "power"]
    counts = members.groupBy(*kinds).agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("chunks"))
    before = Window.partitionBy("anchor").orderBy("rest", "power")  # a few hundred rows at most
    blocks = stage(counts.withColumn("first", (F.sum("chunks").over(before) - F.col("chunks")).cast("int")))
    mine, theirs = blocks.alias("mine"), blocks.alias("theirs")
    near = (F.col("mine.anchor") == F.col("theirs.anchor")) & (F.abs(F.col("mine.power") - F.col("theirs.power")) <= 1)
    first, last = F.col("theirs.first"), F.col("theirs.first") + F.col("theirs.chunks") - 1
    of_rest = F.col("theirs.rest")
    ranges = (
        mine.join(theirs, near)
        .groupBy(*(F.col(f"mine.{c}").alias(c) for c in [*kinds, "first", "chunks"]))
        .agg(
            F.min(F.when(of_rest, first)).alias("rest_first"),
            F.max(F.when(of_rest, last)).alias("rest_last"),
            F.min(F.when(~of_rest, first)).alias("main_first"),
            F.max(F.when(~of_rest, last)).alias("main_last"),
        )
    )
    none = F.expr("cast(array() as array<int>)")
    with_rest = F.when(F.col("rest_first").isNotNull(), F.sequence("rest_first", "rest_last")).otherwise(none)
    with_main = F.when(F.col("rest") & F.col("main_first").isNotNull(), F.sequence("main_first", "main_last")).otherwise(none)
    block = F.col("first") + F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int")
    met = members.join(small(ranges), kinds).withColumn("block", block)
    met = met.withColumn("other", F.explode(F.concat(with_rest, with_main)))
    rows = met.select("anchor", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "cid", "n")
    return _with_bitmaps(rows, classes)


def _with_bitmaps(members: DataFrame, classes: DataFrame) -> DataFrame:
    return stage(members.join(classes.select("cid", "bitmap"), "cid").select(*CELL_KEY, "cid", "n", "bitmap"))


class _Cell:
    """The sets of a cell, for comparison by bitmap."""

    def __init__(self, cids: np.ndarray, sizes: np.ndarray, bitmaps: list[bytes], percent: int):
        self.cids, self.sizes, self.percent = cids, sizes, percent
        self.words = np.array([len(b) // 8 for b in bitmaps])
        self.row = np.zeros(len(cids), np.int64)
        self.maps: dict[int, np.ndarray] = {}
        for w in set(self.words.tolist()):
            which = np.flatnonzero(self.words == w)
            self.row[which] = np.arange(len(which))
            self.maps[w] = np.frombuffer(b"".join(bitmaps[k] for k in which), np.uint64).reshape(-1, w)
        self.folded: dict[int, np.ndarray] = {}

    def possible(self, x: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``among`` that may link to ``x``, and by how many bits each could be
        further from it; a negative number where even a usual loss of bits leaves no doubt.
        """
        total = self.sizes[x] + self.sizes[among]
        most = (100 - self.percent) * total // (100 + self.percent)  # different n-grams of a link
        fits = np.abs(self.sizes[x] - self.sizes[among]) <= most
        among, most = among[fits], most[fits]
        if not len(among):
            return among, among
        w, words = int(self.words[x]), self.words[among]
        ours = self.maps[w][self.row[x]]
        different = np.full(len(among), 1 << 40)
        bits = 64 * np.minimum(w, words)
        for v in set(words.tolist()):
            at = np.flatnonzero(words == v)
            rows = self.row[among[at]]
            if v == w:
                xor = self.maps[v][rows] ^ ours
            elif v == 2 * w:
                if v not in self.folded:
                    self.folded[v] = _fold(self.maps[v])
                xor = self.folded[v][rows] ^ ours
            elif 2 * v == w:
                xor = self.maps[v][rows] ^ _fold(ours)
            else:  # sizes too far apart
                continue
            different[at] = np.bitwise_count(xor).sum(axis=1)
        # n-grams that fall on one bit by twos are lost: most**2 / (2 * bits) twos are usual
        usual = most * most / (2 * bits)
        slack = 2 * np.ceil(usual + 2 * np.sqrt(usual))
        there = different <= most
        return among[there], (different + slack - most)[there]

    def forest(
        self, component: np.ndarray, lost: set[tuple[int, int]], alternatives: int
    ) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Edges (member, found from): clear links that connect what they can, given the
        components that are known, and uncertain ones between what is then apart.

        Then all members that may be in an edge, now or when some edges are lost: of two
        that may link, the one that is visited first finds the other, or both came into one
        tree by edges or as members of known components.
        """
        edges: list[tuple[int, int]] = []
        cids = self.cids
        seen = np.zeros(len(cids), bool)
        order = np.argsort(cids, kind="stable")

        def near(x: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found, doubt = self.possible(x, among)
            if lost and len(found):
                mine = int(cids[x])
                new = np.array([(min(mine, o), max(mine, o)) not in lost for o in cids[found].tolist()])
                found, doubt = found[new], doubt[new]
            seen[x] |= len(found) > 0
            seen[found] = True
            return found, doubt

        left, cluster = order, np.full(len(cids), -1)
        doubtful: list[int] = []
        known = len(set(component.tolist())) < len(component)
        while len(left):
            first, left = int(left[0]), left[1:]
            queue, cluster[first] = [first], first
            while queue and len(left):
                x = queue.pop()
                if known:
                    mates = component[left] == component[x]
                    queue += left[mates].tolist()
                    cluster[left[mates]] = first
                    left = left[~mates]
                found, doubt = near(x, left)
                if len(found):
                    if (doubt > 0).any():
                        doubtful.append(x)
                    found = found[doubt <= 0]
                    edges += [(int(cids[y]), int(cids[x])) for y in found.tolist()]
                    queue += found.tolist()
                    cluster[found] = first
                    left = left[~np.isin(left, found)]
        for x in doubtful:  # with those that came later and are apart from it
            others = order[(cluster[order] != cluster[x])]
            found, doubt = near(x, others)
            of = cluster[found]
            by_cluster = np.lexsort((doubt, of))  # the nearest of each cluster
            first = np.searchsorted(of[by_cluster], of[by_cluster])
            nearest = found[by_cluster[np.arange(len(found)) - first < alternatives]]
            edges += [(int(cids[y]), int(cids[x])) for y in nearest.tolist()]
        if known:
            seen |= np.isin(component, component[seen])
        return edges, cids[seen]


def _forests(cells: DataFrame, percent: int, tasks: int, mark: bool, alternatives: int) -> DataFrame:
    """EDGE rows for rows of cells with ``component`` and, for lost edges, ``lost``.

    To ``mark`` gives an edge from each member that may be in one to itself besides.
    """
    def solve(rows: pa.Table) -> list[tuple]:
        lost_to = rows.column("lost").to_pylist()
        cids = rows.column("cid").to_numpy()
        members = np.array([o is None for o in lost_to])
        lost = {(min(c, o), max(c, o)) for c, o in zip(cids.tolist(), lost_to) if o is not None}
        bitmaps = [b for b, m in zip(rows.column("bitmap").to_pylist(), members) if m]
        cell = _Cell(cids[members], rows.column("n").to_numpy()[members], bitmaps, percent)
        at = [rows.column(name)[0].as_py() for name in CELL_KEY]
        edges, seen = cell.forest(rows.column("component").to_numpy()[members], lost, alternatives)
        marks = [(a, a) for a in seen.tolist()] if mark else []
        return [(*at, a, b) for a, b in edges + marks]

    return _by_cell(cells, tasks, solve)


def _exact_forests(cells: DataFrame, percent: int, tasks: int) -> DataFrame:
    """EDGE rows, all of them links, for rows of cells with ``component`` and ``set``."""

    def solve(rows: pa.Table) -> list[tuple]:
        at = [rows.column(name)[0].as_py() for name in CELL_KEY]
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("set").to_pylist()]
        found = exact_forest(rows.column("cid").to_numpy(), rows.column("component").to_numpy(), sets, percent)
        return [(*at, a, b) for a, b in found]

    return _by_cell(cells, tasks, solve)


def exact_forest(
    cids: np.ndarray, component: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links (member, found from) that connect all that links and known components connect."""
    sizes = np.array([len(s) for s in sets])
    numbers, codes = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.split(codes, np.cumsum(sizes)[:-1])
    of = np.repeat(np.arange(len(sets)), sizes)
    mine = np.zeros(len(numbers), bool)
    edges: list[tuple[int, int]] = []
    left = np.argsort(cids, kind="stable")
    listed = len(left)  # members whose n-grams are in ``codes``, about
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            mates = component[left] == component[x]
            queue += left[mates].tolist()
            left = left[~mates]
            if 2 * len(left) < listed:
                there = np.zeros(len(sets), bool)
                there[left] = True
                codes, of, listed = codes[there[of]], of[there[of]], len(left)
            mine[own[x]] = True
            common = np.bincount(of[mine[codes]], minlength=len(sets))[left]
            mine[own[x]] = False
            linked = 100 * common >= percent * (sizes[x] + sizes[left] - common)
            edges += [(int(cids[y]), int(cids[x])) for y in left[linked].tolist()]
            queue += left[linked].tolist()
            left = left[~linked]
    return edges


def _by_cell(cells: DataFrame, tasks: int, solve: Callable[[pa.Table], list[tuple]]) -> DataFrame:
    """EDGE rows from each cell's rows, given to ``solve`` together."""
    arrow = to_arrow(cells.sparkSession, EDGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not len(table):
                continue
            at = np.stack([table.column(name).to_numpy() for name in CELL_KEY])
            new = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
            if held and any(held[-1].column(n)[-1] != table.column(n)[0] for n in CELL_KEY):
                new = np.concatenate([[0], new])
            edges: list[tuple] = []
            begin = 0
            for end in [*new.tolist(), None]:
                part = table.slice(begin, None if end is None else end - begin)
                if len(part):
                    held.append(part)
                if end is not None and held:
                    edges += solve(pa.concat_tables(held))
                    held = []
                    begin = end
            yield _batch(edges, arrow)
        if held:
            yield _batch(solve(pa.concat_tables(held)), arrow)

    # with a number: adaptive execution would merge cells, which are small but take long
    dealt = cells.repartition(tasks, *CELL_KEY).sortWithinPartitions(*CELL_KEY, "cid")
    return dealt.mapInArrow(run, EDGE)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


# -- checks of possible links -----------------------------------------------------------


def _maybe_among(docs: DataFrame, some: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (m1 and others) in two parts: those whose m1 may be in ``some``, and the rest.

    A bitmap sized by the rows of ``some``, which is staged, stands for it; it says yes too
    often, never no. If too many for the bitmap that may be broadcast, all are in the first part.
    """
    spots = 1 << 15
    count = some.count()
    while spots < SPOTS_EACH * count and spots < 4 * BROADCAST_LIMIT:
        spots *= 2
    if count > spots // 2:
        return docs, docs.limit(0)
    spot = F.pmod(F.col("m1"), F.lit(spots)) + 1
    bits = some.groupBy(F.bitmap_bucket_number(spot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("_bits")
    )
    bits = stage(bits)
    position = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = docs.withColumn("_at", F.bitmap_bucket_number(spot)).join(
        F.broadcast(bits), F.col("_at") == F.col("_bucket"), "left"
    )
    there = F.coalesce(F.expr("bit_get(cast(_byte as bigint), _bit)") == 1, F.lit(False))
    marked = joined.withColumns({"_byte": byte, "_bit": (position % 8).cast("int")}).withColumn("_there", there)
    drop = ["_at", "_bucket", "_bits", "_byte", "_bit", "_there"]
    return marked.where("_there").drop(*drop), marked.where("not _there").drop(*drop)


def _sets(docs: DataFrame, wanted: DataFrame, ngram: int) -> DataFrame:
    """(cid, set) for the classes of ``wanted`` (cid, m1, m2), made anew from their texts."""
    schema = "m1 long, m2 long, set binary"
    arrow = to_arrow(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            sets = [ngram_set(text, ngram).tobytes() for text in batch.column("text").to_pylist()]
            columns = [batch.column("m1"), batch.column("m2"), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    some, _ = _maybe_among(_marked(docs.select("doc_id", "text")), wanted)
    made = some.select("m1", "m2", "text").mapInArrow(run, schema)
    # repeated rows have the same set
    return made.join(small(wanted), ["m1", "m2"]).select("cid", "set").dropDuplicates(["cid"])


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, ok) for pairs (a, b), by their whole sets (cid, set)."""
    schema = "a long, b long, ok boolean"
    arrow = to_arrow(pairs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            both = zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
            ok = [links(*(np.frombuffer(s, np.uint64) for s in pair), percent) for pair in both]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok)], schema=arrow)

    ends = pairs.select(F.col("a").alias("cid")).unionAll(pairs.select("b")).distinct()
    sets = sets.join(small(ends), "cid", "left_semi")
    with_sets = pairs
    for side in ("a", "b"):
        with_sets = with_sets.join(sets.select(F.col("cid").alias(side), F.col("set").alias(f"set_{side}")), side)
    checked = stage(with_sets.select("a", "b", "set_a", "set_b").mapInArrow(run, schema).distinct())
    if checked.count() != pairs.count():
        raise RuntimeError("a set that a link is checked with was not made")
    return checked


# -- components -------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(cid, component) for the ends of ``edges`` (a, b): the smallest id each is connected to.

    In turns, blocks of at most about EDGES edges are each reduced to stars, and all
    edges are moved by alternating stars: every node's larger neighbours to its
    smallest one, then its smaller ones. It ends when only stars are left.
    """
    pairs = stage(_ordered(edges))
    blocks = max(1, ceil(pairs.count() / EDGES))
    pairs = stage(_contracted(pairs.coalesce(blocks)))
    while blocks > 1 and not _are_stars(pairs):  # one block is whole when it is reduced
        large = _star(pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), True)
        pairs = stage(_contracted(_star(stage(large), False).coalesce(blocks)))
    ends = pairs.select(F.col("a").alias("cid"), F.col("b").alias("component"))
    return ends.unionAll(pairs.select("b", "b")).groupBy("cid").agg(F.min("component").alias("component"))


def _contracted(pairs: DataFrame) -> DataFrame:
    """The same connections as stars, within each partition."""
    schema = "a long, b long"
    arrow = to_arrow(pairs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while (up := parent.get(x, x)) != top:
                parent[x], x = top, up
            return top

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
                parent.setdefault(min(x, y), min(x, y))
        stars = [(x, root(x)) for x in parent]
        yield _batch([(x, top) for x, top in stars if x != top], arrow)

    return pairs.mapInArrow(run, schema)


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one at most, which itself has none."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionAll(
        pairs.select(F.col("b").alias("node"), F.lit(0).alias("up"))
    )
    ups = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count_if(F.col("up") == 0).alias("downs"))
    return not ups.where("ups > 1 or (ups = 1 and downs > 0)").take(1)


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges from the larger end a to the smaller end b."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star, of edges in both directions, or small star, of edges to smaller ends."""
    least = edges.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    joined = edges.join(least, "a")
    if larger:
        return joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    both = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(
        least.select("a", F.col("least").alias("b"))
    )
    return both.where("a != b").distinct()


# -- the join -----------------------------------------------------------------------------


def _pairs_of(edges: DataFrame) -> DataFrame:
    """The distinct pairs of edges of cells, each in a direction that one of them has."""
    pairs = edges.groupBy(F.greatest("a", "b").alias("_a"), F.least("a", "b").alias("_b"))
    return pairs.agg(F.min(F.struct("a", "b")).alias("edge")).select("edge.*", "_a", "_b")


def _lost(edges: DataFrame, known: DataFrame) -> DataFrame:
    """The edges of cells that turned out to be no links."""
    bad = known.where("not ok").select(F.greatest("a", "b").alias("_a"), F.least("a", "b").alias("_b"))
    ends = edges.withColumns({"_a": F.greatest("a", "b"), "_b": F.least("a", "b")})
    return ends.join(bad, ["_a", "_b"]).drop("_a", "_b")


def _class_components(docs: DataFrame, classes: DataFrame, percent: int, ngram: int) -> DataFrame:
    """(cid, component) for the classes that link to another one."""
    groups = _groups(_entries(classes, _boundary(classes), percent))
    marks = classes.select("cid", F.col("one.m1").alias("m1"), F.col("one.m2").alias("m2"))
    parts: list[DataFrame] = []

    def sets_of(cids: DataFrame) -> DataFrame:
        """(cid, set) of these classes at least; each is made once."""
        for made in parts:
            cids = cids.join(made.select("cid"), "cid", "left_anti")
        parts.append(stage(_sets(docs, stage(marks.join(cids, "cid", "left_semi")), ngram)))
        return reduce(DataFrame.unionAll, parts)

    large = _large(groups)
    found = _linked(_first_cells(groups, large, classes), sets_of, None, percent)
    further = _further_cells(groups, large, classes, found, percent) if large.take(1) else None
    return found if further is None else _linked(further, sets_of, found, percent)


def _linked(
    cells: DataFrame, sets_of: Callable[[DataFrame], DataFrame], found: DataFrame | None, percent: int
) -> DataFrame:
    """(cid, component) from the links within cells and the components ``found`` before."""
    usual = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(usual, ceil(cells.count() / (2 * CELL)))
    no_loss = F.lit(None).cast("long").alias("lost")

    def with_components(members: DataFrame) -> DataFrame:
        if found is None:
            return members.select("*", F.col("cid").alias("component"), no_loss)
        joined = members.join(found, "cid", "left")
        return joined.withColumn("component", F.coalesce("component", "cid")).select("*", no_loss)

    columns = [*CELL_KEY, "cid", "n", "bitmap", "component", "lost"]
    new = stage(_forests(with_components(cells).select(*columns), percent, tasks, True, ALTERNATIVES))
    sets = sets_of(new.where("a = b").select(F.col("a").alias("cid")).distinct())
    new = new.where("a != b")
    edges, pairs, known = new, _pairs_of(new).drop("_a", "_b"), None
    alternatives, first = ALTERNATIVES, True
    while True:
        alternatives *= FURTHER
        checked = _checked(stage(pairs), sets, percent)
        known = checked if known is None else known.unionAll(checked)
        joined = checked.where("ok").select("a", "b")
        found = stage(components(joined if found is None else joined.unionAll(found)))
        active = stage(_lost(new, known).select(*CELL_KEY).distinct())
        if not active.take(1):
            return found
        if first:
            first = False
            again = cells.join(active, CELL_KEY)
            active = again.groupBy(*CELL_KEY).agg(F.sum("n").alias("values")).where(F.col("values") > SET_VALUES)
            active = stage(active.drop("values"))
            whole = with_components(again.join(small(active), CELL_KEY, "left_anti")).join(sets, "cid")
            exact = _exact_forests(whole.select(*CELL_KEY, "cid", "component", "set"), percent, tasks)
            found = stage(components(exact.select("a", "b").unionAll(found)))
            if not active.take(1):
                return found
        members = with_components(cells.join(active, CELL_KEY))
        gone = _lost(edges.join(active, CELL_KEY, "left_semi"), known).distinct().withColumnRenamed("a", "cid")
        gone = gone.withColumns(
            {"n": F.lit(0), "bitmap": F.lit(b""), "component": F.lit(0).cast("long"), "lost": F.col("b")}
        )
        new = stage(_forests(members.select(*columns).unionAll(gone.select(*columns)), percent, tasks, False, alternatives))
        edges = edges.unionAll(new)
        seen = known.select(F.greatest("a", "b").alias("_a"), F.least("a", "b").alias("_b"))
        pairs = _pairs_of(new).join(seen, ["_a", "_b"], "left_anti").drop("_a", "_b")


def _by_digest(nodes: DataFrame, of_class: DataFrame) -> DataFrame:
    """``nodes`` joined with a row for each class (digest, copies and others).

    Classes with more than a thousandth of all rows, of which there are less than a
    thousand, are broadcast, so no task gets all copies of a text.
    """
    total = nodes.count()
    hot = F.col("copies") > max(100, total // 1000)
    many = F.broadcast(of_class.where(hot).drop("copies"))
    few = of_class.where(~hot).drop("copies")
    rest = nodes.join(many.select("digest"), "digest", "left_anti")
    return nodes.join(many, "digest").unionByName(rest.join(few, "digest"))


def _joined(docs: DataFrame, percent: int, ngram: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` as nodes, and (digest, copies, component, low, one) of each class.

    ``low`` and ``one`` are the smallest id and the first document of its component.
    """
    nodes = stage(_nodes(docs, count_table(docs, ngram), percent, ngram))
    classes = _classes(nodes)
    found = _class_components(docs, classes, percent, ngram)
    slim = classes.select("cid", "digest", "copies", "low", "one").join(found, "cid", "left")
    slim = stage(slim.withColumn("component", F.coalesce("component", "cid")).drop("cid"))
    firsts = slim.groupBy("component").agg(F.min("low").alias("low"), F.min("one").alias("one"))
    linked = stage(firsts.join(found.select("component").distinct(), "component", "left_semi"))
    alone = slim.join(small(linked.select("component")), "component", "left_anti")
    together = slim.drop("low", "one").join(small(linked), "component")
    return nodes.select("doc_id", "m1", "m2", "n", "digest"), stage(alone.unionByName(together))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, ngram: int = NGRAM) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) for each
    row of ``docs`` (doc_id, text).

    A null text, or one without words, has no n-grams and links with nothing, also not
    with its like. Rows with equal sets link, repeated rows among them. Null ids are
    never the smallest while another is in the component. An empty table gives an
    empty one.
    """
    nodes, of_class = _joined(docs, percent, ngram)
    linked = _by_digest(nodes.where("n > 0"), of_class.select("digest", "copies", F.col("low").alias("component_id")))
    empty = nodes.where("n = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id"]
    return linked.select(*columns).unionAll(empty.select(*columns))


def distinct_documents(docs: DataFrame, percent: int = PERCENT, ngram: int = NGRAM) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any others), with all their columns, but
    only one of each component: that of the smallest id, null first.

    Rows without words are all kept. Of repeated rows one stays.
    """
    nodes, of_class = _joined(docs, percent, ngram)
    judged = _by_digest(nodes.where("n > 0"), of_class.select("digest", "copies", "one"))
    first = (F.col("m1") == F.col("one.m1")) & (F.col("m2") == F.col("one.m2"))
    marks = stage(judged.groupBy("m1", "m2").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("rows")))
    dropped, repeated = marks.where("not first"), marks.where("first and rows > 1")
    rows = _marked(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")).select("row", "m1", "m2")
    some, kept = _maybe_among(rows, stage(marks.where("not first or rows > 1")))
    some = some.join(dropped.select("m1", "m2"), ["m1", "m2"], "left_anti")
    once = some.join(repeated.select("m1", "m2"), ["m1", "m2"], "left_semi").dropDuplicates(["m1", "m2"])
    others = some.join(repeated.select("m1", "m2"), ["m1", "m2"], "left_anti")
    return kept.select("row.*").unionAll(once.select("row.*")).unionAll(others.select("row.*"))
