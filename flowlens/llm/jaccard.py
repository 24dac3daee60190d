"""N-gram Jaccard join by count-vector R-trees.

A text's set is its distinct five-word shingles (lower-cased A-Z); two texts link when 100 * intersection >= 80 * union.
Texts with equal sets are one node from the start. Shingles are hashed into GROUPS groups; a node's group counts are a
point, and the sum of the smaller coordinates of two points, or of a point and the upper corner of a tree's box, is an
upper bound of the intersection. Points are indexed by an R-tree in each block, the bound discards boxes and pairs, and
what survives is verified on the whole sets.

Blocks lose no link: linked sets share one of their first n - ceil(0.8 n) + 1 shingles in any order that is the same
for all texts. The order puts frequent shingles last, then goes by hash, so that blocks stay small where a passage is
widely shared. Blocks that hold the same nodes are joined once, and large blocks whose least node is the same, as those of
one passage mostly are, are one block of all their nodes. A block of more than CHUNK nodes is dealt into
chunks, each node to one. In large blocks and chunks, near pairs are verified first; then only nodes that are still apart, for
which a dealt block's nodes are put in cells by component and size, and all cells meet but those of one component. There a
block's pairs stay in its task: nodes whose bound reaches one of another component come with their whole sets, and a pair is
verified only if the links found so far leave it apart, so a group of near copies costs rows for its nodes, not its pairs. Which
shingles need dealing is told by whole sets of a sample of the texts: that decides where a block is cut, never what links.

Null and blank texts have empty sets and link with nothing. Null ids count as no id: a group's id is its smallest
other one. Rows with equal text are one node, whatever their id. An empty table gives an empty result; other columns are
ignored. Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.common import scratch_scope, slices, small_batches, small_side, stored, text_bytes, text_column
from flowlens.llm.graph import components, merged
from flowlens.llm.words import distinct_sets, find_words, mix

SHINGLE = 5
#: Least groups; a set has four times as many until they hold PER_GROUP shingles each at most. Nodes of large blocks that
#: are still apart are compared in groups four times finer.
GROUPS = 256
PER_GROUP = 4
FINER = 1
LEAF = 16
#: Counts are kept in a byte; a node with a larger one is a point that bounds nothing.
MOST = 255
#: Larger sets have coarse points of 2^32 groups.
MOST_COARSE = 4096
#: Nodes of a chunk of a dealt block, about. One in CHUNK / CHUNK_HITS texts is in the sample that finds such blocks.
CHUNK, CHUNK_HITS = 4096, 256
#: Nodes of each chunk that meet nodes of the first chunk at once.
LINKING = 8
#: A shingle is frequent from this count on. Frequent ones are marks in a table of 2^MARK_BITS bits; the count is doubled
#: while they would fill more than a quarter of it. A shingle that shares another's mark only comes later in the order.
FREQUENT = 32
MARK_BITS = 27
#: Counts are known, for dealing, of shingles that a chunk's CHUNK / KNOWN_PARTS nodes hold.
KNOWN_PARTS = 4
#: Blocks up to this size, a leaf, are taken apart into their pairs.
SMALL_BLOCK = LEAF
#: A node's last bits hold its size as a power of STEP; sizes of linked sets are at most REACH steps apart.
SIZE_BITS, STEP, REACH = 10, 1.02, 12
#: Up to this many node ids are sent to the tasks; more are joined.
BROADCAST_NODES = 1 << 20
#: Up to this many ids are sent as they stand, with repeats.
BROADCAST_REPEATS = 1 << 18
#: Pairs are verified at once on whole sets if they are at most one for so many texts; more go by coarse points first.
TEXTS_PER_PAIR = 4
#: Nodes of a large block with which all its others are compared at first, at most.
LEADERS = 32


def needed(n: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """Smallest intersection of linked sets of these sizes: 9 i >= 4 (n + m)."""
    return -((-4 * (n + m)) // 9)


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def counted_length(n: int) -> int:
    """The part of a set whose shingles' frequencies are counted: the prefix and half as much again."""
    return min(n, prefix_length(n) + n // 10)


def name_of(numbers: np.ndarray) -> np.uint64:
    """64 bits for a whole set of numbers."""
    total = np.bitwise_xor.reduce(mix(numbers + np.uint64(0x632BE59BD9B4E019)))
    summed = np.add.reduce(mix(numbers ^ np.uint64(0xD1B54A32D192ED03)))
    return mix(np.array([total ^ mix(np.array([summed + np.uint64(len(numbers))]))[0]]))[0]


def node_of(shingles: np.ndarray) -> int:
    """A set's name and size, as a signed number."""
    size = min(round(math.log(len(shingles)) / math.log(STEP)), (1 << SIZE_BITS) - 1)
    return int((name_of(shingles) >> np.uint64(SIZE_BITS) << np.uint64(SIZE_BITS) | np.uint64(size)).astype(np.int64))


def size_step(nodes: np.ndarray) -> np.ndarray:
    return nodes & ((1 << SIZE_BITS) - 1)


class CountTree:
    """R-tree over count vectors, packed by halving along the widest coordinate; a box keeps its upper corner and sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, apart: np.ndarray | None = None):
        self.points, self.sizes = points, sizes
        self.apart = np.arange(len(points)) if apart is None else apart
        self.root = self._pack(np.arange(len(points)))

    def _pack(self, rows: np.ndarray):
        points = self.points[rows]
        top, least, most = points.max(axis=0), int(self.sizes[rows].min()), int(self.sizes[rows].max())
        if len(rows) <= LEAF:
            return top, least, most, rows, None
        widest = int((top - points.min(axis=0)).argmax())
        half = np.argsort(points[:, widest], kind="stable")
        cut = len(rows) // 2
        return top, least, most, rows, (self._pack(rows[half[:cut]]), self._pack(rows[half[cut:]]))

    def _only(self, rows: np.ndarray) -> int | None:
        """The number in `apart` that all rows have now."""
        numbers = self.apart[rows]
        return int(numbers[0]) if (numbers == numbers[0]).all() else None

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows whose bound reaches what a link needs; with `apart`, only rows of different numbers. Numbers may be
        made equal on the way."""
        stack = [(self.root, self.root)]
        while stack:
            a, b = stack.pop()
            only = self._only(a[3])
            if only is not None and only == self._only(b[3]):
                continue
            if 5 * a[2] < 4 * b[1] or 5 * b[2] < 4 * a[1]:
                continue
            if a is not b and int(np.minimum(a[0], b[0]).sum()) < needed(a[1], b[1]):
                continue
            if a[4] is None and b[4] is None:
                i, j = np.meshgrid(a[3], b[3], indexing="ij")
                i, j = i.ravel(), j.ravel()
                ok = (i < j) if a is b else np.ones(len(i), bool)
                ok &= self.apart[i] != self.apart[j]
                i, j = i[ok], j[ok]
                bound = np.minimum(self.points[i], self.points[j]).sum(axis=1)
                ok = bound >= needed(self.sizes[i], self.sizes[j])
                if ok.any():
                    yield i[ok], j[ok]
            elif a is b:
                stack += [(a[4][0], a[4][0]), (a[4][0], a[4][1]), (a[4][1], a[4][1])]
            elif b[4] is None or (a[4] is not None and len(a[3]) >= len(b[3])):
                stack += [(a[4][0], b), (a[4][1], b)]
            else:
                stack += [(a, b[4][0]), (a, b[4][1])]


def shingle_nodes(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, node, n, packed): node null where the set is empty; packed, the set, once for each node and task."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            sets = distinct_sets(find_words(text_column(batch, "text"), lower=True), SHINGLE)
            nodes = [node_of(s) if len(s) else None for s in sets]
            packed = []
            for node, s in zip(nodes, sets, strict=True):
                packed.append(None if node is None or node in seen else s.tobytes())
                seen.add(node)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            arrays = [batch.column(0), pa.array(nodes, pa.int64()), sizes, pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "node", "n", "packed"])

    return rows.mapInArrow(work, f"doc_id {dict(rows.dtypes)['doc_id']}, node long, n long, packed binary")


def node_sets(rows: DataFrame) -> DataFrame:
    """(node, n, packed) of `shingle_nodes`; a node may stand there several times."""
    return rows.filter("packed IS NOT NULL").select("node", "n", "packed")


def _new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Nodes with their sets, once for each task."""
    seen: set[int] = set()
    for batch in batches:
        found = []
        for node, packed in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            if node not in seen:
                seen.add(node)
                found.append((node, np.frombuffer(packed.as_buffer(), np.uint64)))
        yield found


class Frequent(NamedTuple):
    """Shingles many nodes hold: marks of all, and ascending hashes and counts of the most frequent."""

    marks: np.ndarray
    keys: np.ndarray
    counts: np.ndarray

    def often(self, shingles: np.ndarray) -> np.ndarray:
        bits = shingles >> np.uint64(64 - MARK_BITS)
        marked = (self.marks[(bits >> np.uint64(6)).astype(np.int64)] >> (bits & np.uint64(63))) & np.uint64(1) != 0
        return marked | (self._known(shingles)[1])

    def count(self, shingles: np.ndarray) -> np.ndarray:
        at, known = self._known(shingles)
        return np.where(known, self.counts[at], 1) if len(self.keys) else np.ones(len(shingles), np.int64)

    def _known(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return np.zeros(len(shingles), np.int64), np.zeros(len(shingles), bool)
        at = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        return at, self.keys[at] == shingles


def frequent_shingles(sets: DataFrame) -> Frequent:
    """Shingles that many nodes hold: of each set's first part in hash order, or, with a chunk's share of holders,
    anywhere, told from a sample of nodes. The driver gets the marks, at most 2^(MARK_BITS - 6) numbers, and large counts."""
    one_in = max(1, CHUNK // CHUNK_HITS)

    def counted(rows: DataFrame, whole: bool) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for found in _new_sets(batches):
                if found:
                    keys = np.concatenate([s if whole else s[: counted_length(len(s))] for _, s in found])
                    yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64))], names=["key"])

        return rows.mapInArrow(work, "key long").groupBy("key").agg(F.count("*").alias("n"))

    early = stored(counted(sets, False).filter(F.col("n") >= FREQUENT), "frequent")
    above = dict(early.groupBy(F.floor(F.log2(F.col("n") / FREQUENT)).alias("level")).count().collect())
    level = 0
    while sum(n for at, n in above.items() if at >= level) > 1 << (MARK_BITS - 2):
        level += 1
    bit = F.shiftrightunsigned("key", 64 - MARK_BITS)
    mark = F.expr("shiftleft(1L, cast(bit & 63 AS int))")
    marked = early.filter(F.col("n") >= FREQUENT << level).select(bit.alias("bit"))
    words = marked.groupBy(F.expr("bit >> 6").alias("word")).agg(F.bit_or(mark).alias("held")).toPandas()
    marks = np.zeros(1 << (MARK_BITS - 6), np.uint64)
    marks[words["word"].to_numpy(np.int64)] = words["held"].to_numpy(np.int64).view(np.uint64)

    least = max(1, CHUNK // KNOWN_PARTS)
    sample = sets.filter(F.pmod(F.xxhash64("node"), F.lit(one_in)) == 0).dropDuplicates(["node"])
    anywhere = counted(sample, True).withColumn("n", F.col("n") * one_in)
    rows = pd.concat([x.filter(F.col("n") >= least).toPandas() for x in (early, anywhere)]).groupby("key", as_index=False)["n"].max()
    keys = rows["key"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(keys)
    return Frequent(marks, keys[order], rows["n"].to_numpy(np.int64)[order])


def blocks(sets: DataFrame, frequent: Frequent) -> DataFrame:
    """(block, nodes, dealt): distinct groups of two or more nodes that share a shingle of their prefixes; for a chunk,
    `dealt` is the shingle, which all chunks of its block have, else 0."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _new_sets(batches):
            keys, nodes, dealt = [], [], []
            for node, s in found:
                p = prefix_length(len(s))
                often = frequent.often(s)
                rare = s[~often][:p]
                shared = s[often][: p - len(rare)]
                chunks = -(-frequent.count(shared) // CHUNK)
                chunk = mix(np.array([node], np.int64).astype(np.uint64))[0] % chunks.astype(np.uint64)
                own = np.concatenate((rare, np.where(chunks > 1, mix(shared ^ mix(chunk + np.uint64(1))), shared)))
                dealt += [np.zeros(len(rare), np.uint64), np.where(chunks > 1, shared, np.uint64(0))]
                keys.append(own)
                nodes.append(np.full(len(own), node, np.int64))
            if keys:
                arrays = [pa.array(np.concatenate(x).astype(np.int64)) for x in (keys, nodes, dealt)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "node", "dealt"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of equal keys; the last run of a batch waits for the next batch."""
        key, held, of = None, np.empty(0, np.int64), 0
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys, nodes, dealt = (batch.column(k).to_numpy() for k in range(3))
            if not len(keys):
                continue
            bounds = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
            begins, ends = bounds[:-1], bounds[1:]
            pairs: list[np.ndarray] = []
            large: list[tuple[np.ndarray, int]] = []
            if key is not None and keys[0] == key:
                held = np.concatenate((held, nodes[: ends[0]]))
                begins, ends = begins[1:], ends[1:]
            if len(begins):
                take_apart(held, of, pairs, large)
                key, held, of = keys[-1], nodes[begins[-1] :].copy(), int(dealt[-1])
                begins, ends = begins[:-1], ends[:-1]
                two = begins[(ends - begins == 2) & (dealt[begins] == 0)]
                pairs.append(np.stack((nodes[two], nodes[two + 1]), axis=1))
                more = (ends - begins > 2) | (dealt[begins] != 0)
                for a, b in zip(begins[more], ends[more], strict=True):
                    take_apart(nodes[a:b], int(dealt[a]), pairs, large)
            if pairs or large:
                yield rows(pairs, large, seen)
        pairs, large = [], []
        take_apart(held, of, pairs, large)
        if pairs or large:
            yield rows(pairs, large, seen)

    def take_apart(nodes: np.ndarray, dealt: int, pairs: list[np.ndarray], large: list[tuple[np.ndarray, int]]) -> None:
        """Small blocks become pairs; large ones are cut where sizes leave a gap. Chunks stay as they are."""
        if dealt:
            large.append((np.unique(nodes), dealt))
            return
        if len(nodes) < 2:
            return
        nodes = np.unique(nodes)
        if len(nodes) <= SMALL_BLOCK:
            i, j = np.triu_indices(len(nodes), 1)
            pairs.append(np.stack((nodes[i], nodes[j]), axis=1))
            return
        nodes = nodes[np.argsort(size_step(nodes), kind="stable")]
        for part in np.split(nodes, np.flatnonzero(np.diff(size_step(nodes)) > REACH) + 1):
            if len(part) > SMALL_BLOCK:
                large.append((np.sort(part), 0))
            else:
                take_apart(part, 0, pairs, large)

    def rows(pairs: list[np.ndarray], large: list[tuple[np.ndarray, int]], seen: set[tuple[int, int]]) -> pa.RecordBatch:
        both = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
        both = np.sort(both[np.abs(size_step(both[:, 0]) - size_step(both[:, 1])) <= REACH], axis=1)
        both = both[both[:, 0] != both[:, 1]]
        names = mix(both[:, 0].astype(np.uint64) ^ mix(both[:, 1].astype(np.uint64))).view(np.int64)
        names, first = np.unique(names, return_index=True)
        both, blocks = both[first], []
        for block, of in large:
            name = int(name_of(block.astype(np.uint64)).astype(np.int64))
            if (name, of) not in seen:
                seen.add((name, of))
                blocks.append((name, block, of))
        dealt = np.concatenate((np.zeros(len(both), np.int64), np.array([of for _, _, of in blocks], np.int64)))
        names = np.concatenate((names, np.array([name for name, _, _ in blocks], np.int64)))
        nodes = np.concatenate((both.ravel(), *(block for _, block, _ in blocks)))
        sizes = np.concatenate((np.full(len(both), 2), [len(block) for _, block, _ in blocks])).astype(np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(nodes, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(names), lists, pa.array(dealt)], names=["block", "nodes", "dealt"])

    keyed = sets.mapInArrow(prefixes, "key long, node long, dealt long")
    grouped = keyed.repartition("key").sortWithinPartitions("key").select("key", "node", "dealt")
    return grouped.mapInArrow(gather, "block long, nodes array<long>, dealt long").dropDuplicates(["block", "dealt"])


def one_of_equal(chunks: DataFrame) -> DataFrame:
    """The chunks of dealt blocks, those of equal blocks once."""
    hashes = [F.bit_xor(F.xxhash64("block")).alias("x"), F.bit_xor(F.xxhash64("block", F.lit(1))).alias("y"), F.count("*").alias("z")]
    kept = chunks.groupBy("dealt").agg(*hashes).groupBy("x", "y", "z").agg(F.min("dealt").alias("dealt"))
    return chunks.join(kept.select("dealt"), "dealt", "left_semi")


def linking_pairs(chunks: DataFrame) -> DataFrame:
    """Pairs (a, b) of some nodes of each chunk and of its block's first chunk."""
    some = chunks.select("dealt", F.slice("nodes", 1, LINKING).alias("some"))
    first = some.groupBy("dealt").agg(F.min("some").alias("first"))
    pairs = some.join(first, "dealt").select(F.explode("some").alias("a"), "first").select("a", F.explode("first").alias("b"))
    return pairs.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def cell_blocks(known: DataFrame) -> DataFrame:
    """(block, node, component) of (dealt, node, component): blocks of one or two cells in which all nodes of a dealt block
    meet that are of different components and of sizes that can link. A cell holds about CHUNK nodes of REACH steps of size, of
    one component where that has many, else of several."""
    banded = known.withColumn("band", F.floor(F.col("node").bitwiseAND((1 << SIZE_BITS) - 1) / REACH))
    own = banded.groupBy("dealt", "band", "component").agg(F.count("*").alias("own"))
    marked = own.withColumn("only", F.when(2 * F.col("own") >= CHUNK, F.col("component")))
    sums = marked.groupBy("dealt", "band", "only").agg(F.ceil(F.sum("own") / CHUNK).alias("cells"))
    marked = marked.join(sums.withColumnRenamed("only", "_o").withColumnsRenamed({"dealt": "_d", "band": "_b"}),
                         (F.col("dealt") == F.col("_d")) & (F.col("band") == F.col("_b")) & F.col("only").eqNullSafe(F.col("_o")))
    marked = marked.select("dealt", "band", "component", "only", "cells")
    cell = F.struct("band", "only", F.pmod(F.xxhash64("node"), F.col("cells")).alias("part"))
    placed = stored(banded.join(marked, ["dealt", "band", "component"]).select("dealt", "node", "component", cell.alias("cell")), "cells")
    cells = placed.select("dealt", "cell").distinct()
    meeting = cells.join(cells.select("dealt", F.col("cell").alias("other")), "dealt").filter(
        "cell <= other AND abs(cell.band - other.band) <= 1 AND coalesce(cell.only != other.only, true)"
    )
    meeting = meeting.withColumn("block", F.xxhash64("dealt", "cell.band", "cell.only", "cell.part", F.lit(0), "other.band", "other.only", "other.part"))
    sides = meeting.select("dealt", "block", F.explode(F.array_distinct(F.array("cell", "other"))).alias("cell"))
    return placed.join(sides, ["dealt", "cell"]).select("block", "node", "component")


def joined_blocks(large: DataFrame) -> DataFrame:
    """(block, node) of stored blocks (block, nodes): those with the same least node, by a hash, as one block, as long as that has
    CHUNK nodes at most. All nodes that met in a block still meet."""
    named = large.select("block", "nodes", F.array_min(F.transform("nodes", lambda x: F.xxhash64(x))).alias("least"))
    rows = stored(named.select("least", F.explode("nodes").alias("node")).distinct(), "joined")
    wide = stored(rows.groupBy("least").agg(F.count("*").alias("n")).filter(F.col("n") > CHUNK).select("least"), "wide")
    if wide.isEmpty():
        return rows.withColumnRenamed("least", "block")
    apart = named.join(wide, "least", "left_semi").select("block", F.explode("nodes").alias("node"))
    return stored(rows.join(wide, "least", "left_anti").withColumnRenamed("least", "block").union(apart), "joined")


def of_nodes(sets: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """The sets of the nodes wanted, which stand in that many rows; still with repeats."""
    if rows <= BROADCAST_REPEATS:
        return sets.join(F.broadcast(wanted), "node", "left_semi")
    return sets.join(small_side(stored(wanted.distinct(), "wanted"), BROADCAST_NODES), "node", "left_semi")


def tier_of(sizes: np.ndarray) -> np.ndarray:
    """How often a set of this size has its groups multiplied by four; at most to 65,536 groups."""
    return np.searchsorted(PER_GROUP * GROUPS * 4 ** np.arange(4), sizes)


def point_of(shingles: np.ndarray, finer: int = 0) -> bytes:
    tier = int(tier_of(np.array([len(shingles)]))[0]) + finer
    counts = np.bincount((shingles >> np.uint64(56 - 2 * tier)).astype(np.int64), minlength=GROUPS << (2 * tier))
    return np.minimum(counts, MOST).astype(np.uint8).tobytes()


class Points:
    """Points of nodes of any sizes; finer groups are added up to coarser ones."""

    def __init__(self, packed: pa.Array, sizes: np.ndarray, finer: int = 0):
        self.offsets, self.data = text_bytes(packed)
        self.tiers = tier_of(sizes) + finer
        self.sizes = sizes

    def at(self, rows: np.ndarray, tier: int) -> np.ndarray:
        groups = GROUPS << (2 * tier)
        out = np.empty((len(rows), groups), np.int32)
        for t in range(tier, int(self.tiers[rows].max(initial=tier)) + 1):
            here = np.flatnonzero(self.tiers[rows] == t)
            if len(here):
                own = self.data[self.offsets[rows[here]][:, None] + np.arange(GROUPS << (2 * t))]
                summed = own.reshape(len(here), groups, -1).sum(axis=2, dtype=np.int32)
                summed[(own == MOST).any(axis=1)] = 1 << 20
                out[here] = summed
        return out

    def reach(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether the bounds of the pairs of rows allow a link."""
        tiers, ok = np.minimum(self.tiers[i], self.tiers[j]), np.zeros(len(i), bool)
        for t in np.unique(tiers):
            here, step = np.flatnonzero(tiers == t), max(1, 4_000_000 // (GROUPS << (2 * int(t))))
            for at in range(0, len(here), step):
                x, y = i[here[at : at + step]], j[here[at : at + step]]
                bound = np.minimum(self.at(x, int(t)), self.at(y, int(t))).sum(axis=1)
                ok[here[at : at + step]] = (x != y) & (bound >= needed(self.sizes[x], self.sizes[y]))
        return ok

    def tree(self, rows: np.ndarray, apart: np.ndarray | None = None) -> CountTree:
        return CountTree(self.at(rows, int(self.tiers[rows].min())), self.sizes[rows], apart)


def node_points(sets: DataFrame, finer: int = 0) -> DataFrame:
    """(node, n, packed) with each node once and its point for its set."""

    @F.pandas_udf("binary")
    def of(packed: pd.Series) -> pd.Series:
        return packed.map(lambda x: point_of(np.frombuffer(x, np.uint64), finer))

    return sets.select("node", "n", of("packed").alias("packed")).dropDuplicates(["node"])


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows ordered by their first column, as batches with all rows of each of its values and the bounds of these."""
    held = None
    for batch in batches:
        table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        names = table.column(0).to_numpy()
        if not len(names):
            continue
        begins = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
        held = table.slice(begins[-1])
        if len(begins) > 1:
            yield table.slice(0, begins[-1]), begins
    if held is not None:
        yield held, np.array([0, held.num_rows])


def by_block(members: DataFrame) -> DataFrame:
    return members.repartition("block").sortWithinPartitions("block", "n", "node")


def near_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) that each block's tree leaves, with repeats. Of large blocks, each node with one of a few leaders and its
    neighbours in size. Blocks are streamed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_blocks(batches):
            yield pairs_of(table, bounds)

    def pairs_of(table: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
        nodes, sizes = table.column(1).to_numpy(), table.column(2).to_numpy()
        points = Points(table.column(3), sizes)
        two = bounds[:-1][np.diff(bounds) == 2]
        found = [(two, two + 1)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 2:
                rest = np.arange(a, b)
                if b - a <= SMALL_BLOCK:
                    found += [(i + a, j + a) for i, j in points.tree(rest).pairs()]
                else:
                    found += [*led(points, rest, sizes), (rest[:-1], rest[1:])]
        i, j = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        ok = points.reach(i, j)
        i, j = i[ok], j[ok]
        pairs = np.unique(np.stack((np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def led(points: Points, rest: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Leaders with those that their bound lets link; what is left has the next leader."""
        at = points.at(rest, int(points.tiers[rest].min()))
        for _ in range(LEADERS):
            if len(rest) < 2:
                return
            near = np.minimum(at[1:], at[0]).sum(axis=1) >= needed(sizes[rest[1:]], sizes[rest[0]])
            yield np.full(int(near.sum()), rest[0]), rest[1:][near]
            rest, at = rest[1:][~near], at[1:][~near]

    return by_block(members.select("block", "node", "n", "packed")).mapInArrow(work, "a long, b long")


def near_others(members: DataFrame) -> DataFrame:
    """The (block, node, component) of nodes whose bound, in finer groups, lets them link with one of another component in
    their block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_blocks(batches):
            points, components = Points(table.column(3), table.column(2).to_numpy(), FINER), table.column(4).to_numpy()
            near = np.zeros(table.num_rows, bool)
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                for i, j in points.tree(np.arange(a, b), components[a:b]).pairs():
                    new = ~(near[i + a] & near[j + a])
                    i, j = i[new] + a, j[new] + a
                    ok = points.reach(i, j)
                    near[i[ok]] = near[j[ok]] = True
            kept = pa.array(near)
            yield pa.RecordBatch.from_arrays([table.column(k).filter(kept) for k in (0, 1, 4)], names=["block", "node", "component"])

    ordered = by_block(members.select("block", "node", "n", "packed", "component"))
    return ordered.mapInArrow(work, "block long, node long, component long")


def block_links(members: DataFrame) -> DataFrame:
    """(u, v), components that links in a block connect: as few in each as connect them, so at most one for each node. `packed`
    is the whole set here."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_blocks(batches):
            components, packed = table.column(4).to_numpy(), table.column(3)
            found = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in packed.slice(a, b - a)]
                found += [(int(components[a + i]), int(components[a + j])) for i, j in links_of(sets, components[a:b].copy())]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    def links_of(sets: list[np.ndarray], apart: np.ndarray) -> Iterator[tuple[int, int]]:
        """Linked sets that no links before connect; `apart` has their components, which links make one."""
        points = Points(pa.array([point_of(s, FINER) for s in sets], pa.binary()), np.array([len(s) for s in sets]), FINER)
        for i, j in points.tree(np.arange(len(sets)), apart).pairs():
            ok = points.reach(i, j)
            for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
                if apart[x] != apart[y] and similar(sets[x], sets[y]):
                    yield x, y
                    apart[apart == apart[y]] = apart[x]

    ordered = by_block(members.select("block", "node", "n", "packed", "component"))
    return ordered.mapInArrow(work, "u long, v long")


def coarse(shingles: np.ndarray) -> bytes:
    """A point of 65,536 groups, or 2^32 for large sets, as the ascending numbers of the groups its shingles fall in."""
    wide = len(shingles) > MOST_COARSE
    return (shingles >> np.uint64(32 if wide else 48)).astype(np.uint32 if wide else np.uint16).tobytes()


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Sum of the smaller counts of each value of two ascending arrays."""
    held, counts = np.unique(x, return_counts=True)
    other, others = np.unique(y, return_counts=True)
    _, i, j = np.intersect1d(held, other, assume_unique=True, return_indices=True)
    return int(np.minimum(counts[i], others[j]).sum())


def coarse_point(packed: pd.Series) -> pd.Series:
    return packed.map(lambda x: coarse(np.frombuffer(x, np.uint64)))


def within_bound(left: pd.Series, n: pd.Series, right: pd.Series, m: pd.Series) -> pd.Series:
    out = []
    for x, a, y, b in zip(left, n, right, m, strict=True):
        wide = min(a, b) > MOST_COARSE
        x, y = (np.frombuffer(p, np.uint32 if k > MOST_COARSE else np.uint16) for p, k in ((x, a), (y, b)))
        if not wide:
            x, y = (p >> np.uint32(16) if p.dtype == np.uint32 else p for p in (x, y))
        out.append(common(x, y) >= needed(int(a), int(b)))
    return pd.Series(out, dtype=bool)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether whole sets link."""
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= 80 * (len(x) + len(y) - shared)


def linked(left: pd.Series, n: pd.Series, right: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(left, right, strict=True)], dtype=bool)


def verified(pairs: DataFrame, sets: DataFrame, by_coarse: bool = False) -> DataFrame:
    """The stored pairs (a, b) whose whole sets reach the similarity, as (u, v). With `by_coarse`, coarse points, a quarter of the
    sets' bytes, go first: whole sets are sent only for pairs that the bound of those lets through."""

    def ends(found: DataFrame) -> DataFrame:
        return of_nodes(sets, found.select(F.explode(F.array("a", "b")).alias("node")), 2 * found.count())

    def passing(found: DataFrame, sides: DataFrame, test) -> DataFrame:
        one = sides.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("packed").alias("left"))
        two = sides.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("packed").alias("right"))
        joined = found.join(one, "a").join(two, "b")
        return joined.filter(F.pandas_udf(test, "boolean")("left", "na", "right", "nb")).select(*found.columns)

    if by_coarse:
        points = ends(pairs).select("node", "n", F.pandas_udf(coarse_point, "binary")("packed").alias("packed")).dropDuplicates(["node"])
        pairs = stored(passing(pairs, points, within_bound), "bounded")
    sides = ends(pairs).dropDuplicates(["node"])
    return passing(pairs, sides, linked).select(F.col("a").alias("u"), F.col("b").alias("v"))


def still_apart(members: DataFrame, name: str, groups: DataFrame) -> DataFrame:
    """The (name, node) rows of groups of nodes that are of more than one component, with it."""
    known = members.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node")).select(name, "node", "component")
    mixed = known.groupBy(name).agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select(name)
    return known.join(mixed, name, "left_semi")


def row_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, component), one row for each row; component is a node's name, null where the set is empty."""
    spark = df.sparkSession
    small_batches(spark)
    with scratch_scope(spark) as kept:
        rows = stored(shingle_nodes(df, doc_id, text), "nodes")
        groups = stored(linked_groups(node_sets(rows), rows.count() // TEXTS_PER_PAIR), "groups")
        labelled = rows.join(groups, "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("component"))
        return kept(stored(labelled, "labelled"))


def linked_groups(sets: DataFrame, few: int) -> DataFrame:
    """(node, component) of the nodes that links connect with others, from stored sets. Up to `few` pairs are verified at once at
    first."""
    shared = stored(blocks(sets, frequent_shingles(sets)), "blocks")
    chunks = one_of_equal(shared.filter("dealt != 0"))
    small = F.size("nodes") <= SMALL_BLOCK
    large = joined_blocks(shared.filter("dealt = 0").filter(~small))
    whole = shared.filter("dealt = 0").filter(small).select("block", "nodes").union(chunks.select("block", "nodes").dropDuplicates(["block"]))
    members = stored(whole.select("block", F.explode("nodes").alias("node")).union(large.select("block", "node")), "members")
    points = node_points(of_nodes(sets, members.select("node"), members.count()))
    pairs = stored(near_pairs(members.join(points, "node")).union(linking_pairs(chunks)).distinct(), "pairs")
    groups = stored(components(verified(pairs, sets, by_coarse=pairs.count() > few)), "groups")

    dealt = chunks.select("dealt", F.explode("nodes").alias("node"))
    if not (large.isEmpty() and dealt.isEmpty()):
        later = still_apart(large, "block", groups)
        if not dealt.isEmpty():
            later = later.unionByName(cell_blocks(stored(still_apart(dealt, "dealt", groups), "apart")))
        later = stored(later, "later")
        points = node_points(of_nodes(sets, later.select("node"), later.count()), FINER)
        near = stored(near_others(later.join(points, "node")), "near")
        whole = of_nodes(sets, near.select("node"), near.count()).dropDuplicates(["node"])
        links = stored(block_links(near.join(whole, "node")), "links")
        groups = groups if links.isEmpty() else stored(merged(groups, links), "groups")
    return groups


def similar_groups(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row for each row."""
    labelled = row_groups(df, doc_id, text)
    smallest = labelled.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    out = labelled.join(smallest, "component", "left")
    alone = F.col("component").isNull()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"))
