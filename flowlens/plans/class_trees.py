"""One-vs-rest boosted trees as Spark ML's `OneVsRest(GBTClassifier)` fits them, with the ensembles of all classes grown in the same passes.

Candidate cuts, draws of `subsample`, residuals, impurities, ties and stopping follow Spark ML, on the same rows in the same partitions, so the
trees are the same ones but for rounding. Spark ML passes over its own copy of the rows, kept as objects, for every class and level; here a block
holds some rows, column by column: label, a byte for each input (its bin), a bit for each round (whether it draws the row) and a margin for each
class. A pass makes a level of all classes' trees: tasks add count, sum and sum of squares of the residuals up by (class, node, input, bin), the
sums of all tasks meet by node, and the driver, who sees only those sums, picks splits. Their number depends on classes, nodes, inputs and bins,
never on rows. Blocks of a round are kept in memory and on disk until those of the next are made.

Rows have a label and inputs that are finite numbers; others raise an error. An empty table raises an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache, partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import workers_find_package

# Spark ML's number of bins and of rows that cuts are found on, and its smallest number.
BINS = 32
SPLIT_ROWS = 10_000
EPSILON = 2.0**-52
#: Rows of a block, and rounds whose draws are the bits of one number.
BLOCK_ROWS, WORD = 1 << 16, 32
#: Nodes whose sums go to one task.
NODES_AT_ONCE = 64
#: Rows of a node from which on only the smaller of its children is counted. Smaller nodes are summed in Spark ML's order, to the last bit.
MANY_ROWS = 1 << 16
#: Table of the exponential: steps in 1, and up to where.
STEPS, REACH = 64, 700
#: The cut of a node without children: all bins lie to its left.
NO_CUT = 255
BLOCK = "label binary, bins binary, draws binary, margins binary"


@dataclass
class Trees:
    """The trees of a round, one row per class; the children of node i are 2i + 1 and 2i + 2. Below a leaf everything goes left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    weight: float

    @classmethod
    def empty(cls, classes: int, depth: int, weight: float) -> "Trees":
        shape = (classes, 2 ** (depth + 1) - 1)
        return cls(np.zeros(shape, np.int64), np.full(shape, NO_CUT, np.uint8), np.zeros(shape), weight)

    def nodes(self, k: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """Where the rows stand in the tree of class k that many levels below its root; `bins` is (input, row)."""
        node, rows, flat = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1]), bins.ravel()
        for _ in range(levels):
            right = flat.take(self.feature[k].take(node) * len(rows) + rows) > self.cut[k].take(node)
            node = 2 * node + 1 + right
        return node

    def margins(self, bins: np.ndarray) -> np.ndarray:
        depth = self.feature.shape[1].bit_length() - 1
        return np.stack([self.value[k].take(self.nodes(k, bins, depth)) * self.weight for k in range(len(self.value))])


# --- cuts and draws ----------------------------------------------------------------------------------


def sample_rows(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """The rows, about SPLIT_ROWS of them, that Spark ML finds cuts on: all if there are no more."""
    if n <= SPLIT_ROWS:
        return rows
    spark = rows.sparkSession
    number = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    few = rows._jdf.toJavaRDD().sample(False, SPLIT_ROWS / n, number)
    return DataFrame(spark._jsparkSession.createDataFrame(few, rows._jdf.schema()), spark)


def cuts_of(values: np.ndarray, n: int) -> np.ndarray:
    """Cuts of an input between its sampled values, about as many rows between any two; rows the sample lacks count as 0."""
    expected = min(1.0, SPLIT_ROWS / n) * n
    some = values[values != 0.0]
    found, counts = np.unique(some, return_counts=True)
    missing = expected - len(some)
    if len(some) and missing > EPSILON * len(some) * 100:
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts.astype(float), at, missing)
    if len(found) < 2:
        return np.array([])
    middle, most = (found[:-1] + found[1:]) / 2.0, min(BINS, n) - 1
    if len(middle) <= most:
        return middle
    cuts, stride, seen = [], expected / (most + 1), float(counts[0])
    target = stride
    for here, count in zip(middle, counts[1:], strict=True):
        before, seen = seen, seen + float(count)
        if abs(before - target) < abs(seen - target):
            cuts.append(here)
            target += stride
    return np.array(cuts)


def find_cuts(rows: DataFrame, inputs: list[str], n: int, seed: int) -> list[np.ndarray]:
    table = sample_rows(rows.select(*inputs), n, seed).toArrow()
    return [cuts_of(finite(table.column(i).to_numpy()), n) for i in range(len(inputs))]


def draw_columns(seed: int, share: float, rounds: int) -> list[Column]:
    """Numbers whose bits tell which rounds draw the row; none if all draw it. The generator and its seeds are those of Spark ML."""
    if share >= 1.0:
        return []
    bits = [F.when(F.rand(seed + 1 + r) < share, F.lit(1 << r % WORD)).otherwise(F.lit(0)).cast("long") for r in range(rounds)]
    return [reduce(Column.__add__, bits[i : i + WORD]).alias(f"draw_{i // WORD}") for i in range(0, rounds, WORD)]


# --- passes ------------------------------------------------------------------------------------------


def finite(values: np.ndarray) -> np.ndarray:
    if not np.isfinite(values).all():
        raise ValueError("inputs of boosted trees must be finite numbers")
    return values


def into_bins(columns: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x, "left").astype(np.uint8) for x, c in zip(columns, cuts, strict=True)])


def block(*arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], ["label", "bins", "draws", "margins"])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to tables of BLOCK_ROWS rows or some more."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        some.append(batch)
        if sum(b.num_rows for b in some) >= BLOCK_ROWS:
            yield pa.Table.from_batches(some)
            some = []
    if sum(b.num_rows for b in some):
        yield pa.Table.from_batches(some)


def binned(batches: Iterator[pa.RecordBatch], words: int, cuts: list[np.ndarray], classes: int) -> Iterator[pa.RecordBatch]:
    for table in gathered(batches):
        label, *columns = (c.to_numpy() for c in table.columns)
        draws = np.stack(columns[:words]).astype(np.uint32) if words else np.empty(0, np.uint32)
        yield block(label.astype(np.int32), into_bins([finite(c) for c in columns[words:]], cuts), draws, np.zeros((classes, len(label))))


Packed = tuple[bytes, bytes, bytes, bytes]


def unpacked(blocks: Iterable[Packed], inputs: int, classes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Label, bins (input, row), draws (word, row) and margins (class, row) of each block."""
    for one in blocks:
        label, bins, draws, margins = (np.frombuffer(x, k) for x, k in zip(one, (np.int32, np.uint8, np.uint32, np.float64), strict=True))
        yield label, bins.reshape(inputs, -1), draws.reshape(-1, len(label)), margins.reshape(classes, -1)


@cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """e to the multiples of 1 / STEPS, and what rounding took from them."""
    whole = np.exp(np.arange(-REACH * STEPS, REACH * STEPS + 1).astype(np.longdouble) / STEPS)
    return whole.astype(float), (whole - whole.astype(float)).astype(float)


def exp(x: np.ndarray) -> np.ndarray:
    """e^x, nearly always the closest double, as in the JVM. NumPy's is a bit off for a value in twenty: equal gains would then rank otherwise."""
    if np.abs(x).max(initial=0.0) > REACH:
        with np.errstate(over="ignore"):
            return np.exp(x)
    step = np.rint(x * STEPS)
    r = x - step / STEPS
    rest = r / 5040
    for c in (1 / 720, 1 / 120, 1 / 24, 1 / 6, 1 / 2, 1.0):
        rest += c
        rest *= r
    step += REACH * STEPS
    at, (high, low) = step.astype(np.int64), powers()
    high, low = high.take(at), low.take(at)
    rest *= high
    rest += low
    rest += high
    return rest


def residuals(label: np.ndarray, margin: np.ndarray, k: int, number: int) -> np.ndarray:
    """What the next tree of class k is fitted to: +-1 in the first round, then the negative gradient of the logistic loss."""
    y = np.where(label == k, 1.0, -1.0)
    if number == 0:
        return y
    return 4.0 * y / (1.0 + exp(2.0 * y * margin))


def level_sums(
    part: int, blocks: Iterable[Packed], inputs: int, growing: Trees, places: np.ndarray, level: int, number: int, bins_: int
) -> Iterator[tuple[int, tuple[int, np.ndarray]]]:
    """(nodes, (part, sums)): a task's counts, sums and sums of squares by (node, input, bin), for some nodes at a time.

    `places` is (class, node of this level): the number of a node to count, else -1.
    """
    classes, first = len(places), 2**level - 1
    ranges = [(p[p >= 0].min(), (p >= 0).sum()) if (p >= 0).any() else None for p in places]
    sums = np.zeros((3, places.max() + 1, inputs, bins_))
    for label, bins, draws, margins in unpacked(blocks, inputs, classes):
        if draws.size:
            used = np.flatnonzero(draws[number // WORD] >> np.uint32(number % WORD) & np.uint32(1))
            label, bins, margins = label.take(used), bins.take(used, axis=1), margins.take(used, axis=1)
        for k in range(classes):
            if ranges[k] is None:
                continue
            start, nodes = ranges[k]
            place, own, margin, mine = places[k].take(growing.nodes(k, bins, level) - first), label, margins[k], bins
            here = np.flatnonzero(place >= 0)
            if len(here) < len(place):
                place, own, margin, mine = place.take(here), own.take(here), margin.take(here), bins.take(here, axis=1)
            s = residuals(own, margin, k, number)
            at, q = (place - start) * bins_, s * s
            for i in range(inputs):
                slot = at + mine[i]
                for total, weights in zip(sums, (None, s, q), strict=True):
                    total[start : start + nodes, i] += np.bincount(slot, weights, nodes * bins_).reshape(nodes, bins_)
    for start in range(0, sums.shape[1], NODES_AT_ONCE):
        yield start, (part, sums[:, start : start + NODES_AT_ONCE])


def added(parts: Iterable[tuple[int, np.ndarray]]) -> np.ndarray:
    """The sums of all tasks, in the order of the parts."""
    return reduce(np.add, [sums for _, sums in sorted(parts, key=lambda p: p[0])])


def with_margins(blocks: Iterable[Packed], inputs: int, grown: Trees) -> Iterator[Packed]:
    for one in blocks:
        for _, bins, _, margins in unpacked([one], inputs, len(grown.value)):
            yield *one[:3], (margins + grown.margins(bins)).tobytes()


# --- splits ------------------------------------------------------------------------------------------


def mean(n: np.ndarray, s: np.ndarray) -> np.ndarray:
    return np.where(n > 0, s / np.maximum(n, 1.0), 0.0)


def variance(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    some = np.maximum(n, 1.0)
    return np.where(n > 0, (q - s * s / some) / some, 0.0)


@dataclass
class Splits:
    """Of each node: whether it is split, input and cut, the children's rows, means and impurities (side, node), and its own mean."""

    splits: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    counts: np.ndarray
    means: np.ndarray
    impurities: np.ndarray
    mean: np.ndarray


def best_splits(sums: np.ndarray, cuts: np.ndarray, least: int, impurity: np.ndarray | None) -> Splits:
    """The first split of most gain of each node; `sums` is (3, node, input, bin), `cuts` the number of cuts of each input.

    `impurity` is that of the nodes, as their parents' splits gave it; a root's is made from its first split.
    """
    left = sums.cumsum(axis=3)
    total, left = left[..., -1:], left[..., :-1]
    right = total - left
    some = int(np.argmax(cuts > 0))
    whole = left[:, :, some, 0] + right[:, :, some, 0] if cuts.any() else total[:, :, 0, 0]
    if impurity is None:
        impurity = variance(*whole)
    gain = (impurity[:, None, None] - left[0] / np.maximum(total[0], 1.0) * variance(*left)) - right[0] / np.maximum(total[0], 1.0) * variance(*right)
    allowed = (left[0] >= least) & (right[0] >= least) & (gain >= 0) & (np.arange(gain.shape[2]) < cuts[:, None])
    gain = np.where(allowed, gain, -np.inf).reshape(len(gain), -1)
    if not gain.shape[1]:
        none, sides = np.zeros(len(gain), int), np.zeros((2, len(gain)))
        return Splits(none > 0, none, none, sides, sides, sides, mean(*whole[:2]))
    best, nodes = gain.argmax(axis=1), np.arange(len(gain))
    feature, cut = np.divmod(best, left.shape[3])
    sides = [x[:, nodes, feature, cut] for x in (left, right)]
    counts, means, impurities = (np.stack(x) for x in zip(*((x[0], mean(*x[:2]), variance(*x)) for x in sides), strict=True))
    return Splits(gain[nodes, best] > 0, feature, cut, counts, means, impurities, mean(*whole[:2]))


# --- the ensemble ------------------------------------------------------------------------------------


@dataclass
class ClassTrees:
    """A fitted ensemble for each class that the training rows have, and for each between."""

    inputs: list[str]
    cuts: list[np.ndarray]
    classes: int
    rounds: list[Trees] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `probability`, an array: each class's margin by the logistic link, brought to sum 1. Inputs are doubles without nulls."""
        workers_find_package(df.sparkSession)
        cuts, rounds, classes = self.cuts, self.rounds, self.classes

        @F.arrow_udf("array<double>")
        def shares(*columns: pa.Array) -> pa.Array:
            values = [c.to_numpy(zero_copy_only=False) for c in columns]
            if any(np.isnan(x).any() for x in values):
                raise ValueError("inputs of boosted trees must be numbers")
            bins = into_bins(values, cuts)
            margins = np.zeros((classes, bins.shape[1]))
            for r in rounds:
                margins += r.margins(bins)
            with np.errstate(over="ignore"):
                single = 1.0 / (1.0 + np.exp(-2.0 * margins))
            ends = np.arange(bins.shape[1] + 1, dtype=np.int32) * classes
            return pa.ListArray.from_arrays(ends, np.ascontiguousarray((single / single.sum(axis=0)).T).ravel())

        return df.withColumn("probability", shares(*self.inputs))


def grow_round(blocks: RDD, spent: list[RDD], model: ClassTrees, depth: int, least: int, weight: float, number: int) -> Trees:
    """The trees of one round, a pass for each level. Of two children of a large node the smaller is counted, the other is what is left of it.

    The first pass makes `blocks`, then those they were made of, `spent`, are given up.
    """
    classes, n = model.classes, len(model.inputs)
    cuts = np.array([len(c) for c in model.cuts])
    bins, trees, impurity = int(cuts.max(initial=0)) + 1, Trees.empty(classes, depth, weight), None
    places, nodes, parents, siblings, sums = np.arange(classes).reshape(classes, 1), [(k, 0) for k in range(classes)], [], [], None
    for level in range(max(depth, 1)):
        step = partial(level_sums, inputs=n, growing=trees, places=places, level=level, number=number, bins_=bins)
        above, sums = sums, np.zeros((3, places.max() + 1, n, bins))
        tasks = min(blocks.getNumPartitions(), -(-sums.shape[1] // NODES_AT_ONCE))
        for start, some in blocks.mapPartitionsWithIndex(step).groupByKey(tasks).mapValues(added).collect():
            sums[:, start : start + some.shape[1]] = some
        while spent:
            spent.pop().unpersist()
        if parents:
            sums = np.concatenate([sums, above[:, parents] - sums[:, siblings]], axis=1)
        found = best_splits(sums, cuts, least, impurity)
        places, counted, others, parents, siblings, first = np.full((classes, 2 ** (level + 1)), -1), [], [], [], [], 2**level - 1
        for p in sorted(range(len(nodes)), key=nodes.__getitem__):
            k, j = nodes[p]
            node = first + j
            if level == 0:
                trees.value[k, node] = found.mean[p]
            if not found.splits[p] or level >= depth:
                continue
            trees.feature[k, node], trees.cut[k, node] = found.feature[p], found.cut[p]
            trees.value[k, 2 * node + 1 : 2 * node + 3] = found.means[:, p]
            below = [side for side in (0, 1) if level + 1 < depth and abs(found.impurities[side, p]) >= EPSILON]
            if len(below) == 2 and found.counts[:, p].sum() >= MANY_ROWS:
                below.remove(side := int(found.counts[:, p].argmax()))
                others.append((k, 2 * j + side, found.impurities[side, p]))
                parents.append(p)
                siblings.append(len(counted))
            for side in below:
                places[k, 2 * j + side] = len(counted)
                counted.append((k, 2 * j + side, found.impurities[side, p]))
        nodes, impurity = [x[:2] for x in (*counted, *others)], np.array([x[2] for x in (*counted, *others)])
        if not nodes:
            break
    for node in range(2**depth - 1):  # rows end on the lowest level
        leaf = trees.cut[:, node] == NO_CUT
        trees.value[leaf, 2 * node + 1] = trees.value[leaf, node]
    return trees


def fit_classes(rows: DataFrame, inputs: list[str], rounds: int, depth: int, eta: float, least: int, share: float, seed: int) -> ClassTrees:
    """Grow the ensembles of all classes; `rows` has the inputs as doubles and `label`. It is read four times and its partitions stay."""
    workers_find_package(rows.sparkSession)
    n, top = rows.agg(F.count("*"), F.max("label")).first()
    if not n:
        raise ValueError("no labelled rows to fit")
    model = ClassTrees(inputs, find_cuts(rows, inputs, n, seed), int(top) + 1)
    draws = draw_columns(seed, share, rounds)
    label = F.when(F.col("label") == F.floor("label"), F.col("label")).otherwise(F.lit(-1)).cast("int").alias("label")
    step = partial(binned, words=len(draws), cuts=model.cuts, classes=model.classes)
    blocks, spent = rows.select(label, *draws, *inputs).mapInArrow(step, BLOCK).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK), []
    try:
        for number in range(rounds):
            model.rounds.append(grow_round(blocks, spent, model, depth, least, eta if number else 1.0, number))
            if number + 1 < rounds:
                spent.append(blocks)
                add = partial(with_margins, inputs=len(inputs), grown=model.rounds[-1])
                blocks = blocks.mapPartitions(add).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for made in (blocks, *spent):
            made.unpersist()
    return model
