"""Softmax gradient boosting with second-order trees, grown from histograms.

Each round adds one tree per class, fitted jointly to the gradients of the softmax loss. Inputs are cut once into bins at their quantiles;
a stored block holds some rows, column by column: their bins, labels and weights, and the margins of the rounds it was last
written with, usually all but the one that grows, so that a pass walks few trees. Rows are dealt evenly to the tasks first. A tree grows level by level:
tasks add gradients and curvatures up by (class, node, input, bin), the sums are grouped by Spark, and the driver, who sees only
those sums, picks splits. Their number depends on classes, nodes, inputs and bins, never on rows. One pass makes a level of all classes'
trees; the first pass of a round also gives loss and error after the round before.

Rows whose weight or label is null or whose label is no class are left out; missing inputs are 0. Draws of `subsample` depend on row, round and seed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, workers_find_package

# Default parameters of the boosted softmax model.
SOFTMAX_PARAMS = {
    "num_boost_round": 10,
    "eta": 0.3,
    "max_depth": 6,
    "min_child_weight": 1,
    "subsample": 1.0,
    "lambda": 1.0,
    "alpha": 0.0,
}
BINS = 64
#: Rounds after which rows are written again with their margins, so that a pass applies only the trees since.
REFRESH = 1
#: Rows of a part of the stored blocks: with fewer of them not all cores get one, and with more a core gets several parts.
PART_ROWS, MOST_PART_ROWS = 1 << 15, 1 << 18
#: Accuracy of the quantiles: rank error is rows / this.
QUANTILE_ACCURACY = 10_000
LEAST_CURVATURE = 1e-16
_LOSS, _ERROR = -1, -2


@dataclass
class Round:
    """The trees of a round, one row per class; the children of node i are 2i + 1 and 2i + 2. A feature of -1 is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, classes: int, depth: int) -> "Round":
        shape = (classes, 2 ** (depth + 1) - 1)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape))

    def nodes(self, k: int, bins: np.ndarray) -> np.ndarray:
        """Where the rows stand in the tree of class k, as far as it has grown; `bins` is (input, row)."""
        node, rows = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        while True:
            split = self.feature[k][node]
            inner = split >= 0
            if not inner.any():
                return node
            right = bins[np.maximum(split, 0), rows] > self.cut[k][node]
            node = np.where(inner, 2 * node + 1 + right, node)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.stack([self.value[k][self.nodes(k, bins)] for k in range(len(self.value))])


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def into_bins(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x, "left").astype(np.uint8) for x, e in zip(columns, edges, strict=True)])


def loss_and_error(p: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return -np.log(np.maximum(p[label, np.arange(p.shape[1])], 1e-15)), p.argmax(axis=0) != label


# --- training ----------------------------------------------------------------------------------------


def find_edges(df: DataFrame, inputs: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper bounds of all bins but the last, from one pass of quantiles: `bins` numbers for each input."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(c, shares, QUANTILE_ACCURACY).alias(c) for c in inputs]).first()
    return [np.unique(np.array(row[c] if row[c] is not None else [], float)) for c in inputs]


@contextmanager
def _rewritten(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that writes a table and reads it again; the tables written before it, and in the end all, are deleted."""
    paths: list[str] = []

    def drop(path: str) -> None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)

    def write(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "boosting")
        paths.append(path)
        df.write.parquet(path)
        while len(paths) > 1:
            drop(paths.pop(0))
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield write
    finally:
        for path in paths:
            drop(path)


BLOCK = "label binary, weight binary, draw binary, bins binary, margins binary"


def parts_of(rows: int, cores: int) -> int:
    """Number of parts that many rows are dealt to: up to `cores`, then a multiple of it."""
    return max(1, min(cores, -(-rows // PART_ROWS)), cores * -(-rows // (cores * MOST_PART_ROWS)) if rows > cores * MOST_PART_ROWS else 1)


def block(*arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays], ["label", "weight", "draw", "bins", "margins"])


def binned(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray], classes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            label, weight, draw, *columns = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            yield block(label.astype(np.int32), weight, draw, into_bins(columns, edges), np.zeros((classes, len(label))))


def unpacked(batches: Iterator[pa.RecordBatch], inputs: int, rounds: list[Round], classes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Label, weight, draw, bins (input, row) and margins (class, row) of each block, the margins after `rounds` too."""
    for batch in batches:
        for one in zip(*batch.columns, strict=True):
            parts = [np.frombuffer(x.as_buffer(), k) for x, k in zip(one, (np.int32, np.float64, np.int64, np.uint8, np.float64), strict=True)]
            bins, margins = parts[3].reshape(inputs, -1), parts[4].reshape(classes, -1)
            for r in rounds:
                margins = margins + r.margins(bins)
            yield *parts[:3], bins, margins


def drawn(draw: np.ndarray, number: int, seed: int, share: float) -> np.ndarray:
    """A repeatable share of the rows, another one each round."""
    if share >= 1.0:
        return np.ones(len(draw), bool)
    x = draw.view(np.uint64) ^ np.uint64((seed * 1_000_003 + number * 7919 + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(11)).astype(float) / 2**53 < share


def level_sums(
    batches: Iterator[pa.RecordBatch], inputs: int, rounds: list[Round], growing: Round, depth: int, number: int, seed: int, share: float, bins_: int
) -> Iterator[pa.RecordBatch]:
    """(slot, g, h): a task's gradients and curvatures by (class, node of this level, input, bin)."""
    classes, first, n_nodes = len(growing.feature), 2**depth - 1, 2**depth
    sums = np.zeros((2, classes, n_nodes, inputs, bins_))
    facts = np.zeros(3)
    for label, weight, draw, bins, margins in unpacked(batches, inputs, rounds, classes):
        p = softmax(margins.T).T
        if depth == 0:
            loss, wrong = loss_and_error(p, label)
            facts += [(weight * loss).sum(), (weight * wrong).sum(), weight.sum()]
        used = drawn(draw, number, seed, share)
        for k in range(classes):
            node = growing.nodes(k, bins)
            here = used & (node >= first)
            whole = here.all()
            at = (node if whole else node[here]) - first
            g = weight * (p[k] - (label == k))
            h = weight * np.maximum(2.0 * p[k] * (1.0 - p[k]), LEAST_CURVATURE)
            g, h = (g, h) if whole else (g[here], h[here])
            at *= bins_
            for i in range(inputs):
                slot = at + (bins[i] if whole else bins[i][here])
                for x, total in ((g, sums[0]), (h, sums[1])):
                    total[k, :, i] += np.bincount(slot, weights=x, minlength=n_nodes * bins_).reshape(n_nodes, bins_)
    at = np.flatnonzero(sums[1].ravel())
    g, h = sums[0].ravel()[at], sums[1].ravel()[at]
    if depth == 0:
        at, g, h = np.append(at, [_LOSS, _ERROR]), np.append(g, facts[:2]), np.append(h, facts[[2, 2]])
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(g), pa.array(h)], ["slot", "g", "h"])


def with_margins(batches: Iterator[pa.RecordBatch], inputs: int, rounds: list[Round], classes: int) -> Iterator[pa.RecordBatch]:
    for parts in unpacked(batches, inputs, rounds, classes):
        yield block(*parts)


def shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


def grow(growing: Round, depth: int, g: np.ndarray, h: np.ndarray, params: dict) -> bool:
    """Split this level's nodes, or leave them as leaves; g and h are (class, node, input, bin). Whether any was split."""
    l1, l2, least, eta = (float(params[k]) for k in ("alpha", "lambda", "min_child_weight", "eta"))

    def worth(g, h):
        return shrunk(g, l1) ** 2 / (h + l2 + 1e-12)

    def leaf(g, h):
        return -eta * shrunk(g, l1) / (h + l2 + 1e-12)

    left_g, left_h = g.cumsum(axis=3)[..., :-1], h.cumsum(axis=3)[..., :-1]
    all_g, all_h = g.sum(axis=3, keepdims=True), h.sum(axis=3, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = worth(left_g, left_h) + worth(right_g, right_h) - worth(all_g, all_h)
    gain = np.where((left_h >= least) & (right_h >= least), gain, -np.inf)
    classes, nodes, _, cuts = gain.shape
    best = gain.reshape(classes, nodes, -1).argmax(axis=2)
    any_split, first = False, 2**depth - 1
    for k in range(classes):
        for j in range(nodes):
            if all_h[k, j, 0, 0] <= 0:
                continue
            f, b = divmod(int(best[k, j]), cuts)
            node = first + j
            if gain[k, j, f, b] > 1e-9:
                growing.feature[k, node], growing.cut[k, node] = f, b
                growing.value[k, 2 * node + 1] = leaf(left_g[k, j, f, b], left_h[k, j, f, b])
                growing.value[k, 2 * node + 2] = leaf(right_g[k, j, f, b], right_h[k, j, f, b])
                any_split = True
            elif depth == 0:
                growing.value[k, node] = leaf(all_g[k, j, 0, 0], all_h[k, j, 0, 0])
    return any_split


@dataclass
class SoftmaxTrees:
    """A fitted ensemble. `history`: (log loss, error) on the training rows before the first round and after each but the last."""

    inputs: list[str]
    edges: list[np.ndarray]
    rounds: list[Round]
    classes: int
    history: list[tuple[float, float]] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `probability`, an array. Inputs are doubles without nulls."""
        workers_find_package(df.sparkSession)
        edges, rounds, classes = self.edges, self.rounds, self.classes

        @F.pandas_udf("array<double>")
        def shares(*columns: pd.Series) -> pd.Series:
            bins = into_bins([c.to_numpy(float) for c in columns], edges)
            margins = np.zeros((classes, bins.shape[1]))
            for r in rounds:
                margins += r.margins(bins)
            return pd.Series(list(softmax(margins.T)))

        return df.withColumn("probability", shares(*self.inputs))

    def save(self, spark: SparkSession, path: str) -> None:
        rounds = [{"feature": r.feature.tolist(), "cut": r.cut.tolist(), "value": r.value.tolist()} for r in self.rounds]
        about = {"inputs": self.inputs, "edges": [e.tolist() for e in self.edges], "rounds": rounds, "classes": self.classes, "history": self.history}
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SoftmaxTrees":
        about = json.loads(spark.read.text(path, wholetext=True).first()[0])
        rounds = [Round(np.array(r["feature"], np.int16), np.array(r["cut"], np.int16), np.array(r["value"])) for r in about["rounds"]]
        return cls(about["inputs"], [np.array(e) for e in about["edges"]], rounds, about["classes"], [tuple(h) for h in about["history"]])


def fit_softmax(
    df: DataFrame, inputs: list[str], params: dict | None = None, classes: int = 6, label: str = "label", weight: str | None = None, seed: int = 42
) -> SoftmaxTrees:
    """Grow the ensemble on rows with double inputs. Parameters other than those of SOFTMAX_PARAMS are ignored."""
    spark = df.sparkSession
    workers_find_package(spark)
    params = {**SOFTMAX_PARAMS, **(params or {})}
    depth, share, n = int(params["max_depth"]), float(params["subsample"]), len(inputs)
    rows = df.select(
        F.col(label).cast("int").alias("label"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight"),
        F.xxhash64(*inputs, F.monotonically_increasing_id()).alias("draw"), *[F.col(c).cast("double").alias(c) for c in inputs],
    ).where(F.col("label").between(0, classes - 1) & F.col("weight").isNotNull())
    parts = parts_of(rows.count(), spark.sparkContext.defaultParallelism)
    with _rewritten(spark) as write:
        spread = write(rows.repartition(parts))
        edges = find_edges(spread, inputs)
        bins = max((len(e) for e in edges), default=0) + 1
        model, since = SoftmaxTrees(inputs, edges, [], classes), []
        examples = write(spread.mapInArrow(partial(binned, edges=edges, classes=classes), BLOCK))
        for number in range(int(params["num_boost_round"])):
            growing = Round.empty(classes, depth)
            for level in range(depth):
                step = partial(level_sums, inputs=n, rounds=since, growing=growing, depth=level, number=number, seed=seed, share=share, bins_=bins)
                sums = examples.mapInArrow(step, "slot long, g double, h double").groupBy("slot").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
                slot, g, h = (sums.column(i).to_numpy() for i in range(3))
                whole = np.zeros((2, classes * 2**level * n * bins))
                whole[0][slot[slot >= 0]], whole[1][slot[slot >= 0]] = g[slot >= 0], h[slot >= 0]
                if level == 0 and len(slot):
                    facts = {int(s): (float(a), float(b)) for s, a, b in zip(slot[slot < 0], g[slot < 0], h[slot < 0], strict=True)}
                    total = max(facts.get(_LOSS, (0.0, 0.0))[1], 1e-12)
                    model.history.append((facts.get(_LOSS, (0.0,))[0] / total, facts.get(_ERROR, (0.0,))[0] / total))
                shape = (classes, 2**level, n, bins)
                if not grow(growing, level, whole[0].reshape(shape), whole[1].reshape(shape), params):
                    break
            model.rounds.append(growing)
            since = [*since, growing]
            if len(since) == REFRESH and number + 1 < int(params["num_boost_round"]):
                examples, since = write(examples.mapInArrow(partial(with_margins, inputs=n, rounds=since, classes=classes), BLOCK)), []
    return model


# --- progress ----------------------------------------------------------------------------------------


def staged(batches: Iterator[pa.RecordBatch], model: SoftmaxTrees) -> Iterator[pa.RecordBatch]:
    """(split, boost_round, n, loss, error): a task's sums after each round, by margins that grow from round to round."""
    totals: dict[tuple[str, int], np.ndarray] = {}
    for batch in batches:
        names = batch.column(0).dictionary_encode()
        number_of = names.indices.to_numpy()
        members = {name: np.flatnonzero(number_of == i) for i, name in enumerate(names.dictionary.to_pylist())}
        label = batch.column(1).to_numpy()
        bins = into_bins([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, batch.num_columns)], model.edges)
        margins = np.zeros((model.classes, bins.shape[1]))
        for number, r in enumerate(model.rounds, start=1):
            margins = margins + r.margins(bins)
            loss, wrong = loss_and_error(softmax(margins.T).T, label)
            for name, here in members.items():
                part = np.array([len(here), loss[here].sum(), wrong[here].sum()], float)
                totals[name, number] = totals.get((name, number), 0) + part
    keys, sums = list(totals), list(totals.values())
    columns = [
        pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
        pa.array([int(s[0]) for s in sums], pa.int64()), pa.array([s[1] for s in sums], pa.float64()), pa.array([s[2] for s in sums], pa.float64()),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["split", "boost_round", "n", "loss", "error"])


def round_metrics(model: SoftmaxTrees, rows: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """(split, boost_round, n, log_loss, error) after every round, of all splits in one pass and one aggregate."""
    workers_find_package(rows.sparkSession)
    ready = rows.select(F.col(split).alias("split"), F.col(label).cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in model.inputs])
    ready = ready.where(F.col("label").between(0, model.classes - 1))
    sums = ready.mapInArrow(partial(staged, model=model), "split string, boost_round int, n long, loss double, error double")
    n = F.sum("n")
    return sums.groupBy("split", "boost_round").agg(n.alias("n"), (F.sum("loss") / n).alias("log_loss"), (F.sum("error") / n).alias("error"))
