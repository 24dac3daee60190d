"""Multiclass training: boosted softmax trees, and on Spark ML one-vs-rest boosted trees, a random forest, or a multilayer perceptron."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import first_argmax
from ..operators.evaluate import (
    class_metric_rows,
    class_metrics,
    classification_report,
    dense_matrix,
    pair_counts,
    row_loss,
    summary_metrics,
)
from ..operators.validate import require_contract
from ..schemas import CLASS_NAMES, MODEL_INPUTS, NUM_CLASSES, TARGET
from ..session import ensure_checkpoint_dir
from .boosting import SOFTMAX_PARAMS, SoftmaxTrees, fit_softmax, round_metrics
from .class_trees import ClassTrees, fit_classes

# Default parameters of the boosted-tree model.
GBT_PARAMS = {
    "num_boost_round": 10,
    "eta": 0.3,
    "max_depth": 6,
    "min_child_weight": 1,
    "subsample": 1.0,
}

# Default parameters of the neural model. The solver picks its own steps, so there is no learning rate to set.
MLP_PARAMS = {
    "max_epochs": 10,
    "batch_size": 256,
}
MLP_HIDDEN = (64, 64)
# L-BFGS steps that stand in for one epoch of minibatch updates.
STEPS_PER_EPOCH = 10

FOREST_PARAMS = {"num_trees": 20, "max_depth": 6}

# Class ensembles fitted side by side: each keeps its own copy of the tree points. A parameter `parallelism` overrides it.
CLASSES_AT_ONCE = 2


@contextmanager
def materialised(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames for repeated passes; partitions lost with an executor are recomputed."""
    kept = tuple(f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames)
    try:
        yield kept
    finally:
        for frame in kept:
            frame.unpersist()


def estimator(framework: str, params: dict, inputs: int, classes: int, seed: int):
    """The Spark ML estimator of a framework name."""
    if framework == "gbt":
        tree = GBTClassifier(
            maxIter=int(params["num_boost_round"]),
            maxDepth=int(params["max_depth"]),
            stepSize=float(params["eta"]),
            minInstancesPerNode=int(params["min_child_weight"]),
            subsamplingRate=float(params["subsample"]),
            seed=seed,
        )
        at_once = int(params.get("parallelism", CLASSES_AT_ONCE))
        return OneVsRest(classifier=tree, featuresCol="features", labelCol="label", parallelism=at_once)
    if framework == "mlp":
        width = params.get("width")
        hidden = [int(width)] * len(MLP_HIDDEN) if width else [int(h) for h in params.get("hidden", MLP_HIDDEN)]
        return MultilayerPerceptronClassifier(
            layers=[inputs, *hidden, classes],
            maxIter=int(params["max_epochs"]) * STEPS_PER_EPOCH,
            blockSize=int(params["batch_size"]),
            tol=float(params.get("tol", 1e-6)),
            seed=seed,
        )
    if framework == "forest":
        return RandomForestClassifier(
            numTrees=int(params["num_trees"]), maxDepth=int(params["max_depth"]), seed=seed
        )
    raise ValueError(f"unknown framework {framework!r}; known: softmax, gbt, mlp, forest")


def fit_together(rows: DataFrame, inputs: list[str], params: dict, seed: int) -> ClassTrees:
    """The trees of `estimator("gbt", ...)`, those of all classes grown side by side."""
    return fit_classes(
        rows,
        inputs,
        rounds=int(params["num_boost_round"]),
        depth=int(params["max_depth"]),
        eta=float(params["eta"]),
        least=int(params["min_child_weight"]),
        share=float(params["subsample"]),
        seed=seed,
    )


DEFAULTS = {"softmax": SOFTMAX_PARAMS, "gbt": GBT_PARAMS, "mlp": MLP_PARAMS, "forest": FOREST_PARAMS}
# Framework names of existing parameter files.
FRAMEWORKS = {"xgboost": "softmax", "pytorch": "mlp"}


def framework_name(name: str) -> str:
    return FRAMEWORKS.get(name, name)


def class_probabilities(kind: str, classes: int) -> Column:
    """Array of class probabilities, padded with 0 for classes the training data lacked.

    One-vs-rest gives a margin per class: each becomes a probability by the logistic link of the boosted
    trees, and the probabilities of a row are brought to sum 1.
    """
    if kind == "gbt":
        single = F.transform(
            vector_to_array(F.col("rawPrediction")), lambda m: 1.0 / (1.0 + F.exp(-2.0 * m))
        )
        total = F.aggregate(single, F.lit(0.0), lambda a, v: a + v)
        shares = F.transform(single, lambda v: v / total)
    elif kind == "softmax":
        shares = F.col("probability")
    else:
        shares = vector_to_array(F.col("probability"))
    padded = F.concat(shares, F.array_repeat(F.lit(0.0), classes))
    return F.slice(padded, 1, classes)


def usable(inputs: list[str]) -> list[Column]:
    """Model inputs as doubles, missing values as 0 (what serving does)."""
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in inputs]


def spread(df: DataFrame, partitions: int | None) -> DataFrame:
    """Rows dealt evenly to so many tasks, however few splits they are read from; no number leaves them."""
    return df.repartition(partitions) if partitions else df


@dataclass
class FlowModel:
    """A trained classifier with the input order and class count it was trained on."""

    stages: PipelineModel | SoftmaxTrees | ClassTrees
    framework: str
    inputs: list[str] = field(default_factory=lambda: list(MODEL_INPUTS))
    classes: int = NUM_CLASSES
    params: dict = field(default_factory=dict)

    def score(self, df: DataFrame) -> DataFrame:
        """Add `prediction` (first most likely class) and `probabilities`; unusable inputs count as 0."""
        whole = F.struct(*df.columns).alias("_row")
        raw = self.stages.transform(df.select(whole, *usable(self.inputs)))
        kind = "softmax" if isinstance(self.stages, ClassTrees) else self.framework  # its probabilities are ready, too
        scored = raw.withColumn("probabilities", class_probabilities(kind, self.classes))
        scored = scored.withColumn("prediction", first_argmax(F.col("probabilities")))
        return scored.select("_row.*", "prediction", "probabilities")

    def save(self, spark: SparkSession, path: str) -> None:
        if isinstance(self.stages, SoftmaxTrees):
            self.stages.save(spark, f"{path}/model")
        else:
            self.stages.write().overwrite().save(f"{path}/model")
        about = {
            "framework": self.framework,
            "inputs": self.inputs,
            "classes": self.classes,
            "class_names": CLASS_NAMES[: self.classes],
            "params": self.params,
        }
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FlowModel":
        about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
        softmax = about["framework"] == "softmax"
        stages = SoftmaxTrees.load(spark, f"{path}/model") if softmax else PipelineModel.load(f"{path}/model")
        return cls(stages, about["framework"], about["inputs"], about["classes"], about["params"])


def binary_scores(scored: DataFrame, probability: str) -> DataFrame:
    """Prediction of a model that gives one number: above one half is class 1."""
    return scored.withColumn("prediction", (F.col(probability) > 0.5).cast("long"))


def fit_model(
    train: DataFrame,
    framework: str = "gbt",
    params: dict | None = None,
    target: str = TARGET,
    classes: int = NUM_CLASSES,
    seed: int = 42,
    partitions: int | None = None,
    together: bool = False,
) -> FlowModel:
    """Fit one model. `partitions` spreads the rows first: every pass of the fit then uses all cores.

    The vectors are kept in memory and on disk for the length of the fit, which passes over them many times. `together`: the
    boosted trees of all classes grow in the same passes, over blocks instead of vectors; such a model scores, but is not stored.
    """
    require_contract(train, target)
    ensure_checkpoint_dir(train.sparkSession)
    framework = framework_name(framework)
    params = {**DEFAULTS.get(framework, {}), **(params or {})}
    inputs = list(MODEL_INPUTS)
    filled = train.where(F.col(target).isNotNull()).select(
        *usable(inputs),
        F.col(target).cast("double").alias("label"),
    )
    if framework == "softmax":
        return FlowModel(fit_softmax(spread(filled, partitions), inputs, params, classes, seed=seed), framework, inputs, classes, params)
    if framework == "gbt" and together:
        return FlowModel(fit_together(spread(filled, partitions), inputs, params, seed), framework, inputs, classes, params)
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    vectors = assembler.transform(filled).select("features", "label")
    with materialised(spread(vectors, partitions)) as (kept,):
        model = estimator(framework, params, len(inputs), classes, seed).fit(kept)
    return FlowModel(PipelineModel([assembler, model]), framework, inputs, classes, params)


def split_metrics(per_class: DataFrame) -> DataFrame:
    """(split, metric, value) with split-prefixed names from per-class metrics by split."""
    rows = summary_metrics(per_class, ["split"]).unionByName(class_metric_rows(per_class, ["split"]))
    return rows.withColumn("metric", F.concat_ws("_", "split", "metric"))


@dataclass
class Evaluation:
    """Tables by split: tidy metrics, dense confusion matrix, classification report."""

    metrics: DataFrame
    confusion: DataFrame
    report: DataFrame


def evaluate(scored: DataFrame, target: str = TARGET, classes: int = NUM_CLASSES) -> Evaluation:
    """One pass over all scored rows: counts and summed loss per (split, label, prediction).

    Rows whose label is no class are left out first. So the table has at most splits x (classes + 1) x classes
    rows; it is kept as a local frame, and no metric scores the rows again.
    """
    loss = F.sum(row_loss(target, "probabilities")).alias("loss")
    known = F.col(target).isNull() | F.col(target).cast("long").between(0, classes - 1)
    counts = pair_counts(scored.where(known), target, "prediction", ["split"], [loss])
    counts = scored.sparkSession.createDataFrame(counts.collect(), counts.schema)
    confusion = dense_matrix(counts, classes, ["split"])
    per_class = class_metrics(confusion, ["split"])
    labelled = counts.where("label IS NOT NULL").groupBy("split")
    losses = labelled.agg((F.sum("loss") / F.sum("n")).alias("value")).select(
        "split", F.concat_ws("_", "split", F.lit("log_loss")).alias("metric"), "value"
    )
    return Evaluation(
        split_metrics(per_class).unionByName(losses),
        confusion,
        classification_report(per_class, by=["split"]),
    )


@dataclass
class TrainingResult:
    model: FlowModel
    evaluation: Evaluation
    seconds: dict[str, float]

    @property
    def metrics(self) -> DataFrame:
        return self.evaluation.metrics


def label_splits(parts: dict[str, DataFrame]) -> DataFrame:
    frames = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def train(
    train_df: DataFrame,
    val_df: DataFrame,
    test_df: DataFrame,
    framework: str = "gbt",
    params: dict | None = None,
    target: str = TARGET,
    classes: int = NUM_CLASSES,
    seed: int = 42,
    partitions: int | None = None,
) -> TrainingResult:
    """Fit on train, evaluate on val and test: (split, metric, value) incl. log loss. `partitions` spreads the rows of either step."""
    for part in (val_df, test_df):
        require_contract(part, target)
    started = time.perf_counter()
    model = fit_model(train_df, framework, params, target, classes, seed, partitions)
    fitted = time.perf_counter() - started
    started = time.perf_counter()
    scored = model.score(spread(label_splits({"val": val_df, "test": test_df}), partitions))
    evaluation = evaluate(scored, target, classes)
    evaluated = time.perf_counter() - started
    return TrainingResult(model, evaluation, {"fit_seconds": fitted, "evaluate_seconds": evaluated})


def boosting_progress(model: FlowModel, df: DataFrame, target: str = TARGET) -> DataFrame:
    """(class, boost_round, loss): logistic loss of each class ensemble after every round."""
    if model.framework != "gbt":
        raise ValueError("rounds are reported for boosted trees only")
    assembler, forest = model.stages.stages
    assert isinstance(forest, OneVsRestModel)
    labelled = df.select(*usable(model.inputs), F.col(target).cast("double").alias("target"))
    vectors = assembler.transform(labelled).select("features", "target")
    rows = []
    with materialised(vectors) as (kept,):
        for place, binary in enumerate(forest.models):
            is_class = (F.col("target") == place).cast("double").alias(binary.getLabelCol())
            one = kept.select("features", is_class)
            for step, loss in enumerate(binary.evaluateEachIteration(one), start=1):
                rows.append((place, step, float(loss)))
    return df.sparkSession.createDataFrame(rows, "class int, boost_round int, loss double")


def softmax_progress(model: FlowModel, parts: dict[str, DataFrame], target: str = TARGET) -> DataFrame:
    """(split, boost_round, n, log_loss, error) of a boosted softmax model after every round, on all parts in one pass."""
    if not isinstance(model.stages, SoftmaxTrees):
        raise ValueError("rounds of all classes together are reported for the softmax model only")
    rows = label_splits({k: df.select(*usable(model.inputs), F.col(target).alias("label")) for k, df in parts.items()})
    return round_metrics(model.stages, rows)
