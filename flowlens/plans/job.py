"""The batch job: raw splits in, processed splits and the fitted artifact out; and the training job."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..schemas import NUM_CLASSES, TARGET
from ..session import DEFAULT_READ_MB, build_session
from ..sources.parquet import DEFAULT_RECORDS_PER_FILE, read_processed, read_split, write_split
from .preprocess import FittedFeatures, feature_set, load_fitted
from .tracking import Run, RunLog, metric_dict, report_text
from .training import TrainingResult, framework_name, train
from .tuning import SEARCHES, Trial, best, final_params, last_rung


def load_params(path: str) -> dict:
    """Job parameters from a YAML or JSON file."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


# Feature sets of the module names in existing parameter files.
MODULES = {"preprocessing_001": "deployed"}


def section(params: dict, *wanted: str) -> dict:
    """The part of a nested parameter file, the outermost first, that has one of the keys; else all of it."""
    level = [params]
    while level:
        for part in level:
            if any(key in part for key in wanted):
                return part
        level = [v for part in level for v in part.values() if isinstance(v, dict)]
    return params


def feature_name(params: dict) -> str:
    """The feature set by its name, or by that of a pipeline module."""
    module = str((params.get("pipeline") or {}).get("module", "")).rpartition(".")[2]
    return params.get("features") or MODULES.get(module, module) or "deployed"


@dataclass
class PreprocessJob:
    """Fit on train once, apply everywhere; val and test load the artifact if this process did not fit."""

    spark: SparkSession
    raw: str
    processed: str
    artifact: str
    features: str = "deployed"
    records_per_file: int = DEFAULT_RECORDS_PER_FILE
    fitted: FittedFeatures | None = None

    @classmethod
    def from_params(cls, params: dict, raw: str, processed: str, artifact: str) -> "PreprocessJob":
        params = section(params, "read_batch_size", "write_batch_size", "pipeline", "features")
        spark = build_session(
            params.get("app_name", "flowlens"), read_partition_mb=params.get("read_batch_size", DEFAULT_READ_MB)
        )
        return cls(
            spark,
            raw,
            processed,
            artifact,
            feature_name(params),
            params.get("write_batch_size", DEFAULT_RECORDS_PER_FILE),
        )

    def run_split(self, split: str) -> str:
        df = read_split(self.spark, self.raw, split)
        if split == "train":
            self.fitted, out = feature_set(self.features).fit_transform(df)
            self.fitted.save(self.spark, self.artifact)
        else:
            if self.fitted is None:
                self.fitted = load_fitted(self.spark, self.artifact, self.features)
            out = self.fitted.transform(df)
        return write_split(out, self.processed, split, self.records_per_file)

    def run(self) -> dict[str, str]:
        return {split: self.run_split(split) for split in ("train", "val", "test")}


@dataclass
class TrainingJob:
    """Optional search, full retrain with the best draw, evaluation, model and run log."""

    spark: SparkSession
    processed: str
    output: str
    framework: str = "gbt"
    tune: bool = False
    sample_fraction: float | None = None
    trials: int | None = None
    partitions: int | None = None
    seed: int = 42
    target: str = TARGET
    classes: int = NUM_CLASSES
    search: str = "random"
    max_train_rows: int = 0
    max_val_rows: int = 0

    @classmethod
    def from_params(cls, spark: SparkSession, params: dict, processed: str, output: str) -> "TrainingJob":
        """From the part of a parameter file that describes the model, wherever it lies."""
        params = section(params, "framework", "target", "num_classes")
        return cls(
            spark,
            processed,
            output,
            framework_name(params.get("framework", "gbt")),
            params.get("tune", False),
            params.get("sample_fraction_for_tuning"),
            params.get("trials"),
            params.get("partitions"),
            params.get("seed", 42),
            params.get("target", TARGET),
            params.get("num_classes", NUM_CLASSES),
            params.get("search", "random"),
            params.get("max_train_rows", 0),
            params.get("max_val_rows", 0),
        )

    def run(self) -> TrainingResult:
        parts = {s: read_processed(self.spark, self.processed, s) for s in ("train", "val", "test")}
        params, runs = None, []
        if self.tune:
            trials = SEARCHES[self.search](
                parts["train"],
                parts["val"],
                self.framework,
                self.trials,
                self.sample_fraction,
                seed=self.seed,
                partitions=self.partitions,
                max_train_rows=self.max_train_rows,
                max_val_rows=self.max_val_rows,
                target=self.target,
                classes=self.classes,
            )
            params = final_params(self.framework, best(last_rung(trials)))
            runs = [self.trial_run(t) for t in trials]
        result = train(
            parts["train"],
            parts["val"],
            parts["test"],
            self.framework,
            params,
            self.target,
            self.classes,
            self.seed,
            self.partitions,
        )
        result.model.save(self.spark, f"{self.output}/model_{self.framework}")
        metrics = {**metric_dict(result.metrics.collect()), **result.seconds}
        final = {**result.model.params, **self.about()}
        runs.append(Run(f"{self.framework}_final", self.framework, final, metrics, self.artifacts(result)))
        RunLog(self.spark, f"{self.output}/runs").log(*runs)
        return result

    def about(self) -> dict:
        return {"target": self.target, "num_classes": self.classes, "seed": self.seed}

    def trial_run(self, trial: Trial) -> Run:
        params = {**trial.params, **self.about(), "rounds": trial.rounds}
        name = f"{self.framework}_trial_{trial.number}_rounds_{trial.rounds}"
        return Run(name, self.framework, params, {"trial_val_log_loss": trial.loss})

    def artifacts(self, result: TrainingResult) -> dict[str, str]:
        """Per split: the classification report as text and the confusion matrix as JSON."""
        report = result.evaluation.report.collect()
        cells = result.evaluation.confusion.orderBy("split", "label", "prediction").collect()
        classes = result.model.classes
        files = {}
        for split in ("val", "test"):
            files[f"evaluation/{split}_classification_report.txt"] = report_text(r for r in report if r["split"] == split)
            counts = [r["n"] for r in cells if r["split"] == split]
            rows = [counts[i : i + classes] for i in range(0, len(counts), classes)]
            files[f"evaluation/{split}_confusion_matrix.json"] = json.dumps(rows)
        return files
