"""Run log: four append-only Parquet tables (runs, params, metrics, artifacts)."""

from __future__ import annotations

import datetime as dt
import numbers
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "runs": "run_id string, experiment string, name string, framework string, started timestamp_ntz",
    "params": "run_id string, key string, value string",
    "metrics": "run_id string, key string, value double",
    "artifacts": "run_id string, path string, content string",
}


def numeric_metrics(metrics: dict) -> dict[str, float]:
    """Real numbers only: booleans, text and nested values are not metrics."""
    return {
        k: float(v)
        for k, v in metrics.items()
        if isinstance(v, numbers.Real) and not isinstance(v, bool)
    }


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class Run:
    name: str
    framework: str
    params: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)
    artifacts: dict[str, str] = field(default_factory=dict)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    started: dt.datetime = field(default_factory=_now)


@dataclass(frozen=True)
class RunLog:
    spark: SparkSession
    root: str
    experiment: str = "attack-detection"

    def _append(self, table: str, rows: list[tuple]) -> None:
        if rows:
            frame = self.spark.createDataFrame(rows, SCHEMAS[table]).coalesce(1)
            frame.write.mode("append").parquet(f"{self.root}/{table}")

    def log(self, *runs: Run) -> list[str]:
        """Write runs, one file per table; the `runs` rows go last, so readers see complete runs only."""
        params, metrics, artifacts, heads = [], [], [], []
        for run in runs:
            described = {"framework": run.framework, **run.params}
            params += [(run.run_id, k, str(v)) for k, v in described.items()]
            metrics += [(run.run_id, k, v) for k, v in numeric_metrics(run.metrics).items()]
            artifacts += [(run.run_id, path, text) for path, text in run.artifacts.items()]
            heads.append((run.run_id, self.experiment, run.name, run.framework, run.started))
        for table, rows in (("params", params), ("metrics", metrics), ("artifacts", artifacts), ("runs", heads)):
            self._append(table, rows)
        return [run.run_id for run in runs]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")

    def run_metrics(self) -> DataFrame:
        """(name, framework, key, value) of all complete runs."""
        runs = self.table("runs").select("run_id", "name", "framework")
        return runs.join(self.table("metrics"), "run_id").select("name", "framework", "key", "value")

    def best_run(self, metric: str, lowest: bool = True) -> DataFrame:
        """The run with the best value of a metric; ties go to the first name."""
        order = F.col("value").asc() if lowest else F.col("value").desc()
        ranked = self.run_metrics().where(F.col("key") == metric)
        return ranked.orderBy(order, "name").limit(1)


def metric_dict(metrics: Iterable[Row]) -> dict[str, float]:
    """Collected rows of a tidy metric table (metric, value): a few per split and class."""
    return {r["metric"]: r["value"] for r in metrics}


def report_text(report: Iterable[Row]) -> str:
    """Collected rows of a classification report (one per class plus three) as aligned text."""
    lines = [f"{'':>14}{'precision':>11}{'recall':>9}{'f1':>9}{'support':>10}"]
    for r in report:
        scores = ["" if r[s] is None else f"{r[s]:.4f}" for s in ("precision", "recall", "f1")]
        lines.append(f"{r['row']:>14}{scores[0]:>11}{scores[1]:>9}{scores[2]:>9}{r['support']:>10}")
    return "\n".join(lines)
