"""Which batches of a stream's output count: a record for each, written when its data are complete.

A batch's folder is filled first and its record written last, so readers, who go by the records, never see part of a batch. A
compaction writes the rows of all live batches to few files and then one record that names the new folder and the batches it
stands for; with that record it takes their place. What a record no longer points to may be removed at any later time.

Records are small JSON texts below `_commits`; there is one for each live batch and one for each compaction.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "run string, batch_id long, rows long, millis double, folder string, covers array<struct<run:string,last:long>>"
ROWS_PER_FILE = 1_000_000


def _write_record(spark: SparkSession, path: str, name: str, record: dict) -> None:
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/_commits/{name}")


def records(spark: SparkSession, path: str) -> list[dict]:
    """All records: as many as live batches and compactions, never as many as rows."""
    try:
        found = spark.read.schema(RECORD).json(f"{path}/_commits/*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [r.asDict(recursive=True) for r in found.collect()]


def commit_batch(spark: SparkSession, path: str, run: str, batch_id: int, rows: int, millis: float) -> None:
    _write_record(spark, path, f"{run}-{batch_id}", {"run": run, "batch_id": batch_id, "rows": rows, "millis": millis})


def is_committed(known: list[dict], run: str, batch_id: int) -> bool:
    """A run commits its batches in order, so a compaction covers all up to its last."""
    return any((r["run"], r["batch_id"]) == (run, batch_id) for r in known) or batch_id <= covered(known).get(run, -1)


def covered(known: list[dict]) -> dict[str, int]:
    last: dict[str, int] = {}
    for r in known:
        for c in r["covers"] or ():
            last[c["run"]] = max(c["last"], last.get(c["run"], -1))
    return last


def live_batches(known: list[dict]) -> list[dict]:
    """Committed batches that no compaction stands for."""
    last = covered(known)
    return sorted((r for r in known if r["folder"] is None and r["batch_id"] > last.get(r["run"], -1)), key=lambda r: (r["run"], r["batch_id"]))


def batch_folder(path: str, run: str, batch_id: int) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def _read_live(spark: SparkSession, path: str, schema: str, known: list[dict]) -> DataFrame | None:
    folders = [batch_folder(path, r["run"], r["batch_id"]) for r in live_batches(known)]
    if not folders:
        return None
    reader = spark.read.schema(f"{schema}, run string, batch_id long").option("basePath", path)
    return reader.parquet(*folders)


def read_committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(schema, run, batch_id): the rows of all committed batches, compacted or not; none before the first."""
    whole = f"{schema}, run string, batch_id long"
    known = records(spark, path)
    packed = [r["folder"] for r in known if r["folder"]]
    parts = [_read_live(spark, path, schema, known), spark.read.schema(whole).parquet(*packed) if packed else None]
    found = [p for p in parts if p is not None]
    if not found:
        return spark.createDataFrame([], T.StructType.fromDDL(whole))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def compact(spark: SparkSession, path: str, schema: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Put the rows of all live batches into files of about `rows_per_file`; gives the number of batches. Run once a day, a day
    leaves rows / rows_per_file + 1 files."""
    known = records(spark, path)
    live = live_batches(known)
    if not live:
        return 0
    folder, last = f"{path}/_compacted/{uuid.uuid4().hex}", {}
    for r in live:
        last[r["run"]] = max(r["batch_id"], last.get(r["run"], -1))
    files = max(1, math.ceil(sum(r["rows"] for r in live) / rows_per_file))
    _read_live(spark, path, schema, known).repartition(files).write.parquet(folder)
    covers = [{"run": run, "last": n} for run, n in last.items()]
    _write_record(spark, path, f"compacted-{uuid.uuid4().hex}", {"folder": folder, "covers": covers})
    return len(live)


def expire(spark: SparkSession, path: str) -> int:
    """Remove the folders and records of compacted batches, once no reader is left that began before the compaction."""
    known = records(spark, path)
    last = covered(known)
    old = [r for r in known if r["folder"] is None and r["batch_id"] <= last.get(r["run"], -1)]
    for r in old:
        for name in (batch_folder(path, r["run"], r["batch_id"]), f"{path}/_commits/{r['run']}-{r['batch_id']}"):
            target = spark._jvm.org.apache.hadoop.fs.Path(name)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
    return len(old)


def batch_facts(spark: SparkSession, path: str) -> DataFrame:
    """(run, batch_id, rows, millis) of the batches whose records are there."""
    known = [(r["run"], r["batch_id"], r["rows"], r["millis"]) for r in records(spark, path) if r["folder"] is None]
    return spark.createDataFrame(known, "run string, batch_id long, rows long, millis double")


def batch_latency(spark: SparkSession, output: str, quarantine: str) -> DataFrame:
    """(run, batch_id, n_rows, n_rejected, millis, rows_per_second) of every micro-batch: the messages it took in, and what it took
    from its decoding until both outputs were complete."""
    done = batch_facts(spark, output)
    bad = batch_facts(spark, quarantine).select("run", "batch_id", F.col("rows").alias("n_rejected"), F.col("millis").alias("_bad"))
    millis = F.greatest("millis", "_bad")
    n_rows = F.col("rows") + F.col("n_rejected")
    return done.join(bad, ["run", "batch_id"]).select(
        "run", "batch_id", n_rows.alias("n_rows"), "n_rejected", millis.alias("millis"),
        (1000.0 * n_rows / millis).alias("rows_per_second"),
    )
