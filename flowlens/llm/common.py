"""What the corpus operators share: word patterns, table access, scratch tables, Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import scratch_path

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch: long texts must not add up to more than a task holds.
BATCH_ROWS = 1000
#: With this setting a job's shuffle files go when it ends: what it wrote is read from the shared folder.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of text that one vectorised step handles.
SLICE_BYTES = 4 << 20
#: Tables written since each open `scratch_scope` began, the innermost last.
_WRITTEN: list[list[str]] = []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers find the package where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}" if known else root


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch, and let Python workers find the package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    workers_find_package(spark)


def small_side(df: DataFrame, limit: int) -> DataFrame:
    """A stored table as the small side of a join: sent to every task if it has at most `limit` rows, else joined by key."""
    return F.broadcast(df) if df.count() <= limit else df


def stored(df: DataFrame, purpose: str, *partition_by: str, **options: object) -> DataFrame:
    """Write to the shared folder and read again: later steps restart from the files, not from the lineage."""
    spark = df.sparkSession
    path, before = scratch_path(spark, purpose), spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        writer = df.write.mode("overwrite").options(**options)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables stored within when the scope ends. The function given marks the last one stored as its result,
    which stays: lost executors read that again, so nothing deleted is needed."""

    def kept(df: DataFrame) -> DataFrame:
        path = _WRITTEN[-1].pop()
        if len(_WRITTEN) > 1:
            _WRITTEN[-2].append(path)
        return df

    _WRITTEN.append([])
    try:
        yield kept
    finally:
        for path in _WRITTEN.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it in `body`."""
    return F.transform(F.array(value), body)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as text, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.fill_null("") if column.null_count else column


def text_bytes(column: pa.Array):
    """Offsets (n + 1) and data of a string array, as numpy views."""
    import numpy as np

    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def slices(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that `name` holds about SLICE_BYTES in each piece (one row at least)."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, _ = text_bytes(text_column(batch, name))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
