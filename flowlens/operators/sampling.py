"""Repeatable samples: exact per class, or a share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import in_share, seeded_hex
from ..session import scratch_path

MINIMUM_PER_CLASS = 5
#: Hex digits of a hash that one round counts by, of all it has, and rows of a class's cut bucket that one task sorts.
BUCKET_DIGITS = 4
HASH_DIGITS = 32
CUT_ROWS = 1_000_000
MAX_BROADCAST_CLASSES = 10_000


def class_quota(size: Column, fraction: float) -> Column:
    """max(min(size, 5), floor(size * fraction))."""
    share = F.floor(size * F.lit(float(fraction))).cast("long")
    return F.greatest(F.least(size, F.lit(MINIMUM_PER_CLASS)), share)


def _cut_buckets(counts: DataFrame, target: str) -> DataFrame:
    """(class, cut, n, open) from (target, bucket, n, quota): the bucket in which a class's running count reaches its quota, how
    many rows it holds and how many of them are wanted. One row per class."""
    running = Window.partitionBy(target).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    reached = counts.withColumn("_upto", F.sum("_n").over(running))
    on_cut = (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota"))
    return reached.where(on_cut).select(
        F.col(target).alias("_class"), F.col("_bucket").alias("_cut"), F.col("_n"), (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_open")
    )


def _kept_small(cuts: DataFrame) -> DataFrame:
    """One row per class: kept on the driver and sent to the tasks where that is known to be few, else written."""
    spark = cuts.sparkSession
    rows = cuts.limit(MAX_BROADCAST_CLASSES + 1).collect()
    if len(rows) <= MAX_BROADCAST_CLASSES:
        return F.broadcast(spark.createDataFrame(rows, cuts.schema))
    path = scratch_path(spark, "cuts")
    cuts.write.parquet(path)
    return spark.read.parquet(path)


def find_cuts(hashed: DataFrame, target: str, fraction: float, digits: int = BUCKET_DIGITS, cut_rows: int = CUT_ROWS) -> tuple[DataFrame, int]:
    """The cut of each class by radix selection over the hash's digits, and the number of rounds.

    Every round counts by the next digits, and only within the buckets on a cut that still hold more rows than one task should
    sort. So n rows of a class take about log(n / cut_rows) rounds to the base 16 ** digits: one for all but the largest.
    """
    buckets = hashed.groupBy(target, F.substring("_hash", 1, digits).alias("_bucket")).agg(F.count("*").alias("_n"))
    size = F.sum("_n").over(Window.partitionBy(target))
    cuts = _kept_small(_cut_buckets(buckets.withColumn("_quota", class_quota(size, fraction)), target))
    rounds, length = 1, digits
    while length < HASH_DIGITS and (cuts.agg(F.max("_n")).first()[0] or 0) > cut_rows:
        length = min(length + digits, HASH_DIGITS)
        wide, fine = cuts.where(F.col("_n") > cut_rows), cuts.where(F.col("_n") <= cut_rows)
        inside = hashed.join(F.broadcast(wide) if wide.count() <= MAX_BROADCAST_CLASSES else wide, F.col(target).eqNullSafe(F.col("_class")))
        inside = inside.where(F.startswith("_hash", "_cut"))
        finer = inside.groupBy(target, F.substring("_hash", 1, length).alias("_bucket")).agg(F.count("*").alias("_n"), F.first("_open").alias("_quota"))
        cuts = _kept_small(_cut_buckets(finer, target).unionByName(fine))
        rounds += 1
    return cuts, rounds


def stratified_sample(
    df: DataFrame, target: str, fraction: float, key: str, seed: int = 42, digits: int = BUCKET_DIGITS, cut_rows: int = CUT_ROWS
) -> DataFrame:
    """Exactly the quota of each class: the rows with the smallest seeded hash of `key`, the row id.

    One class may hold nearly all rows, so classes are never sorted whole. Radix selection finds a bucket of hashes on each
    class's cut that is small enough for a task; buckets below are taken by a plain filter, and only that one is ranked, with
    copies of a row counted before they meet.
    """
    hashed = df.withColumn("_hash", seeded_hex(seed, F.col(key)))
    cuts, _ = find_cuts(hashed, target, fraction, digits, cut_rows)
    marked = hashed.join(cuts.drop("_n"), F.col(target).eqNullSafe(F.col("_class")))
    bucket = F.left("_hash", F.length("_cut"))
    below = marked.where(bucket < F.col("_cut"))
    columns = df.columns
    rest = [c for c in columns if c not in (target, key)]
    ranked = Window.partitionBy(target).orderBy("_hash", key, *rest)
    before = F.coalesce(
        F.sum("_n").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")
    )
    on_cut = (
        marked.where(bucket == F.col("_cut"))
        .groupBy(*columns, "_hash", "_open")
        .agg(F.count("*").alias("_n"))
        .withColumn("_taken", F.least(F.col("_n"), F.col("_open") - before))
        .where(F.col("_taken") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_taken"))))
    )
    return below.select(*columns).unionByName(on_cut.select(*columns))


def share_sample(df: DataFrame, fraction: float | None, key: str | None = None, seed: int = 42) -> DataFrame:
    """A share of all rows without a shuffle; no fraction, or one outside (0, 1), keeps all.

    With a `key` the choice depends on the key alone and repeats in any layout.
    """
    if fraction is None or fraction <= 0.0 or fraction >= 1.0:
        return df
    if key is None:
        return df.sample(fraction, seed=seed)
    return df.where(in_share(seed, F.col(key), fraction))


def row_cap(df: DataFrame, rows: int, order: list[str] | None = None) -> DataFrame:
    """At most `rows` rows, in a stable order when one is given; 0 or less keeps all."""
    if rows <= 0:
        return df
    return (df.orderBy(*order) if order else df).limit(rows)
