"""Zero-based rank of distinct values, computed without pulling them through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def rank_distinct(values: DataFrame, group: str, order: list[Column], name: str = "idx") -> DataFrame:
    """Rank rows inside `group` by `order` over a range-partitioned, checkpointed copy.

    Only one count per (partition, group) meets in a window; the values themselves stay spread out.
    The checkpoint pins partition numbers, so a recomputed task cannot shift a rank.
    """
    ensure_checkpoint_dir(values.sparkSession)
    placed = (
        values.repartitionByRange(F.col(group), *order)
        .sortWithinPartitions(F.col(group), *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(group, "_part")
        .agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    # At most (partitions x groups) rows.
    return (
        placed.join(F.broadcast(offsets), [group, "_part"])
        .withColumn(name, (F.col("_before") + F.col("_place") - F.col("_first")).cast("int"))
        .drop("_part", "_place", "_before", "_first")
    )
