"""Dataset profiles: class shares, class counts, split shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.features import class_name
from ..schemas import CLASS_NAMES, TARGET


def class_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(target, name, n, share). The shares divide a handful of pre-aggregated rows."""
    counts = df.groupBy(target).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(
        target,
        class_name(F.col(target), CLASS_NAMES).alias("name"),
        "n",
        (F.col("n") / total).alias("share"),
    )


def num_classes(*parts: DataFrame, target: str = TARGET) -> DataFrame:
    """Distinct classes over the union of several splits."""
    union = parts[0].select(target)
    for part in parts[1:]:
        union = union.unionByName(part.select(target))
    return union.agg(F.count_distinct(target).alias("num_classes"))


def split_profile(df: DataFrame, split: str = "split") -> DataFrame:
    """(split, n_rows, n_columns)."""
    width = len([c for c in df.columns if c != split])
    return df.groupBy(split).agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(width))
