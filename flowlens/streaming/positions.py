"""Where a topic's messages stand: what was read of each partition, what is missing between, and how far the end is.

Offsets are counted exactly with bitmaps of 32,768 offsets each, which tasks build before the shuffle: a partition that holds most
messages sends one bitmap for each block and task, not its rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["topic", "partition"]


def offset_blocks(messages: DataFrame) -> DataFrame:
    """(topic, partition, block, n, n_rejected, distinct, first, last, first_time, last_time). `messages` has POSITION, and
    `error` where they were rejected."""
    rejected = F.count_if(F.col("error").isNotNull()) if "error" in messages.columns else F.lit(0).cast("long")
    blocks = messages.groupBy(*KEYS, F.bitmap_bucket_number("offset").alias("block")).agg(
        F.count("*").alias("n"), rejected.alias("n_rejected"),
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("offset"))).alias("distinct"),
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.min("time").alias("first_time"), F.max("time").alias("last_time"),
    )
    return blocks


def partition_report(messages: DataFrame) -> DataFrame:
    """One row per partition: how many messages, first and last offset and time, offsets missing between them, offsets read again."""
    read = offset_blocks(messages).groupBy(*KEYS).agg(
        F.sum("n").alias("n_messages"), F.sum("n_rejected").alias("n_rejected"), F.sum("distinct").alias("_distinct"),
        F.min("first").alias("first_offset"), F.max("last").alias("last_offset"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
    )
    return read.withColumns(
        {
            "n_missing": F.col("last_offset") - F.col("first_offset") + 1 - F.col("_distinct"),
            "n_repeated": F.col("n_messages") - F.col("_distinct"),
        }
    ).drop("_distinct")


def gap_blocks(messages: DataFrame) -> DataFrame:
    """(topic, partition, from_offset, to_offset, n_missing): stretches of up to 32,768 offsets inside which some are missing."""
    blocks = offset_blocks(messages)
    inside = F.col("last") - F.col("first") + 1 - F.col("distinct")
    return blocks.where(inside > 0).select(*KEYS, F.col("first").alias("from_offset"), F.col("last").alias("to_offset"), inside.alias("n_missing"))


def with_lag(report: DataFrame, ends: DataFrame) -> DataFrame:
    """The report with `lag`: messages up to `end_offset` (the next one to be written) that were not read. A partition of
    which nothing was read has all before it."""
    joined = report.join(ends.select(*KEYS, "end_offset"), KEYS, "full")
    lag = F.greatest(F.col("end_offset") - 1 - F.coalesce(F.col("last_offset"), F.lit(-1)), F.lit(0))
    return joined.withColumn("lag", lag)


def end_offsets(spark: SparkSession, latest: str) -> DataFrame:
    """(topic, partition, end_offset) from the `latestOffset` of a topic source, as a stream's progress reports it."""
    found = [(t, int(p), int(o)) for t, parts in json.loads(latest).items() for p, o in parts.items()]
    return spark.createDataFrame(found, "topic string, partition int, end_offset long")
