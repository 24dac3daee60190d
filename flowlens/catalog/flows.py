"""The `flows` view: one flow per row of the `events` table (see FIXTURES.md)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import epoch_seconds
from ..operators.validate import check_split
from ..schemas import RAW_FLOW

# Chronological splits: days 1-18, 19-24 and 25-30 of the month the events cover.
VAL_FROM = "2024-01-19 00:00:00"
TEST_FROM = "2024-01-25 00:00:00"

FLOW_COLUMNS = ["flow_id", *RAW_FLOW.fieldNames(), "split"]


def _ntz(text: str):
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def as_flows(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("long") % 5)
    k = F.col("k")
    high_port = 1024 + (F.col("user_id") * 977) % 64511
    place = (F.col("event_id") * 7919) % 1000
    kind = F.col("event_type")
    return rows.select(
        F.col("event_id").alias("flow_id"),
        (1024 + (F.col("user_id") * 431) % 64511).cast("long").alias("src_port"),
        F.when(k == 0, 22).when(k == 1, 80).when(k == 2, 443).when(k == 3, 53)
        .otherwise(high_port).cast("long").alias("dst_port"),
        F.when(kind.isin("view", "click"), "TCP").when(kind.isin("purchase", "signup"), "UDP")
        .when(kind == "error", "ICMP").alias("protocol"),
        (1 + (F.col("event_id") * 37) % 2000).cast("long").alias("packet_count"),
        F.get(F.array(*[F.lit(s) for s in ("EST", "SYN", "FIN", "RST")]), (F.col("event_id") % 4).cast("int"))
        .alias("conn_state"),
        (F.col("value") * F.lit(4000.0)).alias("bytes_transferred"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
        F.when(place < 942, 0).when(place < 962, 1).when(place < 972, 2).when(place < 987, 3)
        .when(place < 995, 4).otherwise(5).cast("long").alias("attack"),
        F.when(F.col("ts") < _ntz(VAL_FROM), "train").when(F.col("ts") < _ntz(TEST_FROM), "val")
        .otherwise("test").alias("split"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_flows(events(spark, sf_dir))


def flows_split(spark: SparkSession, sf_dir: str, *splits: str) -> DataFrame:
    """Some splits; the time range is a filter on the stored column, so it reaches the scan."""
    bounds = {
        "train": F.col("ts") < _ntz(VAL_FROM),
        "val": (F.col("ts") >= _ntz(VAL_FROM)) & (F.col("ts") < _ntz(TEST_FROM)),
        "test": F.col("ts") >= _ntz(TEST_FROM),
    }
    wanted = reduce(lambda a, b: a | b, [bounds[check_split(s)] for s in splits])
    return as_flows(events(spark, sf_dir).where(wanted))


def flows_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows with broken values, for validation and null handling."""
    return flows(spark, sf_dir).select(
        "flow_id",
        F.when((F.col("dst_port") == 22) & (F.col("conn_state") == "RST"), F.lit(0).cast("long"))
        .otherwise(F.col("src_port")).alias("src_port"),
        "dst_port",
        F.when((F.col("dst_port") == 53) & (F.col("conn_state") == "FIN"), "GRE")
        .otherwise(F.col("protocol")).alias("protocol"),
        F.when(F.col("packet_count") > 1900, F.col("packet_count") + 500)
        .otherwise(F.col("packet_count")).alias("packet_count"),
        F.when(F.col("src_port") > 60000, F.lit(None).cast("string")).otherwise(F.col("conn_state")).alias("conn_state"),
        F.when(F.col("packet_count") < 100, F.lit(None).cast("double"))
        .otherwise(F.col("bytes_transferred") * F.lit(1.5)).alias("bytes_transferred"),
        "timestamp",
        "attack",
        "split",
    )
