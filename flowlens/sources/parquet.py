"""Parquet splits: declared schema in, bounded files out."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from ..functions.features import epoch_seconds
from ..operators.validate import check_split
from ..schemas import RAW_FLOW

log = logging.getLogger(__name__)

DEFAULT_RECORDS_PER_FILE = 100_000
NANOS = 1_000_000_000


def object_store_path(path: str) -> str:
    """`s3://` paths in the form Hadoop's S3A client takes; others unchanged."""
    scheme, separator, rest = path.partition("://")
    return f"s3a://{rest}" if separator and scheme == "s3" else path


def split_path(root: str, split: str) -> str:
    return f"{object_store_path(root).rstrip('/')}/{check_split(split)}"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema in the file footers; None when it holds nanosecond timestamps, which Spark has no type for."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if "NANOS" not in str(error):
            raise
        return None
    except Exception as error:  # footer errors may arrive wrapped in a job failure
        if "NANOS" not in str(error):
            raise
        return None


def read_flows(
    spark: SparkSession, path: str, schema: T.StructType = RAW_FLOW, time_column: str = "timestamp"
) -> DataFrame:
    """Flow records with the declared schema.

    A `timestamp` stored as a Parquet timestamp would be read through a long schema as raw ticks, so the
    stored type is looked up first (footers only) and such a column is turned into epoch seconds.
    Columns the files lack come back null, as with any declared schema.
    """
    path = object_store_path(path)
    stored = stored_schema(spark, path)
    kind = None if stored is None or time_column not in stored.names else stored[time_column].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        df = spark.read.schema(schema).parquet(path)
        if stored is not None:
            return df
        whole = F.col(time_column) - F.pmod(F.col(time_column), F.lit(NANOS))
        return df.withColumn(time_column, (whole / NANOS).cast("long"))
    reading = T.StructType([T.StructField(f.name, kind if f.name == time_column else f.dataType) for f in schema])
    moment = F.col(time_column)
    seconds = F.unix_seconds(moment) if isinstance(kind, T.TimestampType) else epoch_seconds(moment)
    return spark.read.schema(reading).parquet(path).withColumn(time_column, seconds)


def read_split(spark: SparkSession, root: str, split: str, schema: T.StructType = RAW_FLOW) -> DataFrame:
    df = read_flows(spark, split_path(root, split), schema)
    log.info("reading split %s from %s", split, root)
    return df


def write_split(
    df: DataFrame, root: str, split: str, records_per_file: int = DEFAULT_RECORDS_PER_FILE
) -> str:
    """Overwrite one split; no file holds more than `records_per_file` rows."""
    path = split_path(root, split)
    df.write.mode("overwrite").option("maxRecordsPerFile", records_per_file).parquet(path)
    return path


def read_processed(spark: SparkSession, root: str, split: str, partitions: int | None = None) -> DataFrame:
    """Processed features for training, optionally spread over a given number of partitions."""
    df = spark.read.parquet(split_path(root, split))
    return df.repartition(partitions) if partitions else df
