"""Event JSON: flows to keyed messages, messages back to flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.barrier import add_once
from ..functions.features import epoch_seconds, utc_timestamp
from ..operators.validate import validate_records
from ..schemas import EVENT, EVENT_PROPERTIES, PROPERTY_COLUMNS

CORRUPT = "_corrupt"
#: Where a message stands in its topic; kept through decoding and quarantine where the messages have it.
POSITION = ("topic", "partition", "offset", "time")
UNREADABLE_TIME = "unreadable time"


def position_columns(df: DataFrame) -> list[str]:
    return [c for c in POSITION if c in df.columns]


def to_messages(flows: DataFrame, key: str = "flow_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, value, keep...): one JSON event per flow, keyed by its id."""
    properties = [F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_PROPERTIES]
    event = F.struct(
        F.translate(utc_timestamp(F.col("timestamp")).cast("string"), " ", "T").alias("timestamp"),
        F.col(key).cast("string").alias("event_id"),
        F.struct(*properties).alias("properties"),
        F.col("attack").cast("int").alias("label"),
    )
    return flows.select(F.col(key).cast("string").alias("key"), F.to_json(event).alias("value"), *keep)


def parse_messages(messages: DataFrame) -> DataFrame:
    """Add `event` and `error`. Empty, malformed and non-object values get an error, never a failure."""
    schema = T.StructType([*EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    parsed = messages.withColumn(
        "event", F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    )
    error = (
        F.when(text.isNull() | (F.trim(text) == ""), F.lit("empty message"))
        .when(F.col("event").isNull() | F.col(f"event.{CORRUPT}").isNotNull(), F.lit("malformed JSON"))
        .when(F.col("event.properties").isNull(), F.lit("no properties"))
    )
    return add_once(parsed, {"error": error})


def flatten_events(parsed: DataFrame) -> DataFrame:
    """Decodable messages as flow rows: properties on top, ISO time as epoch seconds, label as attack."""
    moment = F.col("event.timestamp").try_cast("timestamp_ntz")
    columns = [F.col(f"event.properties.{c}").alias(c) for c in PROPERTY_COLUMNS]
    return parsed.where("error IS NULL").select(
        F.coalesce(F.col("key").cast("string"), F.col("event.event_id")).alias("key"),
        *columns,
        epoch_seconds(moment).alias("timestamp"),
        F.col("event.label").cast("long").alias("attack"),
        *position_columns(parsed),
    )


def check_events(parsed: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Decoded messages whose flow breaks a rule, or whose time can't be read, get an error too: they are never scored."""
    properties = {c: F.col(f"event.properties.{c}") for c in PROPERTY_COLUMNS}
    checked = validate_records(parsed.withColumns(properties), rules)
    broken = F.when(F.size("violations") > 0, F.concat(F.lit("invalid: "), F.array_join(F.array_sort("violations"), ",")))
    moment = F.col("event.timestamp").try_cast("timestamp_ntz")
    error = F.coalesce("error", broken, F.when(moment.isNull(), F.lit(UNREADABLE_TIME)))
    return add_once(checked.withColumn("_error", error).drop("error"), {"error": F.col("_error")}).select(*parsed.columns)


def rejected_messages(parsed: DataFrame) -> DataFrame:
    """(key, value, error), with its position, of everything that could not be decoded or was not accepted."""
    return parsed.where("error IS NOT NULL").select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "error", *position_columns(parsed)
    )
