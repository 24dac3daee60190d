"""Schemas, value domains and column contracts of the flow product."""

from __future__ import annotations

from pyspark.sql import types as T

RAW_FLOW = T.StructType(
    [
        T.StructField("src_port", T.LongType()),
        T.StructField("dst_port", T.LongType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("packet_count", T.LongType()),
        T.StructField("conn_state", T.StringType()),
        T.StructField("bytes_transferred", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("attack", T.LongType()),
    ]
)

EVENT_PROPERTIES = T.StructType(
    [
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("packet_count", T.IntegerType()),
        T.StructField("conn_state", T.StringType()),
        T.StructField("bytes_transferred", T.DoubleType()),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("properties", EVENT_PROPERTIES),
        T.StructField("label", T.IntegerType()),
    ]
)

PROPERTY_COLUMNS = EVENT_PROPERTIES.fieldNames()

# Value domains of a flow record.
PROTOCOLS = ["TCP", "UDP", "ICMP"]
CONN_STATES = ["EST", "SYN", "FIN", "RST"]
RANGES = {
    "src_port": (1024, 65535),
    "dst_port": (1, 65535),
    "packet_count": (1, 2000),
    "bytes_transferred": (0.0, 2e6),
}
CATEGORIES = {"protocol": PROTOCOLS, "conn_state": CONN_STATES}

# Class names by label id.
CLASS_NAMES = ["Normal", "DoS", "Probe", "R2L", "U2R", "Worm"]
NUM_CLASSES = len(CLASS_NAMES)

TARGET = "attack"
SPLITS = ("train", "val", "test")

# Model inputs of the deployed feature set, in the order the model expects.
CATEGORICAL = ["protocol", "conn_state", "protocol_conn"]
NUMERIC = [
    "src_port",
    "dst_port",
    "packet_count",
    "bytes_transferred",
    "bytes_log",
    "packet_log",
    "hour",
    "dayofweek",
    "is_weekend",
    "hour_sin",
    "hour_cos",
]
MODEL_INPUTS = [f"{c}_idx" for c in CATEGORICAL] + [f"{c}_norm" for c in NUMERIC]

# Inputs of the richer, session-aware feature set.
RICH_CATEGORICAL = ["protocol", "conn_state"]
RICH_NUMERIC = [
    "src_port",
    "dst_port",
    "packet_count",
    "bytes_transferred",
    "bytes_log",
    "packet_log",
    "bytes_per_packet",
    "bytes_per_packet_log",
    "prev_bytes_mean_3",
    "prev_packet_mean_3",
    "prev_event_count_3",
    "session_bytes_max",
    "session_bytes_min",
    "session_packet_mean",
    "protocol",
    "conn_state",
    "timestamp_epoch",
]

# The 20 inputs of the Spark ML variant, in vector order.
ML_INPUTS = [
    "src_port",
    "dst_port",
    "packet_count",
    "bytes_transferred",
    "bytes_log",
    "packet_log",
    "pkt_per_byte",
    "hour",
    "dayofweek",
    "is_weekend",
    "hour_sin",
    "hour_cos",
    "dst_well_known",
    "src_port_bucket",
    "protocol_idx",
    "conn_state_idx",
    "protocol_conn_idx",
    "prev_bytes_mean_3",
    "prev_packet_mean_3",
    "prev_event_count_3",
]
