"""Flow features as named Column expressions.

Each group is a dict of output name -> Column, so callers add a whole group in one projection with
`df.withColumns(...)`. Batch and stream share these and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pi as written in the trained feature set, and the weekend days (Sunday = 0).
PI = 3.1415926535
WEEKEND_DAYS = (5, 6)

# Destination ports that count as well known.
WELL_KNOWN_PORTS = [21, 22, 23, 25, 53, 80, 110, 143, 443]

def utc_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a zone-free UTC wall clock, whatever the session time zone is."""
    return F.timestamp_add("SECOND", seconds, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def epoch_seconds(moment: Column) -> Column:
    """Zone-free UTC wall clock to whole epoch seconds. (`timestamp_diff` would go through the session zone.)"""
    days = F.unix_date(moment.cast("date")).cast("long")
    return days * 86400 + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def time_features(
    timestamp: str = "timestamp", weekend_days: tuple[int, ...] = WEEKEND_DAYS
) -> dict[str, Column]:
    moment = utc_timestamp(F.col(timestamp))
    hour = F.hour(moment)
    day = F.dayofweek(moment) - 1
    angle = hour * F.lit(2 * PI) / 24.0
    return {
        "timestamp_ts": moment,
        "hour": hour,
        "dayofweek": day,
        "is_weekend": day.isin(*weekend_days).cast("int"),
        "hour_sin": F.sin(angle),
        "hour_cos": F.cos(angle),
    }


def epoch_features(timestamp_ts: str = "timestamp_ts") -> dict[str, Column]:
    return {"timestamp_epoch": epoch_seconds(F.col(timestamp_ts))}


def log_volume_features() -> dict[str, Column]:
    return {
        "bytes_log": F.log1p("bytes_transferred"),
        "packet_log": F.log1p("packet_count"),
    }


def ratio_features() -> dict[str, Column]:
    per_packet = F.col("bytes_transferred") / (F.col("packet_count") + 1)
    return {
        "bytes_per_packet": per_packet,
        "bytes_per_packet_log": F.log1p(per_packet),
        "pkt_per_byte": F.col("packet_count") / (F.col("bytes_transferred") + 1.0),
    }


def port_features() -> dict[str, Column]:
    return {
        "dst_well_known": F.when(F.col("dst_port").isin(WELL_KNOWN_PORTS), 1).otherwise(0),
        "src_port_bucket": (F.col("src_port") / 10000).cast("int"),
    }


def protocol_conn() -> dict[str, Column]:
    return {"protocol_conn": F.concat_ws("_", "protocol", "conn_state")}


def session_id(separator: str = "_") -> dict[str, Column]:
    parts = [F.col(c).cast("string") for c in ("src_port", "dst_port", "protocol")]
    return {"session_id": F.concat_ws(separator, *parts)}


def add(df: DataFrame, *groups: Mapping[str, Column]) -> DataFrame:
    """Add all groups in one projection."""
    merged: dict[str, Column] = {}
    for group in groups:
        merged.update(group)
    return df.withColumns(merged)


def deployed_features(df: DataFrame) -> DataFrame:
    """Time, log-volume and crossed features: the inputs of the deployed model."""
    return add(df, time_features(), log_volume_features(), protocol_conn())


def category_to_unit(column: str, values: list[str]) -> Column:
    """Spread an ordered category over [-1, 1]; unknown values give null, a single category 0."""
    if len(values) == 1:
        return F.when(F.col(column) == values[0], F.lit(0.0))
    step = 2.0 / (len(values) - 1)
    pairs = [F.lit(x) for i, v in enumerate(values) for x in (v, -1.0 + step * i)]
    return F.try_element_at(F.create_map(*pairs), F.col(column))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def class_name(label: Column, names: list[str]) -> Column:
    pairs = [F.lit(x) for i, name in enumerate(names) for x in (i, name)]
    return F.try_element_at(F.create_map(*pairs), label.cast("int"))


def clip(column: Column, low: float, high: float) -> Column:
    """Clip to a domain; null stays null (least/greatest alone would skip it)."""
    return F.when(column.isNotNull(), F.least(F.greatest(column, F.lit(low)), F.lit(high)))
