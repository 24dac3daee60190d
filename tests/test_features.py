"""Feature expressions on small frames, incl. time zones and stored timestamp types."""

import math

import pytest
from pyspark.sql import functions as F

from flowlens.functions import features as fx
from flowlens.sources.events import flatten_events, parse_messages, to_messages
from flowlens.sources.parquet import object_store_path, read_flows, read_split, split_path, write_split

FLOW = "src_port long, dst_port long, protocol string, packet_count long, conn_state string, bytes_transferred double, timestamp long, attack long"


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


# Thursday 2026-01-15 to Sunday 2026-01-18, noon UTC; and an hour New York skips in spring.
MOMENTS = [
    (1768478400, 12, 4, 0),
    (1768564800, 12, 5, 1),
    (1768651200, 12, 6, 1),
    (1768737600, 12, 0, 0),
    (1772937000, 2, 0, 0),
    (1783944000, 12, 1, 0),
]


def test_time_features_do_not_depend_on_the_session_zone(spark, zone):
    df = spark.createDataFrame([(m[0],) for m in MOMENTS], "timestamp long")
    df = fx.add(df, fx.time_features())
    df = fx.add(df, fx.epoch_features())
    for row, (seconds, hour, day, weekend) in zip(df.collect(), MOMENTS):
        assert (row["hour"], row["dayofweek"], row["is_weekend"]) == (hour, day, weekend)
        assert row["timestamp_epoch"] == seconds
        assert math.isclose(row["hour_sin"], math.sin(2 * fx.PI * hour / 24), abs_tol=1e-12)
        assert math.isclose(row["hour_cos"], math.cos(2 * fx.PI * hour / 24), abs_tol=1e-12)


def test_messages_keep_the_time_in_any_zone(spark, zone):
    rows = [(i, 2000, 80, "TCP", 5, "EST", 10.0, m[0], 0) for i, m in enumerate(MOMENTS)]
    df = spark.createDataFrame(rows, "flow_id long, " + FLOW)
    back = flatten_events(parse_messages(to_messages(df)))
    assert {(r["key"], r["timestamp"]) for r in back.collect()} == {(str(r[0]), r[7]) for r in rows}


def test_weekend_days_are_a_parameter(spark):
    df = spark.createDataFrame([(m[0],) for m in MOMENTS[:4]], "timestamp long")
    found = df.select(fx.time_features(weekend_days=(0, 6))["is_weekend"].alias("w")).collect()
    assert [r["w"] for r in found] == [0, 0, 1, 1]


def test_missing_and_negative_values(spark):
    df = spark.createDataFrame(
        [(None, None, None, 3, "EST", -5.0, None, None), (1024, 80, "TCP", None, None, None, 0, 1)], FLOW
    )
    out = fx.add(df, fx.log_volume_features(), fx.ratio_features(), fx.protocol_conn(), fx.session_id("-")).collect()
    assert out[0]["bytes_log"] is None and out[1]["bytes_log"] is None and out[1]["packet_log"] is None
    assert out[0]["protocol_conn"] == "EST" and out[1]["protocol_conn"] == "TCP"
    assert out[0]["session_id"] == "" and out[1]["session_id"] == "1024-80-TCP"
    assert out[0]["bytes_per_packet"] == -1.25


def test_ports(spark):
    df = spark.createDataFrame([(65535, 443), (9999, 444), (1024, None)], "src_port long, dst_port long")
    out = df.select(*[c.alias(n) for n, c in fx.port_features().items()]).collect()
    assert [tuple(r) for r in out] == [(1, 6), (0, 0), (0, 0)]


def test_category_to_unit(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("x",), (None,)], "v string")
    found = [r[0] for r in df.select(fx.category_to_unit("v", ["a", "b", "c"])).collect()]
    assert found == [-1.0, 0.0, 1.0, None, None]
    assert df.select(fx.category_to_unit("v", ["a"])).first()[0] == 0.0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,), (99.0,), (None,)], "v double")
    assert [r[0] for r in df.select(fx.clip(F.col("v"), 0.0, 10.0)).collect()] == [0.0, 5.0, 10.0, None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "bigint"])
def test_stored_timestamps_become_seconds(spark, tmp_path, kind):
    seconds = [m[0] for m in MOMENTS]
    df = spark.createDataFrame([(s,) for s in seconds], "timestamp long")
    if kind != "bigint":
        df = df.select(fx.utc_timestamp(F.col("timestamp")).cast(kind).alias("timestamp"))
    df.write.parquet(str(tmp_path / "raw"))
    back = read_flows(spark, str(tmp_path / "raw"))
    assert dict(back.dtypes)["timestamp"] == "bigint"
    assert sorted(r["timestamp"] for r in back.collect()) == sorted(seconds)
    assert back.columns == [f.split()[0] for f in FLOW.split(", ")]
    assert back.first()["protocol"] is None


@pytest.mark.parametrize("unit", ["ms", "us", "ns"])
def test_arrow_timestamp_units(spark, tmp_path, unit):
    import pyarrow as pa
    import pyarrow.parquet as pq

    scale = {"ms": 10**3, "us": 10**6, "ns": 10**9}[unit]
    values = pa.array([m[0] * scale + scale - 1 for m in MOMENTS], pa.timestamp(unit))
    pq.write_table(pa.table({"timestamp": values}), tmp_path / "f.parquet", version="2.6")
    back = read_flows(spark, str(tmp_path / "f.parquet"))
    assert sorted(r["timestamp"] for r in back.collect()) == sorted(m[0] for m in MOMENTS)


def test_write_split_bounds_files_and_overwrites(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = [(1024, 80, "TCP", 1, "EST", 1.0, i, 0) for i in range(250)]
    df = spark.createDataFrame(rows, FLOW).coalesce(1)
    for _ in range(2):
        path = write_split(df, str(tmp_path), "val", records_per_file=100)
    import glob

    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == 250 and max(sizes) <= 100
    assert read_split(spark, str(tmp_path), "val").count() == 250


def test_paths_and_splits():
    assert object_store_path("s3://bucket/a") == "s3a://bucket/a"
    assert object_store_path("s3a://bucket/a") == "s3a://bucket/a"
    assert object_store_path("/local/s3/a") == "/local/s3/a"
    assert split_path("s3://b/raw/", "train") == "s3a://b/raw/train"
    with pytest.raises(ValueError, match="split"):
        split_path("/x", "dev")
