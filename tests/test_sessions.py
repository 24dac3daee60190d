"""Session windows against brute force, through the plain window and through ranges."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowlens.operators.sessions import SkewOptions, add_session_features, has_hot_session, in_ranges

SCHEMA = (
    "flow_id long, src_port long, dst_port long, protocol string, packet_count long, timestamp long,"
    " bytes_log double, packet_log double"
)
KEYS = ("src_port", "dst_port", "protocol")


def brute_force(rows):
    sessions = {}
    for r in rows:
        sessions.setdefault((r[1], r[2], r[3]), []).append(r)
    low = -math.inf
    found = {}
    for members in sessions.values():
        members.sort(key=lambda r: (low if r[5] is None else r[5], low if r[0] is None else r[0]))
        for place, r in enumerate(members):
            previous = members[max(0, place - 3) : place]

            def mean(i, of):
                values = [p[i] for p in of if p[i] is not None]
                return sum(values) / len(values) if values else None

            logs = [m[6] for m in members if m[6] is not None]
            found[r[0]] = (
                mean(6, previous) or 0.0,
                mean(7, previous) or 0.0,
                sum(p[4] is not None for p in previous),
                max(logs, default=None),
                min(logs, default=None),
                mean(7, members),
            )
    return found


def computed(df):
    names = [
        "prev_bytes_mean_3",
        "prev_packet_mean_3",
        "prev_event_count_3",
        "session_bytes_max",
        "session_bytes_min",
        "session_packet_mean",
    ]
    return {r["flow_id"]: tuple(r[n] for n in names) for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for key in a:
        for x, y in zip(a[key], b[key]):
            assert (x is None) == (y is None), (key, a[key], b[key])
            assert x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (key, a[key], b[key])


def make_rows(n, seed, hot_share=1 / 3, seconds=50, nulls=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < hot_share
        key = (7, 80, "TCP") if hot else (rng.randrange(6), rng.choice([22, None] if nulls else [22, 53]), rng.choice(["UDP", None] if nulls else ["UDP"]))
        packets = None if nulls and rng.random() < 0.1 else rng.randrange(1, 2000)
        bytes_log = None if nulls and rng.random() < 0.1 else rng.uniform(0, 14)
        time = None if nulls and rng.random() < 0.05 else 1_700_000_000 + rng.randrange(seconds)
        rows.append((i, *key, packets, time, bytes_log, None if packets is None else math.log1p(packets)))
    return rows


@pytest.mark.parametrize("ranges,buffer_rows", [(1, 10**6), (7, 10), (60, 5), (200, 10**6)])
@pytest.mark.parametrize("seconds", [1, 5000])
def test_ranges_do_not_change_results(spark, ranges, buffer_rows, seconds):
    """Sessions begin and end anywhere in ranges, some of which hold one row or none; buffers overflow."""
    rows = make_rows(600, seed=ranges + seconds, seconds=seconds)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    options = SkewOptions(hot_rows=3, probe_fraction=1.0, ranges=ranges, buffer_rows=buffer_rows)
    same(computed(add_session_features(df, options=options)), brute_force(rows))


@pytest.mark.parametrize("hot_rows", [100, 10**9])
def test_either_way_gives_the_same(spark, hot_rows):
    rows = make_rows(600, seed=hot_rows, seconds=40)
    df = spark.createDataFrame(rows, SCHEMA)
    same(computed(add_session_features(df, options=SkewOptions(hot_rows=hot_rows, probe_fraction=1.0))), brute_force(rows))


def test_a_session_of_one_second_is_split(spark):
    """No range holds much more than its share of the one session, with ids, without any time, and of rows that are all equal."""
    from pyspark.sql import functions as F

    def largest(df, ordering):
        blocks = in_ranges(df, KEYS, ordering, SkewOptions(ranges=16)).groupBy("_block").agg(F.count("*").alias("n")).collect()
        return len(blocks), max(r["n"] for r in blocks)

    rows = [(i, 7, 80, "TCP", 5, 1_700_000_000, 1.0, 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    timeless = df.withColumn("timestamp", F.lit(None).cast("long"))
    for frame, ordering in ((df, ["timestamp", "flow_id"]), (timeless, ["timestamp", "flow_id"]), (df.drop("flow_id"), ["timestamp", "packet_count"])):
        blocks, most = largest(frame, ordering)
        assert blocks >= 14 and most <= 2 * 4000 / 16


def test_probe_chooses_the_way(spark):
    df = spark.createDataFrame(make_rows(50, seed=1), SCHEMA)
    assert not has_hot_session(df, KEYS, SkewOptions(probe_fraction=1.0))
    assert has_hot_session(df, KEYS, SkewOptions(hot_rows=3, probe_fraction=1.0))
    assert not has_hot_session(df.limit(0), KEYS, SkewOptions(hot_rows=3, probe_fraction=1.0))


def test_not_a_number_counts_as_the_largest(spark):
    rows = [(i, 7, 80, "TCP", 5, i, float("nan") if i % 7 == 3 else float(i), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    ways = [computed(add_session_features(df, options=SkewOptions(hot_rows=h, probe_fraction=1.0, ranges=3))) for h in (5, 10**9)]
    assert str(ways[0]) == str({k: ways[1][k] for k in ways[0]})


@pytest.mark.parametrize("seconds", [1, 30])
def test_text_tie_breaker(spark, seconds):
    """Text ids order a busy second."""
    rows = make_rows(400, seed=3, seconds=seconds, nulls=False)
    df = spark.createDataFrame(rows, SCHEMA)
    texts = {r["flow_id"]: r["t"] for r in df.selectExpr("flow_id", "sha1(cast(flow_id AS string)) AS t").collect()}
    ranks = {k: i for i, k in enumerate(sorted(texts, key=texts.get))}
    renamed = [(texts[r[0]], *r[1:]) for r in rows]
    df = spark.createDataFrame(renamed, SCHEMA.replace("flow_id long", "flow_id string"))
    options = SkewOptions(hot_rows=10, probe_fraction=1.0)
    expected = brute_force([(ranks[r[0]], *r[1:]) for r in rows])
    names = {ranks[k]: t for k, t in texts.items()}
    same(computed(add_session_features(df, options=options)), {names[k]: v for k, v in expected.items()})


def test_session_without_any_time(spark):
    rows = [(i, 7, 80, "TCP", 5, None, float(i), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    options = SkewOptions(hot_rows=20, probe_fraction=1.0)
    same(computed(add_session_features(df, options=options)), brute_force(rows))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(1, 2000)), min_size=1, max_size=60
    ),
    st.integers(1, 6),
)
def test_any_frame(spark, events, hot_rows):
    rows = [
        (i, s, 80, "TCP", p, 1_700_000_000 + t, math.log1p(p * 3), math.log1p(p))
        for i, (s, t, p) in enumerate(events)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    options = SkewOptions(hot_rows=hot_rows, probe_fraction=1.0)
    same(computed(add_session_features(df, options=options)), brute_force(rows))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "double"])
def test_fractional_order(spark, kind):
    """Events 4 ms apart, some without a time, one far back: cuts change nothing."""
    rng = random.Random(4)
    ids = rng.sample(range(400), 400)
    rows = [(f, 7, 80, "TCP", 5, None if i % 40 == 9 else i * 4000, rng.uniform(0, 9), 1.0 * f) for i, f in enumerate(ids)]
    if kind == "double":
        rows[0] = (*rows[0][:5], -3 * 10**18, *rows[0][6:])
    df = spark.createDataFrame(rows, SCHEMA)
    micros = "timestamp_micros(timestamp)"
    as_kind = {"timestamp": micros, "timestamp_ntz": f"cast({micros} AS timestamp_ntz)", "double": "timestamp / 1e6"}
    df = df.selectExpr("* EXCEPT (timestamp)", f"{as_kind[kind]} AS timestamp")
    options = SkewOptions(hot_rows=20, probe_fraction=1.0)
    same(computed(add_session_features(df, options=options)), brute_force(rows))


def test_rows_without_id_do_not_depend_on_their_order(spark):
    rows = make_rows(300, seed=6, seconds=3)
    df = spark.createDataFrame(rows, SCHEMA).drop("flow_id")
    options = SkewOptions(hot_rows=20, probe_fraction=1.0)
    # A mean over a whole session may differ in its last digit, so only what depends on the order is held.
    first, second = (add_session_features(d, options=options).drop("session_packet_mean") for d in (df.coalesce(1), df.repartition(5, "bytes_log")))
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
