"""Streams against batches: decoding, restart, replay, quarantine; Kafka options."""

import json

import pytest
from pyspark.sql import functions as F

from flowlens.operators import drift
from flowlens.functions.rules import concept_scores
from flowlens.plans import training
from flowlens.plans.preprocess import feature_set
from flowlens.sources import kafka
from flowlens.sources.events import flatten_events, parse_messages, rejected_messages, to_messages
from flowlens.streaming import commits, positions
from flowlens.streaming import score as streams

ABOUT = {"variant": "stable", "framework": "rule", "model_key": "k"}


def rule(df):
    return drift.with_rule_label(df, concept_scores())


def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("input", "output", "quarantine", "checkpoint")}


def run(spark, p, score=rule):
    source = streams.file_messages(spark, p["input"], files_per_batch=1)
    streams.run_available(streams.scoring_stream(source, score, p["output"], p["quarantine"], p["checkpoint"], ABOUT))
    return streams.read_batches(spark, p["output"], "key string, value string")


def test_message_errors(spark):
    good = {"timestamp": "2026-01-12T18:00:05", "properties": {"src_port": 5, "protocol": "TCP"}, "label": 2}
    rows = [
        ("a", json.dumps({**good, "event_id": "e1"})),
        (None, json.dumps({**good, "event_id": "e2", "extra": [1]})),
        ("c", json.dumps(good)),
        ("d", json.dumps(good)[:30]),
        ("e", ""),
        ("f", None),
        ("g", "[1, 2]"),
        ("h", '{"timestamp": "x"}'),
        ("i", json.dumps({**good, "timestamp": "not a time"})),
    ]
    parsed = parse_messages(spark.createDataFrame(rows, "key string, value string"))
    flat = {r["key"]: r for r in flatten_events(parsed).collect()}
    assert set(flat) == {"a", "e2", "c", "i"}
    assert flat["a"]["timestamp"] == 1768240805 and flat["a"]["attack"] == 2 and flat["a"]["dst_port"] is None
    assert flat["i"]["timestamp"] is None
    errors = {r["key"]: r["error"] for r in rejected_messages(parsed).collect()}
    assert errors == {
        "d": "malformed JSON",
        "e": "empty message",
        "f": "empty message",
        "g": "malformed JSON",
        "h": "no properties",
    }


def test_stream_equals_batch_and_restarts_without_gaps(spark, small_flows, tmp_path):
    p = paths(tmp_path)
    messages = to_messages(small_flows)
    messages.where("key < '5'").repartition(3).write.parquet(p["input"])
    first = run(spark, p).count()
    messages.where("key >= '5'").repartition(3).write.mode("append").parquet(p["input"])
    delivered = run(spark, p)
    assert 0 < first < delivered.count() == small_flows.count()
    answers = delivered.select("key", F.get_json_object("value", "$.prediction").cast("long").alias("prediction"))
    expected = rule(small_flows).select(F.col("flow_id").cast("string").alias("key"), "prediction")
    assert answers.exceptAll(expected).count() == 0 and expected.exceptAll(answers).count() == 0


def test_new_checkpoint_keeps_earlier_output(spark, small_flows, tmp_path):
    p = paths(tmp_path)
    messages = to_messages(small_flows).repartition(1)
    for part, half in (("one", "key < '5'"), ("two", "key >= '5'")):
        q = {**p, "input": str(tmp_path / part), "checkpoint": str(tmp_path / f"checkpoint-{part}")}
        messages.where(half).write.parquet(q["input"])
        run(spark, q)
    delivered = streams.read_batches(spark, p["output"], "key string, value string")
    assert delivered.count() == small_flows.count() == delivered.select("key").distinct().count()


def test_replayed_batch_leaves_no_duplicates(spark, small_flows, tmp_path):
    p = paths(tmp_path)
    batch = to_messages(small_flows)
    outputs = {p["output"]: lambda parsed: streams.predictions(flatten_events(parsed), rule, ABOUT)}
    for _ in range(2):
        streams.deliver(batch, 7, outputs)
    assert streams.read_batches(spark, p["output"], "key string, value string").count() == small_flows.count()


def test_trained_model_on_the_stream(spark, small_flows, tmp_path):
    """Raw events are featured with the batch-fitted state, so stream and batch agree."""
    p = paths(tmp_path)
    train = drift.relabel(small_flows)
    fitted = feature_set("deployed").fit(train)
    model = training.fit_model(fitted.transform(train), "forest")
    to_messages(small_flows).repartition(2).write.parquet(p["input"])

    def scored(df):
        return model.score(fitted.transform_for_inference(df, keep=("key",)))

    schema = "prediction long, probabilities array<double>"
    delivered = run(spark, p, scored).select("key", F.from_json("value", schema).alias("a")).select("key", "a.*")
    batch = model.score(fitted.transform_for_inference(small_flows, keep=("flow_id",)))
    both = delivered.join(batch.select(F.col("flow_id").cast("string").alias("key"), F.col("prediction").alias("b")), "key")
    assert both.count() == small_flows.count() and both.where("prediction <> b").count() == 0
    assert all(sum(r["probabilities"]) == pytest.approx(1.0) for r in delivered.take(20))


def test_text_lines_and_continuous_run(spark, tmp_path):
    p = paths(tmp_path)
    properties = {"src_port": 2000, "dst_port": 80, "protocol": "TCP", "packet_count": 3, "conn_state": "EST"}
    properties["bytes_transferred"] = 5.0
    line = json.dumps({"timestamp": "2026-01-12T18:00:05", "properties": properties, "label": 0})
    (tmp_path / "input").mkdir()
    (tmp_path / "input" / "a.json").write_text(f"{line}\n{line[:20]}\n{line}\n")
    source = streams.text_messages(spark, p["input"], files_per_batch=1)
    writer = streams.scoring_stream(source, rule, p["output"], p["quarantine"], p["checkpoint"], ABOUT)
    running = streams.run_continuously(writer, "200 milliseconds")
    running.processAllAvailable()
    running.stop()
    running.awaitTermination(30)
    assert not running.isActive
    assert streams.read_batches(spark, p["output"], "key string, value string").count() == 2
    bad = streams.read_batches(spark, p["quarantine"], "key string, value string, error string").collect()
    assert [r["error"] for r in bad] == ["malformed JSON"]


def test_topic_sink_gets_predictions_and_quarantine_gets_the_rest(spark, small_flows, tmp_path, monkeypatch):
    """The connector is replaced by a table; what is published must be what a batch would answer."""
    p = paths(tmp_path)
    target = kafka.KafkaTarget("broker:9092", "predictions")
    monkeypatch.setattr(
        streams, "publish", lambda df, t: df.withColumn("topic", F.lit(t.topic)).write.mode("append").parquet(p["output"])
    )
    messages = to_messages(small_flows)
    broken = messages.limit(3).select("key", F.lit("{").alias("value"))
    messages.unionByName(broken).coalesce(1).write.parquet(p["input"])
    source = streams.file_messages(spark, p["input"])
    streams.run_available(
        streams.topic_scoring_stream(source, rule, target, p["quarantine"], p["checkpoint"], ABOUT)
    )
    published = spark.read.parquet(p["output"])
    assert published.count() == small_flows.count()
    assert {r["topic"] for r in published.select("topic").distinct().collect()} == {"predictions"}
    answer = json.loads(published.first()["value"])
    assert answer["model"] == ABOUT and answer["prediction"] in range(6)
    assert streams.read_batches(spark, p["quarantine"], "key string, value string, error string").count() == 3


def test_kafka_options():
    plain = kafka.KafkaTarget("broker:9092", "flows")
    source = kafka.source_options(plain, min_partitions=6)
    assert source["startingOffsets"] == "earliest" and source["minPartitions"] == "6"
    assert source["kafka.isolation.level"] == "read_committed" and source["maxOffsetsPerTrigger"] == "5000000"
    trusted = kafka.KafkaTarget("b", "t", ca_file="/etc/ca.pem").security()
    assert trusted["kafka.security.protocol"] == "SSL" and trusted["kafka.ssl.truststore.location"] == "/etc/ca.pem"
    assert source["kafka.security.protocol"] == "PLAINTEXT" and source["subscribe"] == "flows"
    sink = kafka.sink_options(kafka.KafkaTarget("broker:9092", "predictions", "user", "secret"))
    assert sink["kafka.acks"] == "all" and sink["kafka.enable.idempotence"] == "true"
    assert sink["kafka.sasl.mechanism"] == "SCRAM-SHA-512" and "ScramLoginModule" in sink["kafka.sasl.jaas.config"]
    simple = kafka.KafkaTarget("b", "t", "u", "p", mechanism="PLAIN").security()
    assert "PlainLoginModule" in simple["kafka.sasl.jaas.config"]


# --- records, compaction, positions, checks ----------------------------------------------------------

ANSWER = "key string, value string"


def answers(spark, p):
    return sorted(r["key"] for r in streams.read_batches(spark, p["output"], ANSWER).collect())


def test_a_torn_batch_is_not_read(spark, small_flows, tmp_path):
    p = paths(tmp_path)
    outputs = {p["output"]: lambda parsed: streams.predictions(flatten_events(parsed), rule, ABOUT)}
    batch = to_messages(small_flows).select("key", "value")
    assert streams.read_batches(spark, p["output"], ANSWER).count() == 0
    batch.write.parquet(commits.batch_folder(p["output"], "run", 0))
    assert streams.read_batches(spark, p["output"], ANSWER).count() == 0
    streams.deliver(batch.where("key < '3'"), 0, outputs, run="run")
    assert answers(spark, p) == sorted(r["key"] for r in batch.where("key < '3'").collect())
    # a replay after the record changes nothing, not even with other rows
    streams.deliver(batch, 0, outputs, run="run")
    assert len(answers(spark, p)) == batch.where("key < '3'").count()


def test_compaction_takes_the_place_of_batches(spark, small_flows, tmp_path):
    p = paths(tmp_path)
    outputs = {p["output"]: lambda parsed: streams.predictions(flatten_events(parsed), rule, ABOUT)}
    batch = to_messages(small_flows).select("key", "value")

    def send(i, run="a"):
        streams.deliver(batch.where(F.col("key").cast("long") % 6 == i), i, outputs, run=run)

    for i in range(3):
        send(i)
    before = answers(spark, p)
    assert commits.compact(spark, p["output"], ANSWER, rows_per_file=10**6) == 3
    assert answers(spark, p) == before
    folder = next(r["folder"] for r in commits.records(spark, p["output"]) if r["folder"])
    assert len(list((tmp_path / "output" / "_compacted" / folder.rsplit("/", 1)[1]).glob("*.parquet"))) == 1
    assert commits.expire(spark, p["output"]) == 3
    assert not (tmp_path / "output" / "run=a" / "batch_id=0").exists()
    assert answers(spark, p) == before
    send(1)  # replayed after it was compacted and expired
    assert answers(spark, p) == before
    send(3)
    send(0, run="b")  # another checkpoint begins at 0 again
    assert len(answers(spark, p)) == batch.where("cast(key AS long) % 6 < 4 ").count() + batch.where("cast(key AS long) % 6 = 0").count()
    assert commits.compact(spark, p["output"], ANSWER) == 2 and commits.compact(spark, p["output"], ANSWER) == 0
    rows = streams.read_batches(spark, p["output"], ANSWER).groupBy("run", "batch_id").count().collect()
    assert sorted((r["run"], r["batch_id"]) for r in rows) == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 0)]


def test_a_compaction_cut_off_half_way_is_not_read(spark, small_flows, tmp_path):
    p = paths(tmp_path)
    outputs = {p["output"]: lambda parsed: streams.predictions(flatten_events(parsed), rule, ABOUT)}
    streams.deliver(to_messages(small_flows), 0, outputs)
    half = streams.read_batches(spark, p["output"], ANSWER).limit(5)
    half.write.parquet(f"{p['output']}/_compacted/half")
    assert len(answers(spark, p)) == small_flows.count()


def test_records_count_rows_and_time(spark, small_flows, tmp_path):
    p = paths(tmp_path)
    messages = to_messages(small_flows).select("key", F.when(F.col("key") < "2", "{").otherwise(F.col("value")).alias("value"))
    messages.coalesce(1).write.parquet(p["input"])
    run(spark, p)
    (row,) = commits.batch_latency(spark, p["output"], p["quarantine"]).collect()
    assert (row["n_rows"], row["n_rejected"]) == (messages.count(), messages.where("key < '2'").count())
    assert row["millis"] > 0 and row["rows_per_second"] == pytest.approx(1000 * row["n_rows"] / row["millis"])


def test_positions_of_each_partition(spark):
    rows = [("t", 0, o, None) for o in (3, 4, 5, 9)] + [("t", 1, o, "bad") for o in (0, 0, 40_000)] + [("u", 0, 70_000, None)]
    messages = spark.createDataFrame([(*r[:3], r[3]) for r in rows], "topic string, partition int, offset long, error string")
    messages = messages.withColumn("time", F.timestamp_seconds("offset"))
    ends = positions.end_offsets(spark, json.dumps({"t": {"0": 10, "1": 50_000, "2": 7}, "u": {"0": 70_001}}))
    got = {(r["topic"], r["partition"]): r for r in positions.with_lag(positions.partition_report(messages), ends).collect()}
    wanted = ["n_messages", "n_rejected", "first_offset", "last_offset", "n_missing", "n_repeated", "lag"]
    assert [got["t", 0][c] for c in wanted] == [4, 0, 3, 9, 3, 0, 0]
    assert [got["t", 1][c] for c in wanted] == [3, 3, 0, 40_000, 39_999, 1, 9_999]
    assert [got["t", 2][c] for c in wanted] == [None, None, None, None, None, None, 7]
    assert [got["u", 0][c] for c in wanted] == [1, 0, 70_000, 70_000, 0, 0, 0]
    gaps = [(r["topic"], r["partition"], r["from_offset"], r["to_offset"], r["n_missing"]) for r in positions.gap_blocks(messages).collect()]
    assert gaps == [("t", 0, 3, 9, 3)]


def test_positions_survive_decoding(spark):
    good = json.dumps({"timestamp": "2026-01-12T18:00:05", "event_id": "e", "properties": {"src_port": 5}, "label": 1})
    rows = [("a", good, "t", 1, 5), ("b", "{", "t", 1, 6)]
    parsed = parse_messages(spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long"))
    for table, offset in ((flatten_events(parsed), 5), (rejected_messages(parsed), 6)):
        (row,) = table.collect()
        assert (row["topic"], row["partition"], row["offset"]) == ("t", 1, offset)


def test_checked_messages(spark):
    fine = {"src_port": 2000, "dst_port": 80, "protocol": "TCP", "packet_count": 3, "conn_state": "EST", "bytes_transferred": 5.0}
    now = "2026-01-12T18:00:05"
    cases = {
        "fine": {"timestamp": now, "properties": fine},
        "late": {"timestamp": "soon", "properties": fine},
        "none": {"properties": fine},
        "port": {"timestamp": now, "properties": {**fine, "src_port": 3}},
        "both": {"timestamp": "soon", "properties": {**fine, "packet_count": 0, "protocol": "GRE"}},
        "less": {"timestamp": now, "properties": {k: v for k, v in fine.items() if k != "dst_port"}},
    }
    rows = [(k, json.dumps(v)) for k, v in cases.items()] + [("cut", "{")]
    checked = streams.parse_and_check(spark.createDataFrame(rows, "key string, value string"))
    assert [r["key"] for r in flatten_events(checked).collect()] == ["fine"]
    errors = {r["key"]: r["error"] for r in rejected_messages(checked).collect()}
    assert errors == {
        "late": "unreadable time", "none": "unreadable time", "port": "invalid: src_port_range", "cut": "malformed JSON",
        "both": "invalid: packet_count_range,protocol_category", "less": "invalid: dst_port_required",
    }
