"""Validation, samples, rules, drift, requests, evaluation and the run log on small frames."""

import collections
import hashlib
import json
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.functions.hashing import in_share
from flowlens.functions.rules import concept_scores, first_argmax, normal_scores, softmax
from flowlens.operators import drift, evaluate, payloads, profile, sampling, validate
from flowlens.plans.tracking import Run, RunLog, metric_dict, numeric_metrics, report_text
from flowlens.schemas import CONN_STATES, EVENT_PROPERTIES, MODEL_INPUTS, PROTOCOLS

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
FLOW = "src_port long, dst_port long, protocol string, packet_count long, conn_state string, bytes_transferred double"


# --- validation ---------------------------------------------------------------------------------


def test_contract(spark):
    df = spark.createDataFrame([tuple([1.0] * 15)], ", ".join(f"{c} double" for c in [*MODEL_INPUTS, "attack"]))
    assert validate.missing_columns(df) == []
    assert validate.require_contract(df) is df
    with pytest.raises(ValueError, match="hour_norm"):
        validate.require_contract(df.drop("hour_norm"))
    report = {r["column_name"]: (r["present"], r["n_rows"], r["n_null"]) for r in validate.contract_report(df.drop("attack")).collect()}
    assert report["attack"] == (False, 1, 1) and report["hour_norm"] == (True, 1, 0)


def test_rules_and_split(spark):
    rows = [
        (1024, 1, "TCP", 1, "EST", 0.0),
        (65535, 65535, "ICMP", 2000, "RST", 2e6),
        (1023, 0, "GRE", 2001, "S0", -0.5),
        (None, None, None, None, None, None),
    ]
    checked = validate.validate_records(spark.createDataFrame(rows, FLOW))
    found = [set(r["violations"]) for r in checked.collect()]
    assert found[0] == set() and found[1] == set()
    assert found[2] == {
        "src_port_range", "dst_port_range", "packet_count_range", "bytes_transferred_range",
        "protocol_category", "conn_state_category",
    }
    assert found[3] == {f"{c}_required" for c in EVENT_PROPERTIES.fieldNames()}
    assert validate.valid_records(checked).count() == 2 and validate.quarantined_records(checked).count() == 2
    summary = {r["rule"]: r["n"] for r in validate.validation_summary(checked).collect()}
    assert summary["valid"] == 2 and summary["protocol_category"] == 1 and len(summary) == 13


# --- samples ------------------------------------------------------------------------------------


def digest(seed, key):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.3, 1.0])
def test_stratified_sample_is_exact(spark, fraction):
    """One class holds most rows, one only three, one is null; some rows are copies of others."""
    rng = random.Random(1)
    rows = [(i, rng.choice([0] * 30 + [1, None]), i % 4) for i in range(3000)] + [(9000 + i, 7, 0) for i in range(3)]
    rows += [(1, 5, 0)] * 400
    df = spark.createDataFrame(rows, "id long, label long, x int")
    found = [tuple(r) for r in sampling.stratified_sample(df, "label", fraction, "id", 9).collect()]
    expected = []
    for label in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == label), key=lambda r: (digest(9, r[0]), r[0]))
        quota = max(min(len(members), 5), math.floor(len(members) * fraction))
        expected += members[:quota]
    assert collections.Counter(found) == collections.Counter(expected)


@pytest.mark.parametrize("digits,cut_rows", [(1, 5), (1, 100), (3, 2)])
def test_radix_selection_gives_the_same_sample(spark, digits, cut_rows):
    """Few digits a round and small tasks: more rounds, the same rows. The id with 400 copies can't be told apart by any digit."""
    rows = [(i, 0 if i % 9 else 1, i % 4) for i in range(3000)] + [(1, 5, 0)] * 400
    df = spark.createDataFrame(rows, "id long, label long, x int").repartition(3)
    sample = lambda **options: collections.Counter(map(tuple, sampling.stratified_sample(df, "label", 0.3, "id", 9, **options).collect()))
    assert sample(digits=digits, cut_rows=cut_rows) == sample()
    unlike = df.where("label <> 5").withColumn("_hash", F.md5(F.concat(F.lit("9|"), F.col("id").cast("string"))))
    cuts, rounds = sampling.find_cuts(unlike, "label", 0.3, digits, cut_rows)
    assert cuts.agg(F.max("_n")).first()[0] <= cut_rows
    assert rounds == (1 if digits == 3 and cut_rows > 5 else rounds) and 1 <= rounds <= 5
    assert sampling.find_cuts(unlike, "label", 0.3, 4, 10**6)[1] == 1


def test_sample_of_no_rows(spark):
    assert sampling.stratified_sample(spark.createDataFrame([], "id long, label long"), "label", 0.5, "id").collect() == []


def test_share_sample(spark):
    df = spark.range(2000)
    found = {r["id"] for r in sampling.share_sample(df, 0.25, "id", 3).collect()}
    assert found == {i for i in range(2000) if digest(3, i)[:8] < "40000000"}
    assert found == {r["id"] for r in sampling.share_sample(df.repartition(7), 0.25, "id", 3).collect()}
    for whole in (None, 0.0, -1.0, 1.0, 2.0):
        assert sampling.share_sample(df, whole, "id") is df
    assert 300 < sampling.share_sample(df, 0.25, seed=3).count() < 700
    assert df.where(in_share(1, F.col("id"), 1.5)).count() == 2000
    assert df.where(in_share(1, F.col("id"), -0.5)).count() == 0


def test_row_cap(spark):
    df = spark.range(100)
    assert [r["id"] for r in sampling.row_cap(df, 3, ["id"]).collect()] == [0, 1, 2]
    assert sampling.row_cap(df, 0) is df and sampling.row_cap(df, 7).count() == 7


# --- rules --------------------------------------------------------------------------------------


# Worked out by hand from the weights: (flow, concept scores, normal scores or None), classes in label order.
WORKED = [
    (  # half of every scale
        (65535, 65535, "UDP", 1000, "EST", 1e6),
        [0.74, 1.85, 0.0, 0.0, 0.6, 2.2],
        [0.8, 1.3163110032, 0.45, -1.65, -0.05, 1.3],
    ),
    (  # a probe of a service port by ICMP with many packets
        (13107, 80, "ICMP", 1600, "EST", 2e5),
        [0.66, 0.96, 4.0, 3.0, 2.12, 24 / 65535],
        None,
    ),
    (  # on the thresholds, which do not count as passed
        (32200, 65535, "UDP", 400, "EST", 1e5),
        [0.71, 0.14, 0.0, 0.0, 0.06, 48300 / 65535],
        None,
    ),
    (  # nothing sent
        (0, 65535, "ICMP", 0, "RST", 0.0),
        [0.66, 0.8, 3.0, 2.0, 0.0, 0.0],
        [0.4, 1.4336889968, 0.3, 3.0, 0.0, 0.0],
    ),
]


flow_rows = st.tuples(
    st.integers(1024, 65535),
    st.one_of(st.sampled_from([21, 22, 80, 443]), st.integers(1, 65535)),
    st.sampled_from(PROTOCOLS),
    st.integers(1, 2000),
    st.sampled_from(CONN_STATES),
    st.floats(0, 2e6),
)


def test_rule_scores(spark):
    assert (PROTOCOLS[1], PROTOCOLS[2], CONN_STATES[0], CONN_STATES[3]) == ("UDP", "ICMP", "EST", "RST")
    df = spark.createDataFrame([flow for flow, _, _ in WORKED], FLOW).coalesce(1)
    found = df.select(F.array(*concept_scores()).alias("c"), F.array(*normal_scores()).alias("n")).collect()
    for (_, concept, normal), r in zip(WORKED, found):
        assert r["c"] == pytest.approx(concept, abs=1e-9)
        assert normal is None or r["n"] == pytest.approx(normal, abs=1e-9)


@quick
@given(st.lists(flow_rows, min_size=1, max_size=20))
def test_more_bytes_never_lower_what_they_speak_for(spark, rows):
    dos, u2r = concept_scores()[1], concept_scores()[4]
    df = spark.createDataFrame(rows, FLOW)
    pair = F.struct(dos.alias("dos"), u2r.alias("u2r"))
    more = df.select("*", pair.alias("low")).withColumn("bytes_transferred", F.col("bytes_transferred") + 1000.0)
    worse = more.select("low", pair.alias("high")).where("high.dos < low.dos OR high.u2r < low.u2r")
    assert worse.count() == 0


def test_argmax_and_softmax(spark):
    rows = [([1.0, 3.0, 3.0],), ([5.0, 1.0, 5.0],), ([None, 1.0, 0.0],), ([900.0, 0.0, 900.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    out = df.select(first_argmax(F.col("v")).alias("a"), softmax(F.col("v")).alias("s")).collect()
    assert [r["a"] for r in out] == [1, 0, None, 0]
    assert out[3]["s"] == pytest.approx([0.5, 0.0, 0.5])
    assert sum(out[0]["s"]) == pytest.approx(1.0)


def test_noise_is_seeded_and_drawn_once(spark, small_flows):
    first = drift.relabel(small_flows, noise=0.05, seed=4).select("flow_id", "attack")
    second = drift.relabel(small_flows, noise=0.05, seed=4).select("flow_id", "attack")
    assert first.where("attack IS NULL").count() == 0
    assert first.exceptAll(second).count() == 0
    changed = drift.relabel(small_flows).select("flow_id", "attack").exceptAll(first).count()
    assert 0 < changed < small_flows.count() / 4


def test_random_shift_spreads_and_stays_in_domain(spark, small_flows):
    moved = drift.shift_random(small_flows, seed=2).select(
        "flow_id", F.col("packet_count").alias("p"), F.col("bytes_transferred").alias("b")
    )
    both = small_flows.join(moved, "flow_id").where("packet_count BETWEEN 400 AND 1600")
    row = both.agg(
        F.stddev(F.col("p") - F.col("packet_count")).alias("packets"),
        F.stddev(F.log(F.col("b") / F.col("bytes_transferred"))).alias("bytes"),
    ).first()
    assert 70 < row["packets"] < 90 and 0.17 < row["bytes"] < 0.23
    outside = ~F.col("p").between(1, 2000) | ~F.col("b").between(0, 2e6)
    assert moved.where(outside).count() == 0


def test_scenarios_triple_every_row(spark, small_flows):
    rows = drift.scenarios(small_flows)
    assert {r["scenario"]: r["count"] for r in rows.groupBy("scenario").count().collect()} == dict.fromkeys(
        ("normal", "data_drift", "concept_drift"), small_flows.count()
    )
    assert set(rows.columns) == {*small_flows.columns, "scenario"}


# --- requests -----------------------------------------------------------------------------------

ROW = {"src_port": 5000, "dst_port": 80, "protocol": "tcp", "packet_count": 3, "conn_state": "S0", "bytes_transferred": 9.5}


def test_request_shapes(spark):
    bodies = {
        "object": json.dumps({"data": ROW}),
        "list": json.dumps({"data": [ROW, {**ROW, "src_port": 6000}]}),
        "spaced": '  { "data" : [ ] } ',
        "missing": json.dumps({"rows": ROW}),
        "null": '{"data": null}',
        "text": '{"data": "x"}',
        "number": '{"data": 5}',
        "numbers": '{"data": [1, 2]}',
        "mixed": json.dumps({"data": [ROW, 3]}),
        "brace": '{"data": "{oops"}',
        "array": json.dumps([ROW]),
        "broken": '{"data": {"src_port": 1',
        "empty": "",
        "none": None,
    }
    df = spark.createDataFrame(list(bodies.items()), "id string, body string")
    opened = payloads.open_requests(df)
    errors = {r["id"]: r["error"] for r in payloads.request_errors(opened, ["id"]).collect()}
    assert errors == {
        "missing": payloads.NO_DATA,
        "null": payloads.NO_DATA,
        "text": payloads.BAD_DATA,
        "number": payloads.BAD_DATA,
        "numbers": payloads.BAD_DATA,
        "mixed": payloads.BAD_DATA,
        "brace": payloads.BAD_DATA,
        "array": payloads.NOT_AN_OBJECT,
        "broken": payloads.NOT_AN_OBJECT,
        "empty": payloads.NOT_AN_OBJECT,
        "none": payloads.NOT_AN_OBJECT,
    }
    rows = payloads.request_rows(opened, EVENT_PROPERTIES, ["id"]).collect()
    assert [(r["id"], r["position"], r["src_port"]) for r in rows] == [
        ("object", 0, 5000),
        ("list", 0, 5000),
        ("list", 1, 6000),
    ]
    empty = [r["id"] for r in payloads.empty_requests(opened, ["id"]).collect()]
    assert empty == ["spaced"]
    assert sorted([*errors, *{r["id"] for r in rows}, *empty]) == sorted(bodies)
    assert rows[0]["bytes_transferred"] == 9.5 and rows[0]["protocol"] == "tcp"


def port_scorer(label):
    def score(df):
        shares = F.array(F.col("src_port") / 1e6, F.lit(label) * 1.0)
        return df.withColumns({"prediction": F.col("src_port").cast("long"), "probabilities": shares})

    return score


@pytest.mark.parametrize("part_rows", [1, 7, 10_000])
def test_every_request_has_one_answer(spark, part_rows):
    """Rows keep their order through many parts; errors and empty lists are answered; equal ids are answered apart."""
    long = [{**ROW, "src_port": 9000 - i} for i in range(50)]
    bodies = [
        ("one", {"data": ROW}), ("long", {"data": long}), ("empty", {"data": []}), ("wrong", {"data": 5}), ("gone", {"rows": []}),
        ("twice", {"data": [ROW]}), ("twice", {"data": [ROW, ROW]}), (None, {"data": ROW}), ("odd", {"data": {"src_port": "77", "protocol": 5}}),
        ("unreadable", {"data": {"src_port": "x"}}),
    ]
    df = spark.createDataFrame([(i, json.dumps(b)) for i, b in bodies], "request_id string, body string").repartition(3)
    scorers = {"stable": port_scorer(0), "canary": port_scorer(1)}
    keys = {"stable": "s", "canary": "c"}
    answers = payloads.serve_requests(df, EVENT_PROPERTIES, scorers, "rule", keys, probability=0.5, part_rows=part_rows).collect()
    assert len(answers) == len(bodies)
    found = {}
    for a in answers:
        found.setdefault(a["request_id"], []).append(a)
    assert found["long"][0]["predictions"] == [r["src_port"] for r in long]
    assert [p[0] for p in found["long"][0]["probabilities"]] == [r["src_port"] / 1e6 for r in long]
    assert len({p[1] for p in found["long"][0]["probabilities"]}) == 1
    assert (found["empty"][0]["predictions"], found["empty"][0]["probabilities"], found["empty"][0]["error"]) == ([], [], None)
    assert sorted(len(a["predictions"]) for a in found["twice"]) == [1, 2]
    assert found["odd"][0]["predictions"] == [77] and found["unreadable"][0]["predictions"] == [None]
    for key, error in (("wrong", payloads.BAD_DATA), ("gone", payloads.NO_DATA)):
        (a,) = found[key]
        assert a["error"] == error and a["predictions"] is a["probabilities"] is a["model"] is None
    for a in answers:
        if a["error"] is None:
            assert a["model"]["framework"] == "rule" and a["model"]["model_key"] == a["model"]["variant"][0]
            assert all(p[1] == (a["model"]["variant"] == "canary") for p in a["probabilities"])


@pytest.mark.parametrize("probability,low,high", [(0.0, 0, 0), (None, 0, 0), (-3, 0, 0), (0.3, 240, 360), (1.0, 1000, 1000), (9, 1000, 1000)])
def test_canary_share(spark, probability, low, high):
    df = spark.range(1000)
    routed = payloads.with_variant(df, "id", payloads.canary_share(probability))
    assert low <= routed.where("variant = 'canary'").count() <= high


# --- evaluation ---------------------------------------------------------------------------------

pairs = st.lists(st.tuples(st.integers(-1, 6), st.integers(-1, 6)), max_size=60)


@quick
@given(pairs)
def test_metrics_match_definitions(spark, rows):
    df = spark.createDataFrame(rows, "attack long, prediction long")
    inside = [(t, p) for t, p in rows if 0 <= t <= 5 and 0 <= p <= 5]
    cells = collections.Counter(inside)
    confusion = evaluate.confusion_matrix(df)
    assert {(r["label"], r["prediction"]): r["n"] for r in confusion.collect()} == {
        (t, p): cells[t, p] for t in range(6) for p in range(6)
    }
    assert evaluate.as_array(confusion).first()["matrix"] == [[cells[t, p] for p in range(6)] for t in range(6)]
    scores = {}
    for c in range(6):
        support, predicted = sum(t == c for t, _ in inside), sum(p == c for _, p in inside)
        precision, recall = cells[c, c] / max(predicted, 1), cells[c, c] / max(support, 1)
        scores[c] = (precision, recall, 2 * precision * recall / max(precision + recall, 1e-12), support)
    per_class = evaluate.class_metrics(confusion)
    found = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in per_class.collect()}
    assert {c: pytest.approx(v) for c, v in scores.items()} == found
    summary = metric_dict(evaluate.summary_metrics(per_class).collect())
    total = max(len(inside), 1)
    assert summary["accuracy"] == pytest.approx(sum(cells[c, c] for c in range(6)) / total)
    for i, s in enumerate(("precision", "recall", "f1")):
        assert summary[f"{s}_macro"] == summary[f"{s}_avg"] == pytest.approx(sum(v[i] for v in scores.values()) / 6)
        assert summary[f"{s}_weighted"] == pytest.approx(sum(v[i] * v[3] for v in scores.values()) / total)


def test_weighted_scores_agree_with_the_built_in_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rng = random.Random(3)
    rows = [(float(rng.randrange(6)), float(rng.randrange(6))) for _ in range(300)]
    df = spark.createDataFrame(rows, "attack double, prediction double")
    summary = metric_dict(evaluate.summary_metrics(evaluate.class_metrics(evaluate.confusion_matrix(df))).collect())
    for ours, theirs in (("precision_weighted", "weightedPrecision"), ("recall_weighted", "weightedRecall"), ("f1_weighted", "f1"), ("accuracy", "accuracy")):
        built_in = MulticlassClassificationEvaluator(labelCol="attack", metricName=theirs).evaluate(df)
        assert summary[ours] == pytest.approx(built_in)


def test_log_loss_agrees_with_the_built_in_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.functions import array_to_vector

    rows = [(0.0, [0.7, 0.2, 0.1]), (2.0, [0.1, 0.1, 0.8]), (1.0, [0.5, 0.0, 0.5])]
    df = spark.createDataFrame(rows, "attack double, p array<double>").withColumn("prediction", F.lit(0.0))
    ours = evaluate.log_loss(df.withColumn("attack", F.col("attack").cast("long")), "attack", "p").first()[0]
    evaluator = MulticlassClassificationEvaluator(labelCol="attack", probabilityCol="v", metricName="logLoss")
    assert ours == pytest.approx(evaluator.evaluate(df.withColumn("v", array_to_vector("p"))))


def test_report_and_normalised_matrix(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "attack long, prediction long")
    confusion = evaluate.confusion_matrix(df)
    report = {r["row"]: r for r in evaluate.classification_report(evaluate.class_metrics(confusion)).collect()}
    assert list(report["DoS"])[1:] == [0.5, 1.0, 0.6667, 1]
    assert report["accuracy"]["f1"] == 0.6667 and report["accuracy"]["precision"] is None
    assert report["Worm"]["support"] == 0 and len(report) == 9
    normal = {(r["label"], r["prediction"]): r for r in evaluate.confusion_normalised(confusion).collect()}
    assert normal[0, 1]["share"] == 0.5 and normal[0, 1]["cell_text"] == "1\n50.0%"
    assert normal[5, 5]["share"] == 0.0
    text = report_text(report.values())
    assert "macro avg" in text and len(text.splitlines()) == 10


def test_profiles(spark, small_flows):
    shares = profile.class_distribution(small_flows).collect()
    assert sum(r["share"] for r in shares) == pytest.approx(1.0) and {r["name"] for r in shares} >= {"Normal", "DoS"}
    shape = {r["split"]: r["n_columns"] for r in profile.split_profile(small_flows).collect()}
    assert shape == {"train": 9, "val": 9, "test": 9}


# --- run log ------------------------------------------------------------------------------------


def test_run_log(spark, tmp_path):
    assert numeric_metrics({"a": 1, "b": 2.5, "c": True, "d": "x", "e": [1]}) == {"a": 1.0, "b": 2.5}
    log = RunLog(spark, str(tmp_path))
    log.log(Run("first", "gbt", {"depth": 6}, {"loss": 0.5, "ok": True}, {"report.txt": "a\nb"}))
    log.log(Run("second", "mlp", {}, {"loss": 0.4}), Run("third", "mlp", {}, {"loss": 0.4}))
    assert log.table("runs").count() == 3
    assert {(r["key"], r["value"]) for r in log.table("params").where("value <> 'mlp'").collect()} == {("framework", "gbt"), ("depth", "6")}
    assert log.table("artifacts").first()["content"] == "a\nb"
    assert log.best_run("loss").first()["name"] == "second"
    assert log.best_run("loss", lowest=False).first()["name"] == "first"
