"""Encoders, scalers, artifacts, fitted feature sets and the preprocessing job."""

import json
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowlens.operators.encoders import (
    Encoders,
    Vocabulary,
    apply_encoders,
    encoder_table,
    fit_encoders,
    rank_values,
    value_counts,
)
from flowlens.operators import encoders as enc
from flowlens.operators.scalers import FALLBACK, POPULATION, apply_scaler, fit_scaler
from flowlens.plans.job import PreprocessJob, load_params
from flowlens.plans.preprocess import feature_set, load_fitted
from flowlens.schemas import MODEL_INPUTS, RICH_NUMERIC
from flowlens.session import session_conf
from flowlens.sources.artifact import artifact_json, load_artifact, parse_artifact, save_artifact

lists = st.lists(st.one_of(st.none(), st.text("abcXYZ é_", max_size=4)), min_size=1, max_size=30)
quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@quick
@given(lists, lists)
def test_encoder_is_sorted_and_total(spark, seen, new):
    df = spark.createDataFrame([(v,) for v in seen], "v string")
    fitted = fit_encoders(df, ["v"])
    expected = {v: i for i, v in enumerate(sorted({v for v in seen if v is not None}))}
    assert fitted.to_maps() == {"v": expected}
    other = spark.createDataFrame([(v,) for v in new], "v string")
    found = [(r["v"], r["v_idx"]) for r in apply_encoders(other, fitted).collect()]
    assert sorted(found, key=str) == sorted(((v, expected.get(v, -1)) for v in new), key=str)


def test_empty_vocabulary_gives_minus_one(spark):
    df = spark.createDataFrame([(None,), (None,)], "v string")
    assert [r["v_idx"] for r in apply_encoders(df, fit_encoders(df, ["v"])).collect()] == [-1, -1]


def test_in_place_keeps_column_order(spark):
    df = spark.createDataFrame([(1, "b", 2), (3, "a", 4)], "x int, v string, y int")
    out = apply_encoders(df, fit_encoders(df, ["v"]), in_place=True)
    assert out.columns == ["x", "v", "y"] and sorted(r["v"] for r in out.collect()) == [0, 1]


@pytest.mark.parametrize("broadcastable", [True, False])
def test_large_vocabulary_is_ranked_and_joined(spark, monkeypatch, broadcastable):
    """A third of all rows carry one value; it is looked up in place when the table is not known to be small."""
    if not broadcastable:
        monkeypatch.setattr(enc, "BROADCAST_VALUES", 10)
    values = [f"v{i:05d}" for i in range(2500)]
    rows = [(i, values[7] if i % 3 == 0 else values[i % 2500], "x") for i in range(7500)]
    df = spark.createDataFrame(rows, "id long, v string, w string").repartition(6)
    fitted = fit_encoders(df, ["v", "w"])
    assert fitted.columns["v"].table is not None and fitted.columns["w"].inline
    expected = {v: i for i, v in enumerate(sorted({r[1] for r in rows}))}
    other = df.unionByName(spark.createDataFrame([(-1, "new", None), (-2, None, "x")], df.schema))
    found = {r["id"]: (r["v_idx"], r["w_idx"]) for r in apply_encoders(other, fitted).collect()}
    assert found == {**{r[0]: (expected[r[1]], 0) for r in rows}, -1: (-1, -1), -2: (-1, 0)}
    assert encoder_table(fitted, df).count() == len(expected) + 1


def test_rank_by_frequency(spark):
    rows = [("a",)] * 2 + [("b",)] * 5 + [("c",)] * 2 + [("d",)]
    counts = value_counts(spark.createDataFrame(rows, "v string"), ["v"])
    found = {r["value"]: r["idx"] for r in rank_values(counts, "frequency").collect()}
    assert found == {"b": 0, "a": 1, "c": 2, "d": 3}


@quick
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40))
def test_scaler_matches_definition(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    sample = fit_scaler(df, ["x"])["x"]
    assert sample["mean"] == pytest.approx(statistics.fmean(values), abs=1e-6)
    deviation = statistics.stdev(values) if len(values) > 1 else 0.0
    if deviation > 1e-6 or deviation == 0.0 and len(set(values)) == 1:
        assert sample["std"] == pytest.approx(deviation or 1.0, rel=1e-6) or deviation == 0.0
    population = fit_scaler(df, ["x"], POPULATION)["x"]
    assert population["std"] > 0
    scaled = apply_scaler(df, {"x": population}, POPULATION).agg(F.avg("x_norm"), F.stddev_pop("x_norm")).first()
    if statistics.pstdev(values) > 1e-3:
        assert scaled[0] == pytest.approx(0, abs=1e-6) and scaled[1] == pytest.approx(1, abs=1e-6)


def test_constant_single_and_empty_columns(spark):
    df = spark.createDataFrame([(7.0, None), (7.0, None)], "c double, e double")
    assert fit_scaler(df, ["c"]) == {"c": {"mean": 7.0, "std": 1.0}}
    assert fit_scaler(df.limit(1), ["c"]) == {"c": {"mean": 7.0, "std": 1.0}}
    assert fit_scaler(df, ["c"], FALLBACK) == {"c": {"mean": 7.0, "std": 0.0}}
    assert fit_scaler(df, ["e"], POPULATION, fill=0.0) == {"e": {"mean": 0.0, "std": 1.0}}
    with pytest.raises(ValueError, match="'e'"):
        fit_scaler(df, ["e"])


def test_fallback_fills_after_statistics(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    stats = fit_scaler(df, ["x"], FALLBACK)
    assert stats["x"]["mean"] == 2.0
    found = [r["x_norm"] for r in apply_scaler(df, stats, FALLBACK, fill=0.0).collect()]
    assert found[2] == pytest.approx(-2.0 / (stats["x"]["std"] + 1e-6))


def test_artifact_format():
    encoders = Encoders({"p": Vocabulary(values=["A", "B"], size=2)})
    document = json.loads(artifact_json(encoders, {"x": {"mean": 1.5, "std": 2.0}}))
    assert document == {"encoders": {"p": {"A": 0, "B": 1}}, "scaler": {"x": {"mean": 1.5, "std": 2.0}}}
    again, stats = parse_artifact(json.dumps(document))
    assert again.to_maps() == encoders.to_maps() and stats == document["scaler"]


def test_artifact_with_table(spark, tmp_path):
    df = spark.createDataFrame([(f"é\n{i:03d}",) for i in range(30)], "v string")
    fitted = fit_encoders(df, ["v"], inline_limit=10)
    for _ in range(2):
        save_artifact(spark, str(tmp_path / "a"), fitted, {})
    encoders, _ = load_artifact(spark, str(tmp_path / "a"))
    found = {r["v"]: r["v_idx"] for r in apply_encoders(df, encoders).collect()}
    assert found == {f"é\n{i:03d}": i for i in range(30)}


def test_no_leakage_and_subset_consistency(spark, small_flows):
    train = small_flows.where("split = 'train'")
    fitted = feature_set("deployed").fit(train)
    everything = fitted.transform(small_flows, keep=("flow_id",))
    part = fitted.transform(small_flows.where("split = 'test'"), keep=("flow_id",))
    assert part.exceptAll(everything).count() == 0
    assert everything.columns == ["flow_id", *MODEL_INPUTS, "attack"]
    kinds = dict(everything.dtypes)
    assert {kinds[c] for c in MODEL_INPUTS if c.endswith("_idx")} == {"int"}
    assert {kinds[c] for c in MODEL_INPUTS if c.endswith("_norm")} == {"double"}
    assert "attack" not in fitted.transform(small_flows.drop("attack")).columns


def test_missing_statistics_pass_unscaled_and_nulls_are_filled(spark, small_flows):
    fitted = feature_set("deployed").fit(small_flows)
    del fitted.stats["packet_count"]
    broken = small_flows.withColumn("bytes_transferred", F.lit(None).cast("double"))
    served = fitted.transform_for_inference(broken, keep=("packet_count",))
    row = served.first()
    assert row["packet_count_norm"] == row["packet_count"]
    assert row["bytes_log_norm"] == 0.0 and "attack" not in served.columns


def test_rich_fit_transform_equals_fit_then_transform(spark, small_flows):
    rich = feature_set("rich_sessions")
    fitted, out = rich.fit_transform(small_flows, keep=("flow_id",))
    again = rich.fit(small_flows).transform(small_flows, keep=("flow_id",))
    names = [f"{c}_norm" for c in RICH_NUMERIC]
    rounded = lambda df: df.select("flow_id", *[F.round(c, 6).alias(c) for c in names])
    assert rounded(out).exceptAll(rounded(again)).count() == 0
    sums = out.agg(*[F.avg(c) for c in names]).first()
    assert all(abs(v) < 1e-6 for v in sums)


def test_unknown_feature_set():
    with pytest.raises(ValueError, match="deployed"):
        feature_set("nope")


@pytest.mark.parametrize("name", ["deployed", "rich_sessions"])
def test_job_writes_all_splits_and_reloads_the_artifact(spark, small_flows, tmp_path, name):
    raw, out, artifact = (str(tmp_path / d) for d in ("raw", "out", "artifact"))
    for split in ("train", "val", "test"):
        small_flows.where(F.col("split") == split).drop("split", "flow_id").write.parquet(f"{raw}/{split}")
    paths = PreprocessJob(spark, raw, out, artifact, name).run()
    assert {s: spark.read.parquet(p).count() for s, p in paths.items()} == {
        s: small_flows.where(F.col("split") == s).count() for s in ("train", "val", "test")
    }
    first = spark.read.parquet(paths["val"])
    params = {"app_name": "job", "features": name, "write_batch_size": 50, "read_batch_size": 128}
    later = PreprocessJob.from_params(params, raw, f"{out}2", artifact)
    second = spark.read.parquet(later.run_split("val"))
    if name == "deployed":
        assert first.exceptAll(second).count() == 0
    assert first.columns == second.columns


def test_load_fitted_equals_fitted(spark, small_flows, tmp_path):
    fitted = feature_set("deployed").fit(small_flows)
    fitted.save(spark, str(tmp_path / "a"))
    loaded = load_fitted(spark, str(tmp_path / "a"))
    assert loaded.stats == fitted.stats
    assert fitted.transform(small_flows).exceptAll(loaded.transform(small_flows)).count() == 0


def test_params_and_session_settings(tmp_path):
    (tmp_path / "p.yaml").write_text("spark:\n  read_batch_size: 512\n  features: deployed\n")
    params = load_params(str(tmp_path / "p.yaml"))["spark"]
    conf = session_conf(params["read_batch_size"], object_store=True, access_key="a", secret_key="b")
    assert conf["spark.sql.files.maxPartitionBytes"] == str(512 * 1024 * 1024)
    assert conf["spark.hadoop.fs.s3a.committer.name"] == "magic"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "a"
    assert not any("s3a" in k for k in session_conf())
    (tmp_path / "p.json").write_text('{"a": 1}')
    assert load_params(str(tmp_path / "p.json")) == {"a": 1}


def test_hot_values_are_not_shuffled(spark):
    """A third of the rows hold one known value, some one unknown value, many none: no task of the join gets more than its share."""
    from flowlens.operators.encoders import Vocabulary, hot_values, index_by_join

    values = [("hot" if i % 3 == 0 else "foreign" if i % 3 == 1 and i < 1500 else None if i % 30 == 2 else f"v{i % 700}") for i in range(6000)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string").repartition(4)
    known = sorted({v for v in values if v and v != "foreign"})
    table = spark.createDataFrame([(v, i) for i, v in enumerate(known)], "value string, idx int")
    assert set(hot_values(df, "v", least=400)) == {"hot", "foreign"}
    vocabulary = Vocabulary(table=table, size=10**9, bytes=10**12)
    indexed = index_by_join(df, "v", vocabulary, "v_idx", least=400)
    place = {v: i for i, v in enumerate(known)}
    assert {r["id"]: r["v_idx"] for r in indexed.collect()} == {i: place.get(v, -1) for i, v in enumerate(values)}
    left = df.where(~F.coalesce(F.col("v").isin("hot", "foreign"), F.lit(True)))
    shares = left.repartition(8, "v").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in shares) < 2.5 * left.count() / 8
    assert hot_values(df.limit(0), "v") == []
