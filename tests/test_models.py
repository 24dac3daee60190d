"""Training, tuning and scoring on rule-labelled flows."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import drift
from flowlens.operators.batch_score import score_batches
from flowlens.plans import boosting, class_trees, training, tuning
from flowlens.plans.job import PreprocessJob, TrainingJob
from flowlens.plans.preprocess import feature_set
from flowlens.plans.tracking import RunLog, metric_dict


@pytest.fixture(scope="module")
def parts(spark, small_flows):
    """Processed splits whose classes follow the concept rule, so there is something to learn."""
    labelled = drift.relabel(small_flows)
    fitted = feature_set("deployed").fit(labelled.where("split = 'train'"))
    return {s: fitted.transform(labelled.where(F.col("split") == s)).cache() for s in ("train", "val", "test")}


def accuracy(model, df):
    return model.score(df).agg(F.avg((F.col("prediction") == F.col("attack")).cast("double"))).first()[0]


def majority(df):
    counts = [r["count"] for r in df.groupBy("attack").count().collect()]
    return max(counts) / sum(counts)


@pytest.fixture(scope="module")
def boosted(parts):
    return training.fit_model(parts["train"], "gbt", {"num_boost_round": 5, "max_depth": 4})


# A few hundred rows teach the network little that carries over, so it is judged on what it saw.
@pytest.mark.parametrize("framework,split", [("mlp", "train"), ("forest", "test")])
def test_models_beat_the_majority_class(parts, framework, split):
    model = training.fit_model(parts["train"], framework)
    assert accuracy(model, parts[split]) > majority(parts[split]) + 0.1


def test_boosted_trees(spark, parts, boosted, tmp_path):
    assert accuracy(boosted, parts["test"]) > majority(parts["test"]) + 0.2
    scored = boosted.score(parts["test"])
    assert scored.columns == [*parts["test"].columns, "prediction", "probabilities"]
    for r in scored.collect():
        assert len(r["probabilities"]) == 6 and sum(r["probabilities"]) == pytest.approx(1.0)
        assert r["probabilities"][r["prediction"]] == max(r["probabilities"])
    boosted.save(spark, str(tmp_path / "m"))
    loaded = training.FlowModel.load(spark, str(tmp_path / "m"))
    assert loaded.inputs == boosted.inputs and loaded.params == boosted.params
    assert loaded.score(parts["test"]).exceptAll(scored).count() == 0


def test_scoring_keeps_input_columns(parts, boosted):
    holes = parts["test"].withColumn("hour_norm", F.lit(None).cast("double"))
    row = boosted.score(holes).first()
    assert row["hour_norm"] is None and row["prediction"] is not None


def test_progress_falls(parts, boosted):
    rows = training.boosting_progress(boosted, parts["train"]).collect()
    assert len(rows) == 6 * 5
    for c in range(6):
        losses = [r["loss"] for r in rows if r["class"] == c]
        assert losses[-1] <= losses[0]


def test_absent_class_is_padded(parts):
    few = parts["train"].where("attack < 4")
    model = training.fit_model(few, "forest")
    row = model.score(parts["test"]).first()
    assert len(row["probabilities"]) == 6 and row["probabilities"][4:] == [0.0, 0.0]


def test_train_reports_both_splits(parts):
    result = training.train(parts["train"], parts["val"], parts["test"], "forest")
    metrics = metric_dict(result.metrics.collect())
    for split in ("val", "test"):
        assert metrics[f"{split}_log_loss"] > 0
        assert metrics[f"{split}_accuracy"] == pytest.approx(1 - metrics[f"{split}_error_rate"])
        assert {f"{split}_{s}_class_{c}" for s in ("precision", "recall", "f1", "support") for c in range(6)} <= set(metrics)
    assert result.seconds["fit_seconds"] > 0
    with pytest.raises(ValueError, match="hour_norm"):
        training.train(parts["train"], parts["val"].drop("hour_norm"), parts["test"], "forest")
    with pytest.raises(ValueError, match="unknown framework"):
        training.fit_model(parts["train"], "svm")


def test_binary_scores(spark):
    df = spark.createDataFrame([(0.4,), (0.5,), (0.6,)], "p double")
    assert [r["prediction"] for r in training.binary_scores(df, "p").collect()] == [0, 0, 1]


def test_draws_are_seeded_and_in_range():
    a, b = tuning.draw_params("gbt", 50, 1), tuning.draw_params("gbt", 50, 1)
    assert a == b != tuning.draw_params("gbt", 50, 2)
    assert {p["max_depth"] for p in a} <= set(range(3, 11)) and {p["min_child_weight"] for p in a} <= {1, 2, 3}
    assert all(0.5 <= p["subsample"] <= 1 and 1e-4 <= p["eta"] <= 0.3 for p in a)
    assert {p["batch_size"] for p in tuning.draw_params("mlp", 50, 1)} == {64, 128, 256}


def test_random_search_and_final_params(parts):
    trials = tuning.random_search(parts["train"], parts["val"], "mlp", trials=2)
    assert [t.number for t in trials] == [0, 1] and all(t.rounds == 10 for t in trials)
    winner = tuning.best(trials)
    assert winner.loss == min(t.loss for t in trials)
    assert tuning.final_params("mlp", winner)["max_epochs"] == 10
    again = tuning.random_search(parts["train"], parts["val"], "mlp", trials=2)
    assert [t.params for t in again] == [t.params for t in trials]


def test_halving_keeps_the_better_half(parts):
    trials = tuning.halving_search(parts["train"], parts["val"], "mlp", trials=4)
    first, second = [t for t in trials if t.rounds == 5], [t for t in trials if t.rounds == 10]
    assert len(first) == 4 and len(second) == 2
    kept = {t.number for t in sorted(first, key=lambda t: t.loss)[:2]}
    assert {t.number for t in second} == kept


def test_rows_to_judge_or_score_are_spread(spark, sf_dir, parts, monkeypatch):
    """However few splits they are read from, every core gets some of them."""
    from flowlens.catalog import queries

    seen = []

    class Even:
        classes = 6

        def score(self, df):
            seen.append(df.rdd.getNumPartitions())
            return df.withColumn("prediction", F.lit(0)).withColumn("probabilities", F.array_repeat(F.lit(1 / 6), 6))

    monkeypatch.setattr(training, "fit_model", lambda *args, **options: Even())
    one = {k: df.coalesce(1) for k, df in parts.items()}
    training.train(one["train"], one["val"], one["test"], "mlp", partitions=7)
    rows = queries.score_batch(spark, sf_dir)
    assert seen == [7, spark.sparkContext.defaultParallelism]
    assert rows.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    both = tuning.tuning_data(spark.range(100).coalesce(1), spark.range(50).coalesce(1), None, 1, partitions=5)
    assert [df.rdd.getNumPartitions() for df in both] == [5, 5]


def test_tuning_data_caps(spark):
    a, b = tuning.tuning_data(spark.range(100), spark.range(50), None, 1, max_train_rows=10, max_val_rows=5)
    assert (a.count(), b.count()) == (10, 5)


def test_materialised_is_released(spark):
    df = spark.range(10)
    with training.materialised(df) as (kept,):
        assert kept.storageLevel.useDisk and kept.storageLevel.useMemory
    assert not df.storageLevel.useMemory


def test_training_job(spark, parts, tmp_path):
    for split, df in parts.items():
        df.write.parquet(str(tmp_path / "processed" / split))
    job = TrainingJob(spark, str(tmp_path / "processed"), str(tmp_path / "out"), "forest", partitions=4)
    result = job.run()
    assert result.seconds["evaluate_seconds"] > 0
    loaded = training.FlowModel.load(spark, str(tmp_path / "out" / "model_forest"))
    assert accuracy(loaded, parts["test"]) == pytest.approx(accuracy(result.model, parts["test"]))
    logged = RunLog(spark, str(tmp_path / "out" / "runs")).run_metrics()
    assert logged.where("key IN ('test_accuracy', 'fit_seconds')").count() == 2
    files = {r["path"]: r["content"] for r in RunLog(spark, str(tmp_path / "out" / "runs")).table("artifacts").collect()}
    matrix = json.loads(files["evaluation/test_confusion_matrix.json"])
    assert len(matrix) == 6 and sum(map(sum, matrix)) == parts["test"].count()
    assert "weighted avg" in files["evaluation/val_classification_report.txt"]


def test_training_job_with_search(spark, parts, tmp_path):
    for split, df in parts.items():
        df.write.parquet(str(tmp_path / "processed" / split))
    job = TrainingJob(spark, str(tmp_path / "processed"), str(tmp_path / "out"), "mlp", True, 0.5, 1, 4)
    params = job.run().model.params
    drawn = tuning.draw_params("mlp", 1, 42)[0]
    assert params == {**training.MLP_PARAMS, **drawn}


def test_training_job_from_parameters(spark, parts, tmp_path):
    """Search, target and caps come from the file; every trial is logged, and the best one can be found."""
    for split, df in parts.items():
        df.withColumnRenamed("attack", "kind").write.parquet(str(tmp_path / "processed" / split))
    model = {"target": "kind", "num_classes": 6, "framework": "mlp", "seed": 7, "tune": True, "trials": 2}
    params = {"model": {**model, "search": "halving", "max_train_rows": 200, "max_val_rows": 50}}
    job = TrainingJob.from_params(spark, params, str(tmp_path / "processed"), str(tmp_path / "out"))
    assert (job.target, job.seed, job.search, job.max_train_rows) == ("kind", 7, "halving", 200)
    job.run()
    log = RunLog(spark, str(tmp_path / "out" / "runs"))
    names = {r["name"] for r in log.table("runs").collect()}
    assert "mlp_final" in names and len(names) == 4 and log.best_run("trial_val_log_loss").first()["name"] in names
    assert log.table("params").where("key = 'target' AND value = 'kind'").count() == 4


def test_labels_that_are_no_class_are_left_out(parts, boosted):
    dirty = parts["val"].unionByName(parts["val"].withColumn("attack", F.lit(99).cast(dict(parts["val"].dtypes)["attack"])))
    clean, mixed = (training.evaluate(boosted.score(df.withColumn("split", F.lit("val")))) for df in (parts["val"], dirty))
    assert metric_dict(mixed.metrics.collect()) == pytest.approx(metric_dict(clean.metrics.collect()))


def test_outside_models_score_by_batch(spark, small_flows):
    inputs = ["packet_count", "bytes_transferred"]
    many = score_batches(small_flows, inputs, lambda f: np.stack([f.packet_count, f.bytes_transferred * 0 + 1000], axis=1))
    wrong = many.where("prediction <> CASE WHEN packet_count >= 1000 THEN 0 ELSE 1 END")
    assert many.count() == small_flows.count() and wrong.count() == 0
    one = score_batches(small_flows, inputs, lambda f: f.packet_count / 2000)
    assert one.where("prediction <> CASE WHEN packet_count > 1000 THEN 1 ELSE 0 END").count() == 0
    assert len(one.first()["probabilities"]) == 1


def test_draws_of_the_neural_search_differ(spark, small_flows):
    """Every knob that is searched changes the model."""
    train = drift.relabel(small_flows)
    ready = feature_set("deployed").fit(train).transform(train)
    losses = {
        tuning.validation_loss(training.fit_model(ready, "mlp", {"max_epochs": 2, **knobs}), ready, "attack")
        for knobs in ({"width": 8}, {"width": 32}, {"width": 8, "tol": 0.5})
    }
    assert len(losses) == 3


# --- trees of all classes together -------------------------------------------------------------------


def both_ways(rows, params, on, **options):
    """Probabilities from Spark ML's ensembles and from those grown side by side."""
    models = [training.fit_model(rows, "gbt", params, together=t, **options) for t in (False, True)]
    return [np.array([r[0] for r in m.score(on).select("probabilities").collect()]) for m in models]


@pytest.mark.parametrize("changed", [{"subsample": 0.6, "eta": 0.1}, {"min_child_weight": 9, "max_depth": 5}, {"max_depth": 0}])
def test_classes_grown_together_equal_spark_ml(parts, changed):
    params = {"num_boost_round": 2, "max_depth": 3, **changed}
    lacking = parts["train"].where("attack IN (1, 3) OR attack IS NULL").withColumn("hour_norm", F.lit(0.0))
    old, new = both_ways(parts["train"] if "subsample" in changed else lacking, params, parts["val"], seed=7)
    assert old.shape == new.shape == (parts["val"].count(), 6) and np.allclose(old, new, rtol=0, atol=1e-12)


@pytest.fixture(scope="module")
def many_rows(spark):
    """Rows enough for cuts to be found on a sample, with inputs that are often 0, constant, negative or all different."""
    x = spark.range(0, 24_000, 1, 3)
    noise = lambda k: F.abs(F.xxhash64("id", F.lit(k)) % 10_007) / 10_007.0
    kinds = [lambda k: noise(k), lambda k: F.floor(noise(k) * 5), lambda k: F.greatest(noise(k) - 0.6, F.lit(0.0)), lambda k: F.lit(0.0), lambda k: noise(k) - 2.0]
    columns = [kinds[i % len(kinds)](i).cast("double").alias(c) for i, c in enumerate(training.MODEL_INPUTS)]
    label = F.floor(noise(0) * 2 + noise(1) * 1.5 + noise(99) * 0.3).alias("attack")
    return x.select(*columns, label).cache()


def test_cuts_from_a_sample_and_children_by_difference(many_rows, monkeypatch):
    params = {"num_boost_round": 2, "max_depth": 4, "subsample": 0.8}
    old, new = both_ways(many_rows, params, many_rows.limit(2000))
    assert np.allclose(old, new, rtol=0, atol=1e-12)
    monkeypatch.setattr(class_trees, "MANY_ROWS", 500)
    model = training.fit_model(many_rows, "gbt", params, together=True)
    less = [r[0] for r in model.score(many_rows.limit(2000)).select("probabilities").collect()]
    assert np.allclose(less, new, rtol=0, atol=1e-9)


def test_a_trial_passes_over_the_rows_once_for_each_level(spark, parts, monkeypatch):
    """Not once for each level of each class."""
    monkeypatch.setattr(tuning, "MAX_ROUNDS", 2)
    kept = lambda: parts["train"].count() and parts["val"].count() and set(spark.sparkContext._jsc.getPersistentRDDs())
    before = kept()
    spark.sparkContext.setJobGroup("one trial", "one trial")
    (trial,) = tuning.random_search(parts["train"], parts["val"], "gbt", trials=1)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one trial"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 2 * trial.params["max_depth"] <= jobs < 2 * trial.params["max_depth"] + 15
    assert kept() <= before
    settings = {**training.GBT_PARAMS, **trial.params, "num_boost_round": 2}
    assert trial.loss == pytest.approx(tuning.validation_loss(training.fit_model(parts["train"], "gbt", settings), parts["val"], "attack"))


def test_exponential_is_the_closest_double():
    x = np.concatenate([np.random.default_rng(5).normal(size=20_000) * 3, [0.0, -0.0, 1 / 64, -650.0, 650.0]])
    assert (class_trees.exp(x) != np.exp(x.astype(np.longdouble)).astype(float)).mean() < 0.01
    assert class_trees.exp(np.array([-800.0, 0.0, 800.0])).tolist() == [0.0, 1.0, math.inf]


def test_trees_refuse_what_spark_ml_refuses(parts):
    for rows in (parts["train"].where("attack > 9"), parts["train"].withColumn("hour_norm", F.lit(float("nan")))):
        for together in (False, True):
            with pytest.raises(Exception):  # noqa: B017
                training.fit_model(rows, "gbt", {"num_boost_round": 1, "max_depth": 1}, together=together)


# --- boosted softmax ---------------------------------------------------------------------------------


def plain_boosting(x, y, params, classes, rounds):
    """One level of second-order trees on rows in memory, cut between any two values."""
    margins, losses = np.zeros((len(y), classes)), []
    for _ in range(rounds):
        p = boosting.softmax(margins)
        losses.append(float(-np.log(p[np.arange(len(y)), y]).mean()))
        step = np.zeros_like(margins)
        for k in range(classes):
            g, h = p[:, k] - (y == k), 2 * p[:, k] * (1 - p[:, k])
            t = lambda v: np.sign(v) * max(abs(v) - params["alpha"], 0)
            score = lambda v, w: t(v) ** 2 / (w + params["lambda"])
            best = (0.0, None)
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f])[:-1]:
                    left = x[:, f] <= cut
                    if min(h[left].sum(), h[~left].sum()) >= params["min_child_weight"]:
                        gain = score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum()) - score(g.sum(), h.sum())
                        if gain > best[0] + 1e-9:
                            best = (gain, left)
            sides = [np.ones(len(y), bool)] if best[1] is None else [best[1], ~best[1]]
            for side in sides:
                step[side, k] = -params["eta"] * t(g[side].sum()) / (h[side].sum() + params["lambda"])
        margins = margins + step
    return losses, boosting.softmax(margins)


@pytest.mark.parametrize("changed", [{}, {"alpha": 2.0, "lambda": 5.0}, {"min_child_weight": 12.0, "eta": 0.9}])
def test_softmax_trees_equal_trees_in_memory(spark, changed):
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 12, 150), rng.integers(0, 5, 150)], axis=1).astype(float)
    y = ((x[:, 0] > 5).astype(int) + (x[:, 1] > 2)) % 3
    df = spark.createDataFrame([(int(c), *map(float, r)) for c, r in zip(y, x, strict=True)], "label int, a double, b double").repartition(3)
    params = {**boosting.SOFTMAX_PARAMS, "max_depth": 1, "num_boost_round": 4, **changed}
    model = boosting.fit_softmax(df, ["a", "b"], params, classes=3)
    losses, shares = plain_boosting(x, y, params, 3, 4)
    assert [h[0] for h in model.history] == pytest.approx(losses)
    found = {(r.a, r.b): r.probability for r in model.transform(df).collect()}
    for row, p in zip(x, shares, strict=True):
        assert found[tuple(row)] == pytest.approx(list(p))


def test_softmax_weights_count_as_copies_and_draws_repeat(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i % 3), int(rng.integers(1, 4)), float(rng.integers(0, 9)), float(rng.integers(0, 9) + i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, "label int, w int, a double, b double")
    many = df.selectExpr("*", "explode(sequence(1, w)) AS i")
    params = {"max_depth": 3, "num_boost_round": 3}
    weighted, copied = boosting.fit_softmax(df, ["a", "b"], params, 3, weight="w"), boosting.fit_softmax(many, ["a", "b"], params, 3)
    assert [h[0] for h in weighted.history] == pytest.approx([h[0] for h in copied.history])
    half = [boosting.fit_softmax(df.coalesce(1), ["a", "b"], {**params, "subsample": 0.5}, 3, seed=s) for s in (1, 1, 2)]
    assert half[0].history == half[1].history != half[2].history
    dirty = df.unionByName(df.selectExpr("7 AS label", "w", "a", "b")).unionByName(df.selectExpr("null AS label", "w", "a", "b"))
    assert np.allclose(boosting.fit_softmax(dirty, ["a", "b"], params, 3, weight="w").history, weighted.history)


def test_rows_written_again_change_nothing(spark, monkeypatch):
    rows = [(int(i % 3), float(i % 7), float(i % 11)) for i in range(100)]
    df = spark.createDataFrame(rows, "label int, a double, b double")
    params = {"max_depth": 2, "num_boost_round": 5}
    once = boosting.fit_softmax(df, ["a", "b"], params, 3)
    monkeypatch.setattr(boosting, "REFRESH", 2)
    again = boosting.fit_softmax(df, ["a", "b"], params, 3)
    assert [h[0] for h in again.history] == pytest.approx([h[0] for h in once.history])


def test_softmax_rows_are_dealt_to_all_cores_and_scratch_tables_go(spark, monkeypatch, tmp_path):
    """Rows of one input partition are worked on by several tasks, and a round leaves no table behind."""
    df = spark.createDataFrame([(int(i % 3), float(i % 7), float(i % 11)) for i in range(400)], "label int, a double, b double").coalesce(1)
    assert [boosting.parts_of(n, 12) for n in (0, 10, 10**5, 10**6, 2 * 10**7)] == [1, 1, 4, 12, 84]
    params, made, files = {"max_depth": 2, "num_boost_round": 3}, [], []
    alone = boosting.fit_softmax(df, ["a", "b"], params, 3)

    def path(_, purpose):
        made.append(str(tmp_path / f"{purpose}-{len(made)}"))
        return made[-1]

    def edges(rows, *rest):
        files.extend(rows.inputFiles())
        return found(rows, *rest)

    found = boosting.find_edges
    monkeypatch.setattr(boosting, "scratch_path", path)
    monkeypatch.setattr(boosting, "find_edges", edges)
    monkeypatch.setattr(boosting, "PART_ROWS", 100)
    dealt = boosting.fit_softmax(df, ["a", "b"], params, 3)
    assert len(files) == 4 and len(made) == 4 and not list(tmp_path.iterdir())
    assert [h[0] for h in dealt.history] == pytest.approx([h[0] for h in alone.history])


@pytest.fixture(scope="module")
def softmax_model(parts):
    return training.fit_model(parts["train"], "xgboost", {"num_boost_round": 5, "max_depth": 4})


def test_softmax_learns(parts, softmax_model):
    assert tuning.validation_loss(softmax_model, parts["val"], "attack") < 1.0 < math.log(6)
    assert accuracy(softmax_model, parts["test"]) > majority(parts["test"])


def test_softmax_progress_and_roundtrip(spark, parts, softmax_model, tmp_path):
    table = training.softmax_progress(softmax_model, {s: parts[s] for s in ("train", "val")}).collect()
    train = [r for r in sorted(table, key=lambda r: r["boost_round"]) if r["split"] == "train"]
    assert len(table) == 10 and all(r["n"] == parts[r["split"]].count() for r in table)
    assert all(a["log_loss"] > b["log_loss"] for a, b in zip(train, train[1:], strict=False))
    assert [r["log_loss"] for r in train[:-1]] == pytest.approx([h[0] for h in softmax_model.stages.history[1:]])
    assert train[-1]["error"] == pytest.approx(1 - accuracy(softmax_model, parts["train"]))
    softmax_model.save(spark, str(tmp_path / "m"))
    loaded = training.FlowModel.load(spark, str(tmp_path / "m"))
    a, b = (m.score(parts["val"]).selectExpr("prediction", "probabilities").collect() for m in (softmax_model, loaded))
    assert a == b and loaded.framework == "softmax"
    with pytest.raises(ValueError, match="softmax model only"):
        training.softmax_progress(training.FlowModel(None, "gbt"), {})


def test_jobs_read_nested_parameter_files(spark, tmp_path):
    """Sections may lie below others; frameworks and feature modules go by their names in existing files."""
    params = {
        "cluster": {"model": {"framework": "xgboost", "seed": 5, "target": "attack", "num_classes": 6, "sample_fraction_for_tuning": 0.2}},
        "batch": {"read_batch_size": 512, "write_batch_size": 1000, "pipeline": {"module": "preprocessing.preprocessing_001"}},
    }
    job = TrainingJob.from_params(spark, params, "p", "o")
    assert (job.framework, job.seed, job.sample_fraction) == ("softmax", 5, 0.2)
    prepare = PreprocessJob.from_params(params, "r", "p", "a")
    assert (prepare.features, prepare.records_per_file) == ("deployed", 1000)
