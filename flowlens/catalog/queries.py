"""Every registered query: (spark, sf_dir) -> DataFrame over the whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import features as fx
from ..functions.rules import concept_scores, normal_scores
from ..operators import drift, evaluate, payloads, profile, sampling, validate
from ..operators.encoders import (
    apply_encoders,
    encoder_table,
    fit_encoders,
    index_by_join,
    rank_values,
    value_counts,
)
from ..operators.scalers import FALLBACK, POPULATION, apply_scaler, fit_scaler, stats_table
from ..operators.sessions import SkewOptions, add_session_features
from ..plans import ml_features, training, tuning
from ..plans.preprocess import FittedFeatures, feature_set, load_fitted
from ..plans.tracking import Run, RunLog, metric_dict, report_text
from ..schemas import (
    CATEGORICAL,
    EVENT_PROPERTIES,
    MODEL_INPUTS,
    NUMERIC,
    PROPERTY_COLUMNS,
    RAW_FLOW,
    RICH_NUMERIC,
    TARGET,
)
from ..session import scratch_path
from ..sources.artifact import load_artifact
from ..sources.events import parse_messages, to_messages
from ..sources.parquet import read_flows, read_split, write_split
from ..streaming import commits, positions
from ..streaming import score as streams
from .flows import FLOW_COLUMNS, flows, flows_bad, flows_split

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The seed and shares the queries (and their SQL) use.
SEED = 42
FRACTION = 0.2
CANARY = 0.1
CAP = 2500


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def r6(column: str | Column) -> Column:
    """Six places, and no negative zero, for the comparison with SQL."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, 6) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


def rounded_doubles(df: DataFrame) -> DataFrame:
    return rounded(df, *[f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)])


# --- scans, sources, sinks ---------------------------------------------------------------------


@query
def scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows stored with a timestamp column come back in epoch seconds."""
    path = scratch_path(spark, "raw")
    stored = flows(spark, sf_dir).withColumn("timestamp", fx.utc_timestamp(F.col("timestamp")))
    stored.write.parquet(path)
    schema = T.StructType([T.StructField("flow_id", T.LongType()), *RAW_FLOW.fields])
    return read_flows(spark, path, schema)


@query
def write_read_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "split")
    write_split(flows_split(spark, sf_dir, "train"), root, "train", records_per_file=1000)
    schema = T.StructType([T.StructField("flow_id", T.LongType()), *RAW_FLOW.fields])
    return read_split(spark, root, "train", schema)


@query
def artifact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, column, key, value) of an artifact after saving and loading."""
    path = scratch_path(spark, "artifact")
    feature_set("deployed").fit(flows_split(spark, sf_dir, "train")).save(spark, path)
    encoders, stats = load_artifact(spark, path)
    rows = [("encoder", c, v, float(i)) for c, m in encoders.to_maps().items() for v, i in m.items()]
    rows += [("scaler", c, k, v) for c, s in stats.items() for k, v in s.items()]
    table = spark.createDataFrame(rows, "part string, `column` string, `key` string, value double")
    return rounded(table, "value")


@query
def publish_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written, then read back field by field."""
    path = scratch_path(spark, "messages")
    to_messages(flows(spark, sf_dir)).write.parquet(path)
    parsed = parse_messages(spark.read.parquet(path))
    return parsed.select(
        "key",
        F.col("event.timestamp").alias("event_timestamp"),
        "event.event_id",
        *[F.col(f"event.properties.{c}").alias(c) for c in PROPERTY_COLUMNS],
        "event.label",
    )


@query
def named_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature set is chosen by the name in the job parameters."""
    params = {"features": "deployed"}
    fitted = feature_set(params["features"]).fit(flows_split(spark, sf_dir, "train"))
    result = fitted.transform(flows(spark, sf_dir), keep=("flow_id", "split"))
    return rounded_doubles(result)


# --- features ----------------------------------------------------------------------------------


@query
def features_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.add(flows(spark, sf_dir).select("flow_id", "timestamp"), fx.time_features())
    df = fx.add(df, fx.epoch_features())
    return df.select(
        "flow_id",
        F.col("timestamp_ts").cast("string").alias("timestamp_ts"),
        "hour",
        "dayofweek",
        "is_weekend",
        r6("hour_sin").alias("hour_sin"),
        r6("hour_cos").alias("hour_cos"),
        "timestamp_epoch",
    )


@query
def features_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = {**fx.log_volume_features(), **fx.ratio_features()}
    df = fx.add(flows(spark, sf_dir), groups)
    return df.select("flow_id", *[r6(c).alias(c) for c in groups])


@query
def features_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows(spark, sf_dir).select("flow_id", *[c.alias(n) for n, c in fx.port_features().items()])


@query
def features_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On the frame with missing values: nulls are skipped."""
    df = flows_bad(spark, sf_dir)
    return df.select(
        "flow_id",
        *[c.alias(n) for n, c in fx.protocol_conn().items()],
        fx.session_id("_")["session_id"].alias("session_id"),
        fx.session_id("-")["session_id"].alias("session_id_dash"),
    )


@query
def features_deployed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.deployed_features(flows(spark, sf_dir)).drop("timestamp_ts", "split")
    return rounded(df, "hour_sin", "hour_cos", "bytes_log", "packet_log")


# --- filters and validation --------------------------------------------------------------------


def _fitted(spark: SparkSession, sf_dir: str, name: str = "deployed") -> FittedFeatures:
    return feature_set(name).fit(flows_split(spark, sf_dir, "train"))


@query
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed flows with one column taken away."""
    processed = _fitted(spark, sf_dir).transform(flows_bad(spark, sf_dir))
    return validate.contract_report(processed.drop("hour_norm"))


@query
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate.validate_records(flows_bad(spark, sf_dir))
    return checked.select("flow_id", F.array_join(F.array_sort("violations"), ",").alias("violations"))


@query
def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validation_summary(validate.validate_records(flows_bad(spark, sf_dir)))


@query
def clip_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    clipped = validate.clip_to_domain(flows_bad(spark, sf_dir))
    return rounded(clipped.select("flow_id", "packet_count", "bytes_transferred"), "bytes_transferred")


# --- encoders ----------------------------------------------------------------------------------


def _crossed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.add(flows(spark, sf_dir), fx.protocol_conn())


@query
def encoder_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _crossed(spark, sf_dir)
    return encoder_table(fit_encoders(df, CATEGORICAL), df)


@query
def encoder_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _crossed(spark, sf_dir)
    encoded = apply_encoders(df, fit_encoders(df, CATEGORICAL))
    return encoded.select("flow_id", *[f"{c}_idx" for c in CATEGORICAL])


@query
def encoder_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted without ICMP, applied to flows that have ICMP, foreign and missing values."""
    df = _crossed(spark, sf_dir)
    fitted = fit_encoders(df.where(F.col("protocol") != "ICMP"), CATEGORICAL)
    encoded = apply_encoders(fx.add(flows_bad(spark, sf_dir), fx.protocol_conn()), fitted)
    return encoded.select("flow_id", *[f"{c}_idx" for c in CATEGORICAL])


@query
def encoder_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In place: the columns themselves become indices."""
    fitted = fit_encoders(flows_split(spark, sf_dir, "train"), ["protocol", "conn_state"])
    encoded = apply_encoders(flows(spark, sf_dir), fitted, in_place=True)
    return encoded.select("flow_id", "protocol", "conn_state")


@query
def encoder_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent value first, ties alphabetical; also for a column of many values."""
    df = _crossed(spark, sf_dir).withColumn("dst_port", F.col("dst_port").cast("string"))
    return rank_values(value_counts(df, [*CATEGORICAL, "dst_port"]), by="frequency").drop("n")


@query
def encoder_apply_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many session values: the mapping stays a table and is joined."""
    df = fx.add(flows(spark, sf_dir), fx.session_id("_"))
    train = fx.add(flows_split(spark, sf_dir, "train"), fx.session_id("_"))
    vocabulary = fit_encoders(train, ["session_id"], inline_limit=100).columns["session_id"]
    return index_by_join(df, "session_id", vocabulary, "session_id_idx").select(
        "flow_id", "session_id", "session_id_idx"
    )


@query
def encoder_apply_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the flows have one session; the mapping is joined without sending it, and that session is looked up in place."""
    df = fx.add(flows(spark, sf_dir), fx.session_id("_"))
    train = fx.add(flows_split(spark, sf_dir, "train"), fx.session_id("_"))
    vocabulary = fit_encoders(train, ["session_id"], inline_limit=100).columns["session_id"]
    known = train.agg(F.min("session_id")).first()[0]
    skewed = df.withColumn("session_id", F.when(F.col("flow_id") % 3 == 0, known).otherwise(F.col("session_id")))
    indexed = index_by_join(skewed, "session_id", vocabulary, "session_id_idx", broadcast=False)
    return indexed.select("flow_id", "session_id", "session_id_idx")


# --- scalers -----------------------------------------------------------------------------------


def _featured(spark: SparkSession, sf_dir: str, split: str | None = None) -> DataFrame:
    df = flows_split(spark, sf_dir, split) if split else flows(spark, sf_dir)
    return fx.deployed_features(df)


@query
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _featured(spark, sf_dir)
    return rounded(stats_table(df, fit_scaler(df, NUMERIC)), "mean", "std")


@query
def scaler_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = fit_scaler(_featured(spark, sf_dir, "train"), NUMERIC)
    scaled = apply_scaler(_featured(spark, sf_dir), stats)
    return scaled.select("flow_id", *[r6(f"{c}_norm").alias(f"{c}_norm") for c in NUMERIC])


@query
def scaler_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _featured(spark, sf_dir).withColumn("constant", F.lit(7.0))
    return rounded(stats_table(df, fit_scaler(df, [*NUMERIC, "constant"], POPULATION)), "mean", "std")


@query
def scaler_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows_bad(spark, sf_dir)
    columns = ["src_port", "packet_count", "bytes_transferred"]
    scaled = apply_scaler(df, fit_scaler(df, columns, FALLBACK), FALLBACK, fill=0.0)
    return scaled.select("flow_id", *[r6(f"{c}_norm").alias(f"{c}_norm") for c in columns])


@query
def scaler_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["bytes_log", "packet_log", "hour"]
    df = _featured(spark, sf_dir).select("flow_id", *columns)
    vectors = VectorAssembler(inputCols=columns, outputCol="vec").transform(df)
    scaler = StandardScaler(inputCol="vec", outputCol="scaled", withMean=True, withStd=True).fit(vectors)
    values = vector_to_array(F.col("scaled"))
    return scaler.transform(vectors).select(
        "flow_id", *[r6(F.get(values, F.lit(i))).alias(f"{c}_scaled") for i, c in enumerate(columns)]
    )


# --- sessions ----------------------------------------------------------------------------------


@query
def session_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.add(flows(spark, sf_dir), fx.log_volume_features())
    names = ["prev_bytes_mean_3", "prev_packet_mean_3"]
    rolled = add_session_features(df, aggregates=False)
    return rounded(rolled.select("flow_id", *names, "prev_event_count_3"), *names)


@query
def session_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.add(flows(spark, sf_dir), fx.log_volume_features())
    names = ["session_bytes_max", "session_bytes_min", "session_packet_mean"]
    return rounded(add_session_features(df, rolling=False).select("flow_id", *names), *names)


#: Low enough that the sessions of the test tables are cut.
SLICED = SkewOptions(hot_rows=2, probe_fraction=1.0)


@query
def session_rolling_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As session_rolling, with sessions cut into slices and ordered by a timestamp."""
    df = fx.add(flows(spark, sf_dir), fx.log_volume_features())
    df = df.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    names = ["prev_bytes_mean_3", "prev_packet_mean_3"]
    rolled = add_session_features(df, aggregates=False, options=SLICED)
    return rounded(rolled.select("flow_id", *names, "prev_event_count_3"), *names)


@query
def session_aggregates_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fx.add(flows(spark, sf_dir), fx.log_volume_features())
    names = ["session_bytes_max", "session_bytes_min", "session_packet_mean"]
    return rounded(add_session_features(df, rolling=False, options=SLICED).select("flow_id", *names), *names)


# --- profiles and samples ----------------------------------------------------------------------


@query
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.class_distribution(flows(spark, sf_dir)), "share")


@query
def num_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.num_classes(flows_split(spark, sf_dir, "train"), flows_split(spark, sf_dir, "val"))


@query
def split_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.split_profile(flows(spark, sf_dir))


@query
def row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.row_cap(flows(spark, sf_dir), CAP, ["flow_id"]).select("flow_id", TARGET)


@query
def sample_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = sampling.stratified_sample(flows(spark, sf_dir), TARGET, FRACTION, "flow_id", SEED)
    return sample.select("flow_id", TARGET)


@query
def sample_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.share_sample(flows(spark, sf_dir), FRACTION, "flow_id", SEED).select("flow_id", TARGET)


# --- rules and drift ---------------------------------------------------------------------------


@query
def rule_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir)
    scores = {f"score_{i}": s for i, s in enumerate(concept_scores())}
    labelled = drift.with_rule_label(df, concept_scores()).withColumns(scores)
    return rounded(labelled.select("flow_id", "prediction", *scores), *scores)


@query
def rule_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir)
    scores = {f"score_{i}": s for i, s in enumerate(normal_scores())}
    labelled = drift.with_rule_label(df, normal_scores()).withColumns(scores)
    return rounded(labelled.select("flow_id", "prediction", *scores), *scores)


@query
def relabel_concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.relabel(flows(spark, sf_dir)).select(*FLOW_COLUMNS)


@query
def attack_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_doubles(drift.signature_coverage(flows(spark, sf_dir)))


@query
def drift_perturb(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = drift.shift_fixed(flows(spark, sf_dir), 1.5, 80)
    return rounded(moved.select("flow_id", "packet_count", "bytes_transferred", TARGET), "bytes_transferred")


def _rule_model(df: DataFrame) -> DataFrame:
    return drift.with_rule_label(df, concept_scores())


def _soft_rule_model(df: DataFrame) -> DataFrame:
    return drift.with_rule_probabilities(df, concept_scores())


@query
def drift_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = drift.evaluate_scenarios(drift.scenarios(flows(spark, sf_dir)), _rule_model)
    return rounded(table, "value")


def _normal(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    """Flows with the normal rule's classes, from which the scenarios drift away."""
    return drift.with_rule_label(flows_split(spark, sf_dir, split), normal_scores(), TARGET)


@query
def drift_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boosted model trained on normal classes and retrained on concept classes, both scored on all scenarios of val and test."""
    train = _normal(spark, sf_dir, "train")
    fitted = _fitted(spark, sf_dir)
    prepared = {s: fitted.transform(drift.scenarios(_normal(spark, sf_dir, s)), keep=("scenario",)) for s in ("val", "test")}
    parts = []
    for name, source in (("normal", train), ("concept", drift.relabel(train))):
        model = training.fit_model(fitted.transform(source), "softmax", {"max_depth": 4}, seed=SEED)
        for split, rows in prepared.items():
            table = drift.evaluate_scenarios(rows, model.score)
            parts.append(table.withColumns({"trained_on": F.lit(name), "split": F.lit(split)}))
    return rounded(reduce(DataFrame.unionByName, parts), "value")


# --- fit / apply -------------------------------------------------------------------------------


def _preprocess(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    processed = _fitted(spark, sf_dir).transform(flows_split(spark, sf_dir, split), keep=("flow_id",))
    return rounded_doubles(processed)


@query
def preprocess_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preprocess(spark, sf_dir, "train")


@query
def preprocess_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the artifact as saved by the training run."""
    path = scratch_path(spark, "artifact")
    _fitted(spark, sf_dir).save(spark, path)
    processed = load_fitted(spark, path).transform(flows_split(spark, sf_dir, "val"), keep=("flow_id",))
    return rounded_doubles(processed)


@query
def preprocess_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _preprocess(spark, sf_dir, "test")


@query
def preprocess_rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    processed = _fitted(spark, sf_dir, "rich_sessions").transform(flows(spark, sf_dir), keep=("flow_id",))
    return rounded(processed, *[f"{c}_norm" for c in RICH_NUMERIC])


@query
def preprocess_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = flows(spark, sf_dir)
    scaled = ml_features.transform_ml(ml_features.fit_ml(df), df)
    values = vector_to_array(F.col("features_scaled"))
    return scaled.select(
        "flow_id", *[r6(F.get(values, F.lit(i))).alias(c) for i, c in enumerate(ml_features.ML_INPUTS)]
    )


@query
def preprocess_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with missing and foreign values, as served."""
    served = _fitted(spark, sf_dir).transform_for_inference(flows_bad(spark, sf_dir), keep=("flow_id",))
    return rounded_doubles(served)


# --- training and tuning -----------------------------------------------------------------------


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _processed(spark: SparkSession, sf_dir: str, *splits: str, keep: tuple[str, ...] = ()) -> list[DataFrame]:
    """Features with the concept rule's classes, which a model can learn; the stored ones follow the id."""
    fitted = _fitted(spark, sf_dir)
    return [fitted.transform(drift.relabel(flows_split(spark, sf_dir, s)), keep=keep) for s in splits]


@query
def train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _processed(spark, sf_dir, "train", "val", "test")
    return training.train(*parts, framework="gbt", seed=SEED, partitions=_cores(spark)).metrics


@query
def train_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _processed(spark, sf_dir, "train", "val", "test")
    return training.train(*parts, framework="mlp", seed=SEED, partitions=_cores(spark)).metrics


@query
def boosting_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val = _processed(spark, sf_dir, "train", "val")
    return training.boosting_progress(training.fit_model(train, "gbt", seed=SEED, partitions=_cores(spark)), val)


@query
def boosting_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every round of the boosted softmax model: rows scored, and whether its loss is below that of the round before (train) or
    of even odds (val)."""
    parts = dict(zip(("train", "val"), _processed(spark, sf_dir, "train", "val"), strict=True))
    model = training.fit_model(parts["train"], "softmax", seed=SEED)
    table = training.softmax_progress(model, parts)
    before = F.coalesce(F.lag("log_loss").over(Window.partitionBy("split").orderBy("boost_round")), F.lit(math.log(6)))
    bound = F.when(F.col("split") == "train", before).otherwise(F.lit(math.log(6)))
    return table.select("split", "boost_round", "n", (F.col("log_loss") < bound).alias("falls"))


@query
def tune_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val = _processed(spark, sf_dir, "train", "val")
    return tuning.trial_table(train, tuning.random_search(train, val, "gbt", seed=SEED, partitions=_cores(spark)))


@query
def tune_halving(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, val = _processed(spark, sf_dir, "train", "val")
    return tuning.trial_table(train, tuning.halving_search(train, val, "mlp", seed=SEED, partitions=_cores(spark)))


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(n_rows, n_equal): a saved and loaded model gives the same answers on every row."""
    path = scratch_path(spark, "model")
    train, test = _processed(spark, sf_dir, "train", "test")
    model = training.fit_model(train, "forest", seed=SEED)
    model.save(spark, path)
    loaded = training.FlowModel.load(spark, path)
    first = model.score(test).withColumnsRenamed({"prediction": "p1", "probabilities": "s1"})
    both = loaded.score(first)
    equal = (F.col("p1") == F.col("prediction")) & (F.col("s1") == F.col("probabilities"))
    return both.agg(F.count("*").alias("n_rows"), F.count_if(equal).alias("n_equal"))


@query
def score_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of rows whose scores keep their promises: shares sum to 1, the first greatest share wins."""
    fitted = _fitted(spark, sf_dir)
    model = training.fit_model(fitted.transform(drift.relabel(flows_split(spark, sf_dir, "train"))), "forest", seed=SEED)
    scored = model.score(fitted.transform(flows(spark, sf_dir)))
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, v: a + v)
    place = F.array_position("probabilities", F.array_max("probabilities")) - 1
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.abs(total - 1.0) < 1e-9).alias("n_sum_one"),
        F.count_if(F.size("probabilities") == 6).alias("n_six_classes"),
        F.count_if(place == F.col("prediction")).alias("n_first_argmax"),
    )


# --- scoring -----------------------------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str, framework: str) -> DataFrame:
    fitted = _fitted(spark, sf_dir)
    train = fitted.transform(drift.relabel(flows_split(spark, sf_dir, "train")))
    model = training.fit_model(train, framework, seed=SEED, partitions=_cores(spark))
    even = training.spread(flows(spark, sf_dir), _cores(spark))  # before features make the rows wide
    scored = model.score(fitted.transform(drift.relabel(even), keep=("flow_id",)))
    shares = [r6(F.get("probabilities", F.lit(i))).alias(f"p_{i}") for i in range(model.classes)]
    return scored.select("flow_id", TARGET, "prediction", *shares)


@query
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "gbt")


@query
def score_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, "mlp")


@query
def score_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _soft_rule_model(flows(spark, sf_dir))
    shares = [r6(F.get("probability", F.lit(i))).alias(f"p_{i}") for i in range(6)]
    return scored.select("flow_id", TARGET, "prediction", *shares)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request body per flow; its shape follows the connection state and protocol."""
    df = flows(spark, sf_dir)
    row = F.to_json(F.struct(*[F.col(c).cast(EVENT_PROPERTIES[c].dataType).alias(c) for c in PROPERTY_COLUMNS]))
    body = (
        F.when(F.col("conn_state") == "EST", F.concat(F.lit('{"data": '), row, F.lit("}")))
        .when(F.col("conn_state") == "SYN", F.concat(F.lit('{"data": ['), row, F.lit(", "), row, F.lit("]}")))
        .when(F.col("conn_state") == "FIN", F.concat(F.lit('{"rows": '), row, F.lit("}")))
        .when(F.col("protocol") == "TCP", F.concat(F.lit('{"data": "'), F.col("src_port").cast("string"), F.lit('"}')))
        .when(F.col("protocol") == "UDP", F.concat(F.lit("["), row, F.lit("]")))
        .otherwise(F.concat(F.lit('{"data": '), row))
    )
    return df.select(F.col("flow_id").alias("request_id"), body.alias("body"))


@query
def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = payloads.open_requests(_requests(spark, sf_dir))
    return payloads.request_rows(opened, EVENT_PROPERTIES, ["request_id"])


@query
def payload_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.request_errors(payloads.open_requests(_requests(spark, sf_dir)), ["request_id"])


MODEL_KEYS = {"stable": "models/stable", "canary": "models/canary"}


@query
def canary_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable rows scored by the concept rule, canary rows by the normal rule."""
    scorers = {
        "stable": _rule_model,
        "canary": lambda df: drift.with_rule_label(df, normal_scores()),
    }
    scored = payloads.score_by_variant(flows(spark, sf_dir), scorers, "flow_id", CANARY, SEED)
    about = payloads.model_struct(F.col("variant"), "rule", MODEL_KEYS)
    return scored.withColumn("model", about).select("flow_id", "prediction", "model.*")


@query
def serve_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as texts: classes, and their probabilities in millionths, row by row."""
    soft = {"stable": concept_scores(), "canary": normal_scores()}
    scorers = {
        v: lambda df, s=s: drift.with_rule_probabilities(df, s).withColumnRenamed("probability", "probabilities")
        for v, s in soft.items()
    }
    answers = payloads.serve_requests(
        _requests(spark, sf_dir), EVENT_PROPERTIES, scorers, "rule", MODEL_KEYS, probability=CANARY, seed=SEED
    )
    millionths = F.transform(
        "probabilities", lambda r: F.array_join(F.transform(r, lambda p: F.round(p * 1e6).cast("long").cast("string")), ":")
    )
    return answers.select(
        "request_id",
        F.array_join(F.transform("predictions", lambda p: p.cast("string")), ",").alias("predictions"),
        F.array_join(millionths, ",").alias("probabilities"),
        "model.*",
        "error",
    )


# --- streams -----------------------------------------------------------------------------------


def _messages(flow_rows: DataFrame) -> DataFrame:
    """Flows as messages; some are cut off half way, some are empty."""
    kind = (
        F.when((F.col("dst_port") == 53) & (F.col("conn_state") == "RST"), "cut")
        .when((F.col("dst_port") == 22) & (F.col("protocol") == "ICMP"), "empty")
        .otherwise("whole")
    )
    messages = to_messages(flow_rows.withColumn("kind", kind), keep=("kind",))
    half = F.expr("left(value, length(value) div 2)")
    value = F.when(F.col("kind") == "cut", half).when(F.col("kind") == "empty", "").otherwise(F.col("value"))
    return messages.select("key", value.alias("value"))


def _write_messages(messages: DataFrame, path: str, files: int = 4) -> None:
    messages.repartition(files).write.mode("append").parquet(path)


def _stream_paths(spark: SparkSession) -> dict[str, str]:
    return {name: scratch_path(spark, f"stream-{name}") for name in ("input", "output", "quarantine", "checkpoint")}


def _decode(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    paths = _stream_paths(spark)
    _write_messages(_messages(flows(spark, sf_dir)), paths["input"])
    source = streams.file_messages(spark, paths["input"], files_per_batch=2)
    streams.run_available(
        streams.decode_stream(source, paths["output"], paths["quarantine"], paths["checkpoint"])
    )
    return paths


FLOW_ROW = (
    "key string, src_port int, dst_port int, protocol string, packet_count int, conn_state string, "
    "bytes_transferred double, timestamp long, attack long"
)


MESSAGE_ROW = "key string, value string"


@query
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.read_batches(spark, _decode(spark, sf_dir)["output"], FLOW_ROW).drop("run", "batch_id")


@query
def stream_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = streams.read_batches(spark, _decode(spark, sf_dir)["quarantine"], "key string, value string, error string")
    return bad.select("key", F.length("value").alias("n_chars"), "error")


def _score_stream(
    spark: SparkSession, paths: dict[str, str], score: streams.Scorer, files_per_batch: int = 2
) -> DataFrame:
    source = streams.file_messages(spark, paths["input"], files_per_batch)
    about = {"variant": "stable", "framework": "rule", "model_key": MODEL_KEYS["stable"]}
    streams.run_available(
        streams.scoring_stream(
            source, score, paths["output"], paths["quarantine"], paths["checkpoint"], about
        )
    )
    return streams.read_batches(spark, paths["output"], "key string, value string")


def _predicted(delivered: DataFrame) -> DataFrame:
    answer = F.from_json("value", "prediction long, model struct<variant string, framework string, model_key string>")
    return delivered.select("key", answer.alias("answer")).select("key", "answer.prediction", "answer.model.*")


@query
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _stream_paths(spark)
    _write_messages(_messages(flows(spark, sf_dir)), paths["input"])
    return _predicted(_score_stream(spark, paths, _rule_model))


@query
def stream_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream goes through the batch-fitted features, exactly as a batch would."""
    paths = _stream_paths(spark)
    _write_messages(to_messages(flows(spark, sf_dir)), paths["input"])
    fitted = _fitted(spark, sf_dir)
    outputs = {
        paths["output"]: lambda parsed: fitted.transform_for_inference(streams.flatten_events(parsed), keep=("key",))
    }
    source = streams.file_messages(spark, paths["input"], files_per_batch=2)
    streams.run_available(streams.batch_stream(source, outputs, paths["checkpoint"]))
    kinds = {c: "int" if c.endswith("_idx") else "double" for c in MODEL_INPUTS}
    schema = ", ".join(["key string", *[f"{c} {k}" for c, k in kinds.items()]])
    return rounded_doubles(streams.read_batches(spark, paths["output"], schema).drop("run", "batch_id"))


@query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped and started again with more input: every message is answered once."""
    paths = _stream_paths(spark)
    _write_messages(_messages(flows_split(spark, sf_dir, "train")), paths["input"])
    _score_stream(spark, paths, _rule_model, files_per_batch=4)
    _write_messages(_messages(flows_split(spark, sf_dir, "val", "test")), paths["input"])
    return _predicted(_score_stream(spark, paths, _rule_model, files_per_batch=4))


@query
def stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first batches are compacted and expired, more arrive, and one is cut off before its record: read are the complete ones."""
    paths = _stream_paths(spark)
    _write_messages(_messages(flows_split(spark, sf_dir, "train")), paths["input"])
    _score_stream(spark, paths, _rule_model, files_per_batch=1)
    commits.compact(spark, paths["output"], MESSAGE_ROW, rows_per_file=100_000)
    commits.expire(spark, paths["output"])
    _write_messages(_messages(flows_split(spark, sf_dir, "val", "test")), paths["input"])
    delivered = _score_stream(spark, paths, _rule_model, files_per_batch=1)
    torn = to_messages(flows(spark, sf_dir)).select("key", "value")
    torn.write.parquet(commits.batch_folder(paths["output"], "torn", 0))
    return _predicted(delivered)


@query
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch took in and rejected; of its milliseconds, that there are some."""
    paths = _stream_paths(spark)
    messages = _messages(flows(spark, sf_dir))
    for i in range(4):
        messages.where(F.col("key").cast("long") % 4 == i).coalesce(1).write.mode("append").parquet(paths["input"])
    _score_stream(spark, paths, _rule_model, files_per_batch=1)
    latency = commits.batch_latency(spark, paths["output"], paths["quarantine"])
    return latency.select("n_rows", "n_rejected", (F.col("millis") > 0).alias("timed"))


@query
def stream_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six partitions, some offsets never used; the train flows are read, and the lag is that to the end of all flows."""
    paths = _stream_paths(spark)
    place = F.col("key").cast("long")
    columns = [
        F.lit("flows").alias("topic"), (place % 6).cast("int").alias("partition"),
        F.floor(place / 6).cast("long").alias("offset"), F.timestamp_seconds(place).alias("time"),
    ]

    def topic(rows: DataFrame) -> DataFrame:
        return _messages(rows.where("flow_id % 10 <> 7")).select("key", "value", *columns)

    _write_messages(topic(flows_split(spark, sf_dir, "train")), paths["input"])
    source = streams.file_messages(spark, paths["input"], files_per_batch=2, positions=True)
    streams.run_available(streams.decode_stream(source, paths["output"], paths["quarantine"], paths["checkpoint"]))
    good = streams.read_batches(spark, paths["output"], f"{FLOW_ROW}, {streams.POSITION_SCHEMA}")
    bad = streams.read_batches(spark, paths["quarantine"], f"{MESSAGE_ROW}, error string, {streams.POSITION_SCHEMA}")
    wanted = ["topic", "partition", "offset", "time"]
    read = good.select(*wanted, F.lit(None).cast("string").alias("error")).unionByName(bad.select(*wanted, "error"))
    ends = topic(flows(spark, sf_dir)).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    report = positions.with_lag(positions.partition_report(read), ends)
    return report.withColumns({c: F.unix_seconds(c) for c in ("first_time", "last_time")})


@query
def stream_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with what became of it: no error, or why it was not scored."""
    paths = _stream_paths(spark)
    odd = (F.col("protocol") == "UDP") & (F.col("conn_state") == "SYN")
    marked = flows_bad(spark, sf_dir).withColumn("odd", F.coalesce(odd, F.lit(False)))
    value = F.when(F.col("odd"), F.regexp_replace("value", '"timestamp":"[^"]*"', '"timestamp":"soon"')).otherwise(F.col("value"))
    _write_messages(to_messages(marked, keep=("odd",)).select("key", value.alias("value")), paths["input"])
    source = streams.file_messages(spark, paths["input"], files_per_batch=2)
    about = {"variant": "stable", "framework": "rule", "model_key": MODEL_KEYS["stable"]}
    streams.run_available(
        streams.scoring_stream(source, _rule_model, paths["output"], paths["quarantine"], paths["checkpoint"], about, checked=True)
    )
    good = streams.read_batches(spark, paths["output"], MESSAGE_ROW).select("key", F.lit("").alias("error"))
    bad = streams.read_batches(spark, paths["quarantine"], f"{MESSAGE_ROW}, error string").select("key", "error")
    return good.unionByName(bad)


# --- evaluation and run log --------------------------------------------------------------------


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_rule_model(flows(spark, sf_dir)))


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confusion(spark, sf_dir)


@query
def confusion_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.confusion_normalised(_confusion(spark, sf_dir)), "share").drop("cell_text")


@query
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluate.class_metrics(_confusion(spark, sf_dir)).drop("tp")
    return rounded(table, *evaluate.SCORES)


@query
def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.summary_metrics(evaluate.class_metrics(_confusion(spark, sf_dir))), "value")


@query
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.classification_report(evaluate.class_metrics(_confusion(spark, sf_dir)))


@query
def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _rule_model(flows(spark, sf_dir))
    wrong = F.avg((F.col("prediction") != F.col(TARGET)).cast("double"))
    return scored.agg(r6(wrong).alias("error_rate"), F.count("*").alias("n"))


@query
def log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the rule as a soft model, per split."""
    scored = _soft_rule_model(flows(spark, sf_dir))
    return rounded(evaluate.log_loss(scored, TARGET, "probability", ["split"]), "log_loss")


@query
def split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = flows_split(spark, sf_dir, "val", "test")
    evaluation = training.evaluate(_soft_rule_model(held_out).withColumnRenamed("probability", "probabilities"))
    return rounded(evaluation.metrics, "value")


def _run_log(spark: SparkSession, sf_dir: str) -> RunLog:
    """One run per split: its metrics, a flag that is not a metric, and the report as text."""
    log = RunLog(spark, scratch_path(spark, "runs"))
    scored = _rule_model(flows(spark, sf_dir))
    per_class = evaluate.class_metrics(evaluate.confusion_matrix(scored, by=["split"]), ["split"]).cache()
    summary = evaluate.summary_metrics(per_class, ["split"]).collect()
    report = evaluate.classification_report(per_class, by=["split"]).collect()
    per_class.unpersist()
    runs = []
    for split in ("train", "val", "test"):
        metrics = metric_dict(r for r in summary if r["split"] == split)
        text = report_text(r for r in report if r["split"] == split)
        runs.append(Run(f"rule_{split}", "rule", {"split": split}, {**metrics, "done": True}, {"report.txt": text}))
    log.log(*runs)
    return log


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_run_log(spark, sf_dir).run_metrics(), "value")


@query
def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_run_log(spark, sf_dir).best_run("error_rate"), "value")
