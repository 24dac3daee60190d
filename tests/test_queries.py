"""Every query beside its SQL on the smallest data; plans of the headline queries."""

import pytest
from compare import differences, duck

from __spark_entry__ import entry, queries
from flowlens.catalog.queries import QUERIES
from flowlens.catalog.sql import SQL

SLOW = {"train_gbt", "train_mlp", "boosting_progress", "tune_random", "tune_halving", "score_batch", "score_mlp", "drift_retrain"}
CHECKED = sorted(SQL)


def test_each_sql_has_a_query():
    assert set(CHECKED) <= set(QUERIES) <= set(queries())
    assert set(QUERIES) - set(CHECKED) == SLOW


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, sf_dir, connection, name):
    found = queries()[name](spark, sf_dir).toPandas()
    assert differences(found, connection.execute(SQL[name]).df()) is None


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "flow_id" and df.columns[-1] == "attack" and len(df.columns) == 16


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_transform_adds_no_shuffle_and_pushes_the_split_down(spark, sf_dir):
    text = plan(queries()["preprocess_train"](spark, sf_dir))
    assert "Exchange" not in text
    assert "LessThan(ts" in text


@pytest.mark.parametrize("name", ["session_rolling", "session_aggregates"])
def test_session_windows_share_one_exchange(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    assert text.count("Exchange hashpartitioning") == 1


def test_confusion_evaluates_the_model_once(spark, sf_dir):
    text = plan(queries()["confusion_matrix"](spark, sf_dir))
    assert text.count("array_max") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scan_reads_only_needed_columns(spark, sf_dir):
    text = plan(queries()["features_volume"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,value:double>" in text
