"""Run registered queries beside their SQL and compare names, types of value, rows and values.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    texts = {}
    for name in frame.columns:
        kind = frame[name].dtype.kind
        if kind == "f":
            texts[name] = frame[name].map(lambda x: "null" if pd.isna(x) else repr(float(x)))
        else:
            texts[name] = frame[name].map(lambda x: "null" if x is None or x is pd.NA or x != x else str(x))
    out = pd.DataFrame(texts)
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} vs {len(sql_frame)}"
    for name in spark_frame.columns:
        a, b = spark_frame[name].dtype, sql_frame[name].dtype
        if a != b and {a.kind, b.kind} != {"O"} and not (a.kind == b.kind == "O"):
            return f"type of {name}: {a} vs {b}"
    left, right = canonical(spark_frame), canonical(sql_frame)
    unequal = (left != right).any(axis=1)
    if unequal.any():
        place = unequal.idxmax()
        columns = [c for c in left.columns if left.at[place, c] != right.at[place, c]]
        return f"{unequal.sum()} rows differ, first: {left.loc[place].to_dict()} vs {right.loc[place].to_dict()} in {columns}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        try:
            found = run(spark, sf_dir).toPandas()
            seconds = time.perf_counter() - started
            problem = differences(found, connection.execute(sqls[name]).df()) if name in sqls else None
            state = problem or ("ok" if name in sqls else "rows only")
        except Exception as error:  # report and go on with the next query
            seconds, problem = time.perf_counter() - started, "failed"
            state = f"FAILED {type(error).__name__}: {str(error)[:600]}"
            found = []
        bad += problem is not None
        print(f"{name:24} {len(found):7} rows {seconds:7.2f}s  {state}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
