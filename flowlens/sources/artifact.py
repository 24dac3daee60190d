"""The fitted artifact: one JSON document `{"encoders": {...}, "scaler": {...}}`.

Vocabularies too large for JSON lie beside it as Parquet tables.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.encoders import Encoders, Vocabulary
from ..operators.scalers import Stats
from .parquet import object_store_path


def artifact_json(encoders: Encoders, scaler: Stats) -> str:
    return json.dumps({"encoders": encoders.to_maps(), "scaler": scaler}, ensure_ascii=False)


def parse_artifact(text: str) -> tuple[Encoders, Stats]:
    document = json.loads(text)
    return Encoders.from_maps(document["encoders"]), document["scaler"]


def save_artifact(spark: SparkSession, path: str, encoders: Encoders, scaler: Stats) -> None:
    path = object_store_path(path).rstrip("/")
    for column, vocabulary in encoders.columns.items():
        if vocabulary.table is not None:
            vocabulary.table.write.mode("overwrite").parquet(f"{path}/vocabulary/{column}")
    tables = {
        c: {"size": v.size, "bytes": v.bytes} for c, v in encoders.columns.items() if v.table is not None
    }
    rows = [(artifact_json(encoders, scaler), json.dumps(tables))]
    document = spark.createDataFrame(rows, "artifact string, tables string").coalesce(1)
    document.select("artifact").write.mode("overwrite").text(f"{path}/artifact")
    document.select("tables").write.mode("overwrite").text(f"{path}/tables")


def load_artifact(spark: SparkSession, path: str) -> tuple[Encoders, Stats]:
    """Always read from the store: no local copy that could be stale."""
    path = object_store_path(path).rstrip("/")
    encoders, scaler = parse_artifact(spark.read.text(f"{path}/artifact", wholetext=True).first()[0])
    tables = json.loads(spark.read.text(f"{path}/tables", wholetext=True).first()[0])
    for column, sizes in tables.items():
        table = spark.read.parquet(f"{path}/vocabulary/{column}").select("value", F.col("idx").cast("int"))
        encoders.columns[column] = Vocabulary(table=table, **sizes)
    return encoders, scaler
