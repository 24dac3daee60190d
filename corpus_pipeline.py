"""A corpus pipeline: five stages from `documents` to token ids. Each stage's rows are written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import jaccard, lines, mixing, pieces, quality
from flowlens.llm.common import documents, stored

#: Dropped rows up to this many are sent to every task; more are joined.
BROADCAST_IDS = 1 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without their site's boilerplate lines; n_chars is that of the new text."""
    cleaned = lines.drop_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: of those with the smallest id, null ids last, any one. Rows are told apart by
    a number, so that repeated and null ids drop nothing else; rows without words are in no group and stay."""
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.row_groups(numbered, "_row").filter("component IS NOT NULL").withColumnRenamed("doc_id", "_row")
    rows = stored(groups.join(numbered.select("_row", "doc_id"), "_row").select("_row", "doc_id", "component"), "grouped")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    firsts = rows.groupBy("component").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    several = firsts.select("component", F.col("first._row").alias("stays"))
    dropped = stored(rows.join(several, "component").filter("_row != stays").select("_row"), "dropped")
    dropped = F.broadcast(dropped) if dropped.count() <= BROADCAST_IDS else dropped
    return numbered.join(dropped, "_row", "left_anti").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixing.emit(mixing.mix(docs)).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    encoded = pieces.encode(docs.select("doc_id", "source", "text"))
    return encoded.selectExpr("doc_id", "source", "cast(size(ids) as bigint) AS n_tokens", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mixing", source_mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The groups of near copies and the ids cannot be put in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
