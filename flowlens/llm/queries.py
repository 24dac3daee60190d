"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import (
    audit,
    fingerprints,
    jaccard,
    licenses,
    lines,
    mixing,
    personal,
    pieces,
    pitman_yor,
    quality,
    repeats,
    toxicity,
    turns,
)
from flowlens.llm.common import documents


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(documents(spark, sf_dir))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(documents(spark, sf_dir))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it."""
    encoded = pieces.encode(documents(spark, sf_dir).select("doc_id", "text"), check=True)
    return encoded.selectExpr("doc_id", "cast(size(ids) as bigint) AS n_tokens", "ids", "round_trip")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is its site."""
    return lines.drop_boilerplate(documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_dropped")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find_personal(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [f"n_{kind}" for kind in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_texts(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), keep=("doc_id", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), labels(spark, sf_dir))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the places of the offending sentences."""
    return toxicity.score_texts(documents(spark, sf_dir), labels(spark, sf_dir))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damage_and_repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints,
        op2_ngram_jaccard,
        op3_sentencepiece,
        op4_line_dedup,
        op5_license_scan,
        op6_quality_rules,
        op7_personal_data,
        op8_substring_dedup,
        op9_pitman_yor,
        op10_mixing,
        op11_filter_audit,
        op12_toxicity,
        op13_conversations,
    )
}
