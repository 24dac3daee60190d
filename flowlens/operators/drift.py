"""Drift scenarios: relabelling, covariate shift, signature coverage, scenario scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import class_name, clip
from ..functions.rules import concept_scores, first_argmax, signature_flags, softmax
from ..schemas import CLASS_NAMES, RANGES, TARGET

# Spread of the random covariate shift.
BYTES_SIGMA = 0.20
PACKETS_SIGMA = 80.0


def with_rule_label(df: DataFrame, scores: list[Column], output: str = "prediction") -> DataFrame:
    """Label = first greatest score. Scores land in a column first, so noise is drawn once per row."""
    scored = df.withColumn("_scores", F.array(*scores))
    return scored.withColumn(output, first_argmax(F.col("_scores"))).drop("_scores")


def with_rule_probabilities(df: DataFrame, scores: list[Column]) -> DataFrame:
    """Rule as a model: `prediction` and softmax `probability`."""
    scored = df.withColumn("_scores", F.array(*scores))
    return scored.withColumns(
        {"prediction": first_argmax(F.col("_scores")), "probability": softmax(F.col("_scores"))}
    ).drop("_scores")


def relabel(df: DataFrame, noise: float = 0.0, seed: int = 42) -> DataFrame:
    """Replace the class by the concept rule's label; features stay."""
    return with_rule_label(df, concept_scores(noise, seed), TARGET)


def shift_fixed(df: DataFrame, bytes_factor: float, packet_offset: int) -> DataFrame:
    return _shift(df, F.lit(float(bytes_factor)), F.lit(float(packet_offset)))


def shift_random(df: DataFrame, seed: int = 42) -> DataFrame:
    """Scale bytes by a lognormal factor and move packets by a normal offset, then clip."""
    return _shift(df, F.exp(F.randn(seed) * BYTES_SIGMA), F.randn(seed + 1) * PACKETS_SIGMA)


def _shift(df: DataFrame, factor: Column, offset: Column) -> DataFrame:
    moved = df.withColumns(
        {"_bytes": F.col("bytes_transferred") * factor, "_packets": F.col("packet_count") + offset}
    )
    return moved.withColumns(
        {
            "bytes_transferred": clip(F.col("_bytes"), *RANGES["bytes_transferred"]),
            "packet_count": clip(F.col("_packets"), *RANGES["packet_count"]).cast("long"),
        }
    ).drop("_bytes", "_packets")


def scenarios(df: DataFrame, bytes_factor: float = 1.5, packet_offset: int = 80) -> DataFrame:
    """Every row three times - normal, data_drift, concept_drift - from a single scan."""
    labelled = with_rule_label(df, concept_scores(), "_concept")
    high_bytes, high_packets = RANGES["bytes_transferred"], RANGES["packet_count"]
    shifted_bytes = clip(F.col("bytes_transferred") * float(bytes_factor), *high_bytes)
    shifted_packets = clip(F.col("packet_count") + packet_offset, *high_packets).cast("long")

    def variant(name: str, volume: Column, packets: Column, label: Column) -> Column:
        return F.struct(
            F.lit(name).alias("scenario"),
            volume.alias("_bytes"),
            packets.alias("_packets"),
            label.cast("long").alias("_label"),
        )

    plain_bytes, plain_packets = F.col("bytes_transferred"), F.col("packet_count")
    variants = F.array(
        variant("normal", plain_bytes, plain_packets, F.col(TARGET)),
        variant("data_drift", shifted_bytes, shifted_packets, F.col(TARGET)),
        variant("concept_drift", plain_bytes, plain_packets, F.col("_concept")),
    )
    return (
        labelled.withColumn("_variant", F.explode(variants))
        .withColumns(
            {
                "scenario": F.col("_variant.scenario"),
                "bytes_transferred": F.col("_variant._bytes"),
                "packet_count": F.col("_variant._packets"),
                TARGET: F.col("_variant._label"),
            }
        )
        .drop("_variant", "_concept")
    )


def evaluate_scenarios(
    scenario_rows: DataFrame, score: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """(scenario, metric, value) of one fitted scorer over all scenarios."""
    from .evaluate import class_metrics, confusion_matrix, summary_metrics

    confusion = confusion_matrix(score(scenario_rows), by=["scenario"])
    return summary_metrics(class_metrics(confusion, ["scenario"]), ["scenario"])


def signature_coverage(df: DataFrame) -> DataFrame:
    """Per class, the share of rows inside each attack region."""
    flags = signature_flags()
    return (
        df.groupBy(TARGET)
        .agg(F.count("*").alias("n"), *[F.avg(c).alias(name) for name, c in flags.items()])
        .withColumn("name", class_name(F.col(TARGET), CLASS_NAMES))
    )
