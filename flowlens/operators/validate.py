"""Column contract and record validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.features import clip
from ..schemas import CATEGORIES, MODEL_INPUTS, RANGES, SPLITS, TARGET


def check_split(split: str) -> str:
    if split not in SPLITS:
        raise ValueError(f"split must be one of {', '.join(SPLITS)}; got {split!r}")
    return split


def missing_columns(df: DataFrame, target: str = TARGET) -> list[str]:
    present = set(df.columns)
    return [c for c in [*MODEL_INPUTS, target] if c not in present]


def require_contract(df: DataFrame, target: str = TARGET) -> DataFrame:
    missing = missing_columns(df, target)
    if missing:
        raise ValueError(f"training data lacks columns: {', '.join(missing)}")
    return df


def contract_report(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(column_name, present, n_rows, n_null) for every column the contract asks for.

    A column that is not there counts as null in every row.
    """
    expected = [*MODEL_INPUTS, target]
    missing = set(missing_columns(df, target))
    nulls = [
        F.count("*").alias(c) if c in missing else F.count_if(F.col(c).isNull()).alias(c)
        for c in expected
    ]
    counted = df.agg(F.count("*").alias("n_rows"), *nulls)
    pairs = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(c not in missing).alias("present"),
            F.col("n_rows"),
            F.col(c).alias("n_null"),
        )
        for c in expected
    ]
    return counted.select(F.inline(F.array(*pairs)))


def flow_rules() -> dict[str, Column]:
    """Rule name -> broken? Missing values break the `required` rule of their column only."""
    rules: dict[str, Column] = {}
    for c in [*RANGES, *CATEGORIES]:
        rules[f"{c}_required"] = F.col(c).isNull()
    for c, (low, high) in RANGES.items():
        rules[f"{c}_range"] = ~F.col(c).between(low, high)
    for c, values in CATEGORIES.items():
        rules[f"{c}_category"] = ~F.col(c).isin(values)
    return rules


def validate_records(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add `violations`: the names of all broken rules."""
    rules = flow_rules() if rules is None else rules
    broken = [F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]
    return df.withColumn("violations", F.array_compact(F.array(*broken)))


def valid_records(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") == 0).drop("violations")


def quarantined_records(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") > 0)


def validation_summary(validated: DataFrame) -> DataFrame:
    """(rule, n): how often each rule broke, `valid` for clean rows."""
    outcome = F.when(F.size("violations") == 0, F.array(F.lit("valid"))).otherwise(F.col("violations"))
    return (
        validated.select(F.explode(outcome).alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("n"))
    )


def clip_to_domain(df: DataFrame) -> DataFrame:
    """Clip packets and bytes to their domains."""
    outputs = {}
    for c in ("packet_count", "bytes_transferred"):
        low, high = RANGES[c]
        outputs[c] = clip(F.col(c), low, high).cast(df.schema[c].dataType)
    return df.withColumns(outputs)
