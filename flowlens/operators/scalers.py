"""Standardisers: one aggregate for all columns at fit time, literal arithmetic at apply time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScalerSpec:
    """How a deviation is measured and made safe to divide by."""

    population: bool = False
    epsilon: float = 0.0
    zero_to_one: bool = True


SAMPLE = ScalerSpec()
POPULATION = ScalerSpec(population=True)
# Fixed value: the small addition that keeps the fallback normaliser from dividing by zero.
FALLBACK = ScalerSpec(epsilon=1e-6, zero_to_one=False)

Stats = dict[str, dict[str, float]]


def scaler_aggregates(columns: list[str], spec: ScalerSpec, fill: float | None) -> list[Column]:
    deviation = F.stddev_pop if spec.population else F.stddev_samp
    aggregates = []
    for c in columns:
        value = F.col(c).cast("double")
        value = F.coalesce(value, F.lit(fill)) if fill is not None else value
        aggregates += [F.avg(value).alias(f"{c}|mean"), deviation(value).alias(f"{c}|std")]
    return aggregates


def fit_scaler(
    df: DataFrame, columns: list[str], spec: ScalerSpec = SAMPLE, fill: float | None = None
) -> Stats:
    """Mean and deviation of every column from a single pre-aggregated job."""
    row = df.agg(*scaler_aggregates(columns, spec, fill)).first().asDict()
    stats: Stats = {}
    for c in columns:
        mean, std = row[f"{c}|mean"], row[f"{c}|std"]
        if mean is None:
            raise ValueError(f"cannot fit a scaler on column {c!r}: it holds no values")
        std = 0.0 if std is None else std
        stats[c] = {"mean": mean, "std": 1.0 if spec.zero_to_one and std == 0.0 else std}
    return stats


def apply_scaler(
    df: DataFrame, stats: Stats, spec: ScalerSpec = SAMPLE, fill: float | None = None
) -> DataFrame:
    """Add `<column>_norm`. `fill` replaces nulls before scaling."""
    outputs = {}
    for c, s in stats.items():
        source = F.col(c) if fill is None else F.coalesce(F.col(c).cast("double"), F.lit(fill))
        outputs[f"{c}_norm"] = (source - F.lit(s["mean"])) / F.lit(s["std"] + spec.epsilon)
    return df.withColumns(outputs)


def stats_table(df: DataFrame, stats: Stats) -> DataFrame:
    """Tidy (column, mean, std)."""
    rows = [(c, s["mean"], s["std"]) for c, s in stats.items()]
    return df.sparkSession.createDataFrame(rows, "column string, mean double, std double")
