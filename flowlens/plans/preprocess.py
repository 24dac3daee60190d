"""Fit/apply preprocessing and the registry of named feature sets.

`fit` runs two jobs over disjoint columns (categories, then numerics), so the input is read about once
in total. `transform` adds projections only: no shuffle beyond what the feature step itself needs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import features as fx
from ..operators.encoders import Encoders, apply_encoders, fit_encoders
from ..operators.scalers import POPULATION, SAMPLE, ScalerSpec, Stats, apply_scaler, fit_scaler
from ..operators.sessions import SkewOptions, add_session_features
from ..schemas import CATEGORICAL, NUMERIC, RICH_CATEGORICAL, RICH_NUMERIC, TARGET
from ..session import scratch_path
from ..sources.artifact import load_artifact, save_artifact

FeatureStep = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class FeatureSet:
    """A feature step, the columns to encode and scale, and how."""

    name: str
    step: FeatureStep
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    scaler: ScalerSpec = SAMPLE
    encode_in_place: bool = False
    fit_fill: float | None = None
    target: str = TARGET
    shuffles: bool = False

    def outputs(self) -> list[str]:
        indexed = [] if self.encode_in_place else [f"{c}_idx" for c in self.categorical]
        return indexed + [f"{c}_norm" for c in self.numeric]

    def fit(self, df: DataFrame) -> "FittedFeatures":
        return self.fit_prepared(self.step(df))

    def fit_prepared(self, prepared: DataFrame) -> "FittedFeatures":
        encoders = fit_encoders(prepared, list(self.categorical))
        if self.encode_in_place:
            prepared = apply_encoders(prepared, encoders, in_place=True)
        stats = fit_scaler(prepared, list(self.numeric), self.scaler, self.fit_fill)
        return FittedFeatures(self, encoders, stats)

    def fit_transform(self, df: DataFrame, keep: tuple[str, ...] = ()) -> tuple["FittedFeatures", DataFrame]:
        """Fit and transform the same frame. A feature step that shuffles is written to a shared table
        first, so the shuffle runs once and a lost executor costs a re-read, not a re-shuffle."""
        prepared = self.step(df)
        if self.shuffles:
            path = scratch_path(df.sparkSession, f"features-{self.name}")
            prepared.write.parquet(path)
            prepared = df.sparkSession.read.parquet(path)
        fitted = self.fit_prepared(prepared)
        return fitted, fitted.transform_prepared(prepared, keep)


@dataclass
class FittedFeatures:
    features: FeatureSet
    encoders: Encoders
    stats: Stats

    def transform(
        self, df: DataFrame, keep: tuple[str, ...] = (), fill_null: float | None = None, target: bool = True
    ) -> DataFrame:
        """Indexed and scaled columns, plus `keep`, plus the target where the input has one."""
        return self.transform_prepared(self.features.step(df), keep, fill_null, target)

    def transform_prepared(
        self, prepared: DataFrame, keep: tuple[str, ...] = (), fill_null: float | None = None, target: bool = True
    ) -> DataFrame:
        spec = self.features
        encoded = apply_encoders(prepared, self.encoders, in_place=spec.encode_in_place)
        # A column the artifact has no statistics for passes unscaled (mean 0, deviation 1).
        stats = {c: self.stats.get(c, {"mean": 0.0, "std": 1.0}) for c in spec.numeric}
        scaled = apply_scaler(encoded, stats, spec.scaler, spec.fit_fill)
        names = [*keep, *[c for c in spec.outputs() if c in scaled.columns]]
        if target and spec.target in scaled.columns:
            names.append(spec.target)
        result = scaled.select(*names)
        if fill_null is not None:
            filled = [c for c in spec.outputs() if c.endswith("_norm")]
            result = result.withColumns({c: F.coalesce(F.col(c), F.lit(fill_null)) for c in filled})
        return result

    def transform_for_inference(self, df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """As served: nulls become 0 after scaling, no target."""
        return self.transform(df, keep, fill_null=0.0, target=False)

    def save(self, spark: SparkSession, path: str) -> None:
        save_artifact(spark, path, self.encoders, self.stats)


REGISTRY: dict[str, Callable[..., FeatureSet]] = {}


def register(name: str) -> Callable[[Callable[..., FeatureSet]], Callable[..., FeatureSet]]:
    def add(factory: Callable[..., FeatureSet]) -> Callable[..., FeatureSet]:
        REGISTRY[name] = factory
        return factory

    return add


def feature_set(name: str, **options) -> FeatureSet:
    """A feature set by name, as job parameters select it."""
    if name not in REGISTRY:
        raise ValueError(f"unknown feature set {name!r}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name](**options)


def load_fitted(spark: SparkSession, path: str, name: str = "deployed", **options) -> FittedFeatures:
    encoders, stats = load_artifact(spark, path)
    return FittedFeatures(feature_set(name, **options), encoders, stats)


@register("deployed")
def deployed() -> FeatureSet:
    return FeatureSet("deployed", fx.deployed_features, tuple(CATEGORICAL), tuple(NUMERIC))


def rich_features(df: DataFrame, tie: str | None = "flow_id", skew: SkewOptions = SkewOptions()) -> DataFrame:
    base = fx.add(
        df,
        {"timestamp_epoch": F.col("timestamp").cast("long")},
        fx.log_volume_features(),
        fx.ratio_features(),
        fx.session_id("-"),
    )
    return add_session_features(base, tie=tie, options=skew)


@register("rich_sessions")
def rich_sessions(tie: str | None = "flow_id", skew: SkewOptions = SkewOptions()) -> FeatureSet:
    return FeatureSet(
        "rich_sessions",
        lambda df: rich_features(df, tie, skew),
        tuple(RICH_CATEGORICAL),
        tuple(RICH_NUMERIC),
        scaler=POPULATION,
        encode_in_place=True,
        fit_fill=0.0,
        shuffles=True,
    )
