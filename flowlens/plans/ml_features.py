"""The 20-input feature set as a Spark ML Pipeline of built-in stages."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from ..functions import features as fx
from ..operators.sessions import SkewOptions, add_session_features
from ..schemas import CATEGORICAL, ML_INPUTS


def ml_features(df: DataFrame, tie: str | None = "flow_id", skew: SkewOptions = SkewOptions()) -> DataFrame:
    base = fx.add(
        df,
        fx.time_features(),
        fx.port_features(),
        fx.log_volume_features(),
        fx.ratio_features(),
        fx.protocol_conn(),
        fx.session_id("_"),
    )
    return add_session_features(base, tie=tie, aggregates=False, options=skew)


def ml_stages() -> Pipeline:
    indexed = [f"{c}_idx" for c in CATEGORICAL]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep"),
            VectorAssembler(inputCols=ML_INPUTS, outputCol="features_vec"),
            StandardScaler(inputCol="features_vec", outputCol="features_scaled", withMean=True, withStd=True),
        ]
    )


def fit_ml(df: DataFrame, **options) -> PipelineModel:
    return ml_stages().fit(ml_features(df, **options))


def transform_ml(model: PipelineModel, df: DataFrame, **options) -> DataFrame:
    return model.transform(ml_features(df, **options))
