"""Score with a model Spark ML does not know, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def score_batches(df: DataFrame, inputs: list[str], predict: Callable[[pd.DataFrame], object]) -> DataFrame:
    """Add `prediction` and `probabilities` from `predict(frame of inputs)`.

    A table of class probabilities gives the first most likely class; a single probability per row gives
    class 1 above one half. Extension point only: built-in models never leave the JVM.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("prediction", T.LongType()),
            T.StructField("probabilities", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for batch in batches:
            shares = np.asarray(predict(batch[inputs]), dtype="float64")
            if shares.ndim == 1 or shares.shape[1] == 1:
                shares = shares.reshape(-1, 1)
                chosen = (shares[:, 0] > 0.5).astype("int64")
            else:
                chosen = shares.argmax(axis=1)
            yield batch.assign(prediction=chosen, probabilities=list(shares))

    return df.mapInPandas(run, schema)
