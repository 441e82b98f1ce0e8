"""Work on Arrow batches: one resource per partition, opaque predicates, model scoring, parsing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_partitions(
    df: DataFrame,
    open_resource: Callable[[], Any],
    use: Callable[[Any, pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    close: Callable[[Any], None] | None = None,
) -> DataFrame:
    """Transform batches with one resource per partition (a connection, a model), not per row.

    Batches are passed on as they come; no partition is held in memory as a whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_resource()
        try:
            for batch in batches:
                yield use(resource, batch)
        finally:
            if close:
                close(resource)

    return df.mapInPandas(run, schema)


def filter_opaque(df: DataFrame, columns: list[str], test: Callable[..., pd.Series]) -> DataFrame:
    """Keep rows by a Python predicate over whole column batches.

    Catalyst cannot see into it, so nothing is pushed to the scan: use column expressions if the
    condition can be written as one.
    """

    @F.pandas_udf(T.BooleanType())
    def keep(*series: pd.Series) -> pd.Series:
        return test(*series)

    return df.filter(keep(*columns))


def score_linear(
    df: DataFrame, features: list[str], weights: list[float], intercept: float, into: str
) -> DataFrame:
    """Predictions of a linear model in numpy, its weights set up once per task."""
    schema = T.StructType([*df.schema, T.StructField(into, T.DoubleType())])

    def load():
        import numpy

        return numpy.asarray(weights, dtype="float64")

    def predict(vector, batch: pd.DataFrame) -> pd.DataFrame:
        values = batch[features].to_numpy(dtype="float64") @ vector + intercept
        return batch.assign(**{into: values})

    return map_partitions(df, load, predict, schema)
