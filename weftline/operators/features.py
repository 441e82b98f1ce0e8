"""Preparing tables for regression models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Imputer, OneHotEncoder, RFormula, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.quantiles import quantiles


def missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<c>_na``: 1.0 where the column is NULL, else 0.0."""
    return df.select(
        "*", *[F.when(F.col(c).isNull(), 1.0).otherwise(0.0).alias(f"{c}_na") for c in columns]
    )


def impute_median(df: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Replace NULL by the column's median: MLlib's approximate one, or the exact one."""
    if not exact:
        return Imputer(strategy="median", inputCols=list(columns), outputCols=list(columns)).fit(
            df
        ).transform(df)
    for c in columns:
        median = quantiles(df.select(c), c, {"m": 0.5}, interpolate=False).scalar()
        df = df.withColumn(c, F.coalesce(F.col(c), median))
    return df


def split_by_type(df: DataFrame, leave_out: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """Names of the text columns and of the numeric columns."""
    fields = [f for f in df.schema if f.name not in leave_out]
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    return text, numeric


def indexer(columns: Sequence[str], invalid: str = "skip") -> StringIndexer:
    """Text to index by falling frequency; unseen and NULL values are skipped by default."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid=invalid
    )


def one_hot(columns: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_hot" for c in columns]
    )


def assembler(columns: Sequence[str], into: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=into)


def formula(text: str, features: str = "features", label: str = "label") -> RFormula:
    return RFormula(formula=text, featuresCol=features, labelCol=label, handleInvalid="skip")
