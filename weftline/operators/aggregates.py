"""Aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.quantiles import two_scan_quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def pivot_named(
    df: DataFrame,
    groups: Sequence[str],
    column: str,
    names: Mapping[object, str],
    aggregates: Mapping[str, Column],
) -> DataFrame:
    """Pivot with listed values; result columns are ``<name>_<aggregate>``.

    Listing the values saves the pass that would look for them.
    """
    out = (
        df.groupBy(*groups)
        .pivot(column, list(names))
        .agg(*[agg.alias(alias) for alias, agg in aggregates.items()])
    )
    single = len(aggregates) == 1
    renames = {
        (str(value) if single else f"{value}_{alias}"): f"{name}_{alias}"
        for value, name in names.items()
        for alias in aggregates
    }
    return out.withColumnsRenamed(renames)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_<c>`` and ``max_<c>`` for every column, from one scan."""
    return df.agg(
        *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    )


def top_n_array(df: DataFrame, column: str, n: int, into: str) -> DataFrame:
    """One row: the ``n`` most frequent values as an array, most frequent first, ties by value."""
    best = (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(column).asc())
        .limit(n)
    )
    pairs = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(column).alias("v"))))
    return best.agg(F.transform(pairs, lambda p: p["v"]).alias(into))


def approximate_quantiles(
    df: DataFrame, value: str, quantiles: Mapping[str, float], groups: Sequence[str] = (), accuracy: int = 1000
) -> DataFrame:
    """Quantiles whose rank is off by at most ``1 / accuracy`` of the rows, from one mergeable sketch."""
    found = F.percentile_approx(value, list(quantiles.values()), accuracy)
    sketched = df.groupBy(*groups).agg(found.alias("__q"))
    return sketched.select(*groups, *[F.col("__q")[i].alias(name) for i, name in enumerate(quantiles)])


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: n, mean, stddev, min, quartiles (exact, as data values), max.

    The plain statistics of all columns come from one scan, the quartiles from two others.
    """
    plain = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(c).cast("double").alias(f"{c}__{s}") for c in columns for s, f in plain.items()])
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in plain])
        for c in columns
    ]
    stats = wide.select(F.inline(F.array(*rows))).withColumn("n", F.col("n").cast("long"))
    quartiles = two_scan_quantiles(
        df.select(*[F.col(c).cast("double").alias(c) for c in columns]), {c: QUARTILES for c in columns}, interpolate=False
    )
    joined = stats.join(quartiles, "column_name")
    return joined.select("column_name", "n", "mean", "stddev", "min", *QUARTILES, "max")


def chi_square(df: DataFrame, first: str, second: str) -> DataFrame:
    """Independence test of two columns: p-value, degrees of freedom and statistic."""
    indexed = StringIndexer(
        inputCols=[first, second], outputCols=["__first", "__second"], handleInvalid="skip"
    ).fit(df).transform(df)
    features = VectorAssembler(inputCols=["__first"], outputCol="__features").transform(indexed)
    result = ChiSquareTest.test(features, "__features", "__second", flatten=True)
    return result.select(
        F.col("pValue").alias("p_value"),
        F.col("degreesOfFreedom").alias("degrees_of_freedom"),
        "statistic",
    )
