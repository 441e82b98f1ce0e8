"""Filters whose bound comes from the data, and null-aware predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.quantiles import quantiles


def not_equal_keep_null(column: Column, value) -> Column:
    """True where the column is NULL or differs, unlike ``!=`` which drops NULL."""
    return ~column.eqNullSafe(F.lit(value))


def below_fraction_of_max(df: DataFrame, column: str, fraction: float) -> DataFrame:
    """Rows below a fraction of the column's maximum, as one plan with a scalar subquery."""
    bound = df.agg((F.max(column) * fraction).alias("bound")).scalar()
    return df.filter(F.col(column) < bound)


def above_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """Rows strictly above the interpolated quantile ``p`` of the column."""
    bound = quantiles(df.select(column), column, {"bound": p}).scalar()
    return df.filter(F.col(column) > bound)


def last_days(df: DataFrame, time: str, days: int, as_of: Column | None = None) -> DataFrame:
    """Rows on or after midnight ``days`` days before the newest row, or before ``as_of``."""
    if as_of is None:
        start = df.agg(F.date_sub(F.max(time).cast("date"), days).cast("timestamp_ntz").alias("d"))
        return df.filter(F.col(time).cast("timestamp_ntz") >= start.scalar())
    start = F.date_sub(as_of.cast("date"), days).cast("timestamp_ntz")
    return df.filter(F.col(time).cast("timestamp_ntz") >= start)
