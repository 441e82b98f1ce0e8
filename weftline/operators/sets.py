"""Unions and table comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def labelled_slices(df: DataFrame, slices: Sequence[tuple[str, Column]], into: str) -> DataFrame:
    """One row per slice a row belongs to, from one scan.

    Equal to the union of one filtered copy of ``df`` per slice: a row that meets several
    conditions appears once for each of them.
    """
    labels = F.array_compact(F.array(*[F.when(cond, F.lit(label)) for label, cond in slices]))
    return df.withColumn(into, F.explode(labels))


def with_scaled_copy(df: DataFrame, column: str, factor: float) -> DataFrame:
    """Each row twice, as it is and with ``column`` scaled; one scan, streaming-safe."""
    versions = F.array(F.col(column), F.col(column) * factor)
    return df.withColumn(column, F.explode(versions)).select(*df.columns)


def table_difference(left: DataFrame, right: DataFrame, into: str = "side") -> DataFrame:
    """Rows that one table has more often than the other, with the side that has them.

    Equal to ``exceptAll`` in both directions, but as one map-side combined count: each table is
    read and shuffled once.
    """
    weight = "__weight"
    both = left.withColumn(weight, F.lit(1)).union(right.select(*left.columns).withColumn(weight, F.lit(-1)))
    counts = both.groupBy(*left.columns).agg(F.sum(weight).alias(weight)).filter(F.col(weight) != 0)
    side = F.when(F.col(weight) > 0, "left").otherwise("right")
    copies = F.array_repeat(side, F.abs(F.col(weight)).cast("int"))
    return counts.select(*left.columns, F.explode(copies).alias(into))
