"""Dropping repeated rows of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dedup(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The first row of each key; the state holds every key ever seen."""
    return stream.dropDuplicates(list(keys))


def dedup_in_time(stream: DataFrame, keys: Sequence[str], time: str, watermark: str) -> DataFrame:
    """The first row of each (key, time); late rows are dropped, old state is removed.

    A key that returns with another time is kept.
    """
    return stream.withWatermark(time, watermark).dropDuplicates([*keys, time])


def dedup_within(stream: DataFrame, keys: Sequence[str], time: str, watermark: str) -> DataFrame:
    """The first row of each key; repeats within the watermark delay are dropped."""
    return stream.withWatermark(time, watermark).dropDuplicatesWithinWatermark(list(keys))
