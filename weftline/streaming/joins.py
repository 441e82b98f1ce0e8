"""Joins of streams with tables and of streams with streams."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame

from weftline.operators.joins import interval_join, salted_join


def with_table(
    stream: DataFrame,
    table: DataFrame,
    stream_key: str,
    table_key: str,
    spread_by: Sequence[str],
    hot: Sequence = (),
    how: str = "inner",
) -> DataFrame:
    """Stream on the left, table on the right; stateless, so no watermark is needed.

    Streams run without AQE, so hot keys of the stream are to be named here.
    """
    if how not in ("inner", "left"):
        raise ValueError("with the stream on the left only inner and left can be decided")
    return salted_join(stream, table, stream_key, table_key, spread_by, hot, how)


def stream_equi_join(
    facts: DataFrame,
    unique: DataFrame,
    fact_key: str,
    unique_key: str,
    spread_by: Sequence[str],
    hot: Sequence = (),
) -> DataFrame:
    """Inner equi-join of two streams where the keys of ``unique`` occur once.

    Without a time bound the state keeps both streams for ever: only for streams that end. The
    facts of a hot key are spread over several state partitions.
    """
    warnings.warn("a stream join without a time bound keeps all rows as state", stacklevel=2)
    return salted_join(facts, unique, fact_key, unique_key, spread_by, hot)


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    seconds: int,
    watermark: str,
    how: str = "inner",
) -> DataFrame:
    """Pairs within the interval, with state bounded by the watermark and the time bounds.

    ``how="left"`` emits a left row without a partner once the watermark shows none can come.
    """
    return interval_join(
        left.withWatermark(left_time, watermark),
        right.withWatermark(right_time, watermark),
        left_key,
        right_key,
        left_time,
        right_time,
        seconds,
        how,
    )
