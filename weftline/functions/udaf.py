"""User-defined aggregates in Python with map-side combining."""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys whose buffers a task holds before it sends them on.
MOST_KEYS = 20_000


class Aggregator(ABC):
    """An aggregate given by its buffer: start value, adding rows, merging, final result.

    Prefer built-in functions; this is for logic they cannot express. A buffer must stay small,
    as a task holds those of ``MOST_KEYS`` keys.
    """

    output_type: T.DataType

    @abstractmethod
    def zero(self) -> Any:
        """The buffer of no rows."""

    @abstractmethod
    def reduce(self, buffer: Any, rows: pd.DataFrame) -> Any:
        """The buffer after adding all ``rows`` of one key."""

    @abstractmethod
    def merge(self, left: Any, right: Any) -> Any:
        """The buffer of both parts together."""

    @abstractmethod
    def finish(self, buffer: Any) -> Any:
        """The result."""


def aggregate(
    df: DataFrame,
    keys: list[str],
    inputs: list[str],
    aggregator: Aggregator,
    into: str,
    lanes: int = 64,
    most_keys: int = MOST_KEYS,
) -> DataFrame:
    """Run an ``Aggregator`` per key in three steps: per task, per (key, lane), per key.

    ``inputs`` are columns other than the keys. Rows never leave their task: it keeps a buffer per key, and
    sends all it has to the shuffle whenever these are more than ``most_keys``. Buffers arrive sorted by
    key and are merged one after the other as they stream in, so that memory holds one at a time, however many
    a key has. The lanes keep the merge of a key that occurs in every task from being one long loop.
    """
    # As text, keys pass through pandas unchanged even if some are NULL.
    key_columns = ", ".join(f"`{k}` STRING" for k in keys)
    partial_schema = f"{key_columns}, __lane INT, __buffer BINARY"
    final_schema = f"{key_columns}, `{into}` {aggregator.output_type.simpleString()}"
    slim = df.select(
        *[F.col(k).cast("string").alias(k) for k in keys], *inputs
    )

    # Plain closures: they travel to the workers by value.
    def known(values):
        return tuple(None if v is None or v != v else v for v in values)

    def partial(batches):
        held, sent, task = {}, 0, TaskContext.get().partitionId()

        def all_held():
            lane = (task + sent) % lanes
            rows = [(*key, lane, pickle.dumps(buffer)) for key, buffer in held.items()]
            return pd.DataFrame(rows, columns=[*keys, "__lane", "__buffer"])

        for rows in batches:
            for key, part in rows.groupby(keys, dropna=False, sort=False):
                key = known(key)
                before = held[key] if key in held else aggregator.zero()
                held[key] = aggregator.reduce(before, part[inputs])
                if len(held) > most_keys:
                    yield all_held()
                    held, sent = {}, sent + 1
        yield all_held()

    def merging(columns, emit):
        """A task over buffers sorted by ``columns``: one row per key, made by ``emit``."""

        def merge(batches):
            at = buffer = None
            for rows in batches:
                made = []
                for *values, blob in rows[[*columns, "__buffer"]].itertuples(index=False, name=None):
                    key, one = known(values), pickle.loads(blob)
                    if key == at:
                        buffer = aggregator.merge(buffer, one)
                        continue
                    if at is not None:
                        made.append(emit(at, buffer))
                    at, buffer = key, one
                if made:
                    yield made
            if at is not None:
                yield [emit(at, buffer)]

        return merge

    in_lanes = merging([*keys, "__lane"], lambda key, buffer: (*key, pickle.dumps(buffer)))
    in_all = merging(keys, lambda key, buffer: (*key, aggregator.finish(buffer)))

    def combine(batches):
        for rows in in_lanes(batches):
            yield pd.DataFrame(rows, columns=[*keys, "__lane", "__buffer"])

    def final(batches):
        for rows in in_all(batches):
            yield pd.DataFrame(rows, columns=[*keys, into])

    def sorted_by(buffers, columns):
        return buffers.repartition(*columns).sortWithinPartitions(*columns)

    partials = slim.mapInPandas(partial, partial_schema)
    combined = sorted_by(partials, [*keys, "__lane"]).mapInPandas(combine, partial_schema)
    results = sorted_by(combined, keys).mapInPandas(final, final_schema)
    return results.select(*[F.col(k).cast(df.schema[k].dataType).alias(k) for k in keys], into)
