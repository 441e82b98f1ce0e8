"""Hot keys of a stream, learned from what has come, and joins that spread them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.session import scratch
from weftline.streaming.joins import with_table
from weftline.streaming.run import StreamResult, finish, start


def reduced(counts: dict, size: int) -> dict:
    """A summary of at most ``size`` keys: each loses as many rows as the largest one that has to go."""
    if len(counts) <= size:
        return counts
    ranked = sorted(counts.values(), reverse=True)
    return {k: n - ranked[size] for k, n in counts.items() if n > ranked[size]}


class FrequentKeys:
    """A mergeable summary of frequent keys, carried from micro-batch to micro-batch below ``path``.

    Counts are never too large, and too small by ``lost`` at most, which is below rows / size; so no key with more
    than ``share`` of all rows so far is missed. Of a batch only its ``size + 1`` most frequent keys come to the driver.
    Batches are kept apart, so a repeated one replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str, kind: T.DataType, share: float):
        self.spark, self.path, self.share = spark, path, share
        self.size = math.ceil(4 / share)
        fields = [("key", kind), ("n", T.LongType()), ("lost", T.LongType()), ("rows", T.LongType()), ("batch", T.LongType())]
        self.schema = T.StructType([T.StructField(*f) for f in fields])

    def add(self, batch: DataFrame, key: str, number: int) -> None:
        """Merge a batch into the summary of the batches before it; null keys are only counted as rows."""
        counted = batch.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        known = counted.filter(F.col("key").isNotNull())
        most = known.orderBy(F.desc("n"), "key").limit(self.size + 1).collect()
        rows = batch.count()
        before, lost, earlier = self._at(number - 1)
        fresh = {r["key"]: r["n"] for r in most}
        cut = reduced(fresh, self.size)
        lost += 0 if len(fresh) <= self.size else min(fresh.values())
        both = {k: before.get(k, 0) + cut.get(k, 0) for k in {**before, **cut}}
        kept = reduced(both, self.size)
        lost += 0 if len(both) <= self.size else sorted(both.values(), reverse=True)[self.size]
        told = [(k, n, lost, earlier + rows) for k, n in kept.items()] or [(None, 0, lost, earlier + rows)]
        table = self.spark.createDataFrame(told, T.StructType(self.schema.fields[:-1]))
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def hot(self, number: int) -> list:
        """Keys that may hold more than ``share`` of the rows up to a batch."""
        counts, lost, rows = self._at(number)
        return sorted((k for k, n in counts.items() if n + lost > self.share * rows), key=repr)

    def _at(self, number: int) -> tuple[dict, int, int]:
        try:
            kept = self.spark.read.schema(self.schema).parquet(self.path).filter(F.col("batch") <= number)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}, 0, 0
        newest = kept.agg(F.max("batch")).first()[0]
        found = kept.filter(F.col("batch") == newest).collect() if newest is not None else []
        if not found:
            return {}, 0, 0
        return {r["key"]: r["n"] for r in found if r["key"] is not None}, found[0]["lost"], found[0]["rows"]


def join_as_it_comes(
    stream: DataFrame,
    table: DataFrame,
    stream_key: str,
    table_key: str,
    spread_by: Sequence[str],
    columns: Sequence[str],
    how: str = "inner",
    share: float = 0.01,
) -> StreamResult:
    """Join a stream with a table, micro-batch by micro-batch, spreading the keys that are hot so far.

    Nothing has to be known of the stream before it runs: each batch is first counted by key into
    ``FrequentKeys`` and then joined with the rows of hot keys salted (micro-batches run without AQE).
    The salts only spread work, so results do not depend on what is found hot. ``columns`` are those kept.
    """
    spark = stream.sparkSession
    path, checkpoint = scratch(spark, "joined"), scratch(spark, "checkpoint")
    keys = FrequentKeys(spark, scratch(spark, "keys"), stream.schema[stream_key].dataType, share)

    def joined(batch: DataFrame, hot: Sequence = ()) -> DataFrame:
        return with_table(batch, table, stream_key, table_key, spread_by, hot, how).select(*columns)

    def on_batch(batch: DataFrame, number: int) -> None:
        keys.add(batch, stream_key, number)
        joined(batch, keys.hot(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")
        numbers.append(number)

    numbers: list[int] = []
    schema = joined(stream).schema
    progress = finish(start(stream, "append", path, checkpoint, on_batch=on_batch))
    return StreamResult(spark, path, schema, "update", sorted(set(numbers)), progress)
