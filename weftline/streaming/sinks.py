"""Writers for micro-batches: several places, an external table, a keyed table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.lake import snapshot
from weftline.session import reuse

BatchWriter = Callable[[DataFrame, int], None]


def parquet_writer(path: str, files: int | None = None) -> BatchWriter:
    """One folder per micro-batch, overwritten if the batch is repeated."""

    def write(batch: DataFrame, number: int) -> None:
        out = batch.coalesce(files) if files else batch
        out.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def to_all(writers: Sequence[BatchWriter], skip_empty: bool = True) -> BatchWriter:
    """Compute a micro-batch once and give it to several writers."""

    def write(batch: DataFrame, number: int) -> None:
        with reuse(batch) as kept:
            if skip_empty and kept.isEmpty():
                return
            for one in writers:
                one(kept, number)

    return write


def upsert_writer(path: str) -> BatchWriter:
    """Record a micro-batch of changed rows in a change log; ``read_upserted`` resolves it.

    The cost of a batch depends on its own size, not on that of the table.
    """

    def write(batch: DataFrame, number: int) -> None:
        entries = batch.select("*", F.current_timestamp().alias("commit_ts"), F.lit("put").alias("op"))
        entries.write.mode("overwrite").parquet(f"{path}/version={number}")

    return write


def read_upserted(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], version: int | None = None
) -> DataFrame:
    """The keyed table that an ``upsert_writer`` has built up."""
    full = T.StructType(
        [
            *schema,
            T.StructField("commit_ts", T.TimestampType()),
            T.StructField("op", T.StringType()),
            T.StructField("version", T.LongType()),
        ]
    )
    return snapshot(spark.read.schema(full).parquet(path), keys, version)
