"""Streams from files: a table's own folder, or a table replayed in order."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.ranking import as_double
from weftline.operators.sets import union_all
from weftline.session import scratch

BATCH_BYTES = 512 * 2**30
SLICE, FILE = "__slice", "__file"


def table_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
    max_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Stream a parquet table from where it lies, oldest files first.

    Without a schema it is borrowed from a batch read. ``max_files``, else ``max_bytes``, bounds
    one micro-batch. File order is not time order, so put a watermark only on a ``replay``.
    """
    schema = schema if schema is not None else spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    # As a pattern the path may also name a single file, which a plain stream path may not.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def text_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of text files as a stream with one ``value`` column."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


@dataclass(frozen=True)
class Replay:
    """Files in the order in which a stream shall see them, one micro-batch per slice."""

    spark: SparkSession
    path: str
    schema: T.StructType
    files_per_slice: int
    slices: int

    def stream(self) -> DataFrame:
        return (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", self.files_per_slice)
            .parquet(f"{self.path}/*")
        )


def replay(
    df: DataFrame,
    order_by: str,
    slices: int = 3,
    rows_per_file: int = 5_000_000,
    rows_per_slice: int = 2_000_000_000,
) -> Replay:
    """Write ``df`` as slices of rising ``order_by`` and describe the stream over them.

    See ``replay_together``; here the slices are about equal in size.
    """
    return replay_together([(df, order_by)], slices, rows_per_file, rows_per_slice)[0]


def replay_together(
    sides: Sequence[tuple[DataFrame, str]],
    slices: int = 3,
    rows_per_file: int = 5_000_000,
    rows_per_slice: int = 2_000_000_000,
) -> list[Replay]:
    """Write each (table, order column) as slices that are cut at the same values for all of them.

    So the n-th micro-batch of a query over all streams holds the same span of every table. One scan of
    the order columns finds the cuts, which make the slices about equal in size in all; then each table is
    scanned and written once, dealt by slice and file. Large tables get more slices, so that
    a micro-batch stays bounded. NULL belongs to the first slice.
    """
    spark = sides[0][0].sparkSession
    seen = union_all([df.select(F.lit(i).alias("side"), as_double(df, c).alias("v")) for i, (df, c) in enumerate(sides)])
    sizes = [F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(len(sides))]

    def look(parts: int):
        shares = F.array(*[F.lit(i / parts) for i in range(1, parts)] or [F.lit(1.0)])
        return seen.agg(*sizes, F.max("v").alias("top"), F.percentile_approx("v", shares, 20 * parts).alias("cuts")).first()

    found = look(slices)
    rows = [found[f"n{i}"] for i in range(len(sides))]
    wanted = max(slices, math.ceil(sum(rows) / rows_per_slice))
    if wanted > slices:
        found = look(wanted)
    cuts = sorted({c for c in found["cuts"] or [] if math.isfinite(c) and c < found["top"]})
    return [
        _written(spark, df, c, cuts, max(1, math.ceil(n / (len(cuts) + 1) / rows_per_file)))
        for (df, c), n in zip(sides, rows, strict=True)
    ]


def _written(spark: SparkSession, df: DataFrame, order_by: str, cuts: list[float], files: int) -> Replay:
    """One pass over ``df``: each slice goes to its own folder, in ``files`` files."""
    path, value = scratch(spark, "replay"), as_double(df, order_by)
    number = F.coalesce(sum(((value > c).cast("int") for c in cuts), F.lit(0)), F.lit(0))
    part = F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")
    dealt = df.withColumns({SLICE: number, FILE: part})
    dealt = dealt.repartitionById((len(cuts) + 1) * files, F.col(SLICE) * files + F.col(FILE)).drop(FILE)
    dealt.write.partitionBy(SLICE).parquet(path)
    return Replay(spark, _put_in_order(spark, path, df.schema, len(cuts) + 1, files), df.schema, files, len(cuts) + 1)


def _put_in_order(spark: SparkSession, path: str, schema: T.StructType, slices: int, files: int) -> str:
    """The folder whose files are in order: give the files of later slices later times, which is the order a file stream follows.

    A slice with too few files gets empty ones, so that micro-batches end where slices end. Only names and
    times are touched, by the driver. A file system that keeps its own times gets the slices anew, one after the other.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path
    fs = folder(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def data(at: str) -> list:
        found = fs.listStatus(folder(at)) if fs.exists(folder(at)) else []
        return [f for f in found if f.getPath().getName().startswith("part-")]

    def fill(at: str) -> None:
        for _ in range(files - len(data(at))):
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(at)

    for i in range(slices):
        fill(f"{path}/{SLICE}={i}")
    first = int(time.time() - slices) * 1000
    for i in range(slices):
        for f in data(f"{path}/{SLICE}={i}"):
            fs.setTimes(f.getPath(), first + 1000 * i, -1)
    times = [(f.getModificationTime(), first + 1000 * i) for i in range(slices) for f in data(f"{path}/{SLICE}={i}")]
    if all(found == given for found, given in times):
        return path
    again = scratch(spark, "replay")
    for i in range(slices):
        made = spark.read.schema(schema).parquet(f"{path}/{SLICE}={i}")
        made.repartition(files).write.parquet(f"{again}/{SLICE}={i}")
        fill(f"{again}/{SLICE}={i}")
    return again


def replay_batches(batches: list[DataFrame]) -> Replay:
    """The given frames as the micro-batches of a stream, in list order."""
    spark = batches[0].sparkSession
    path = scratch(spark, "replay")
    for i, batch in enumerate(batches):
        batch.coalesce(1).write.parquet(f"{path}/{i:04d}")
    return Replay(spark, path, batches[0].schema, 1, len(batches))
