"""Event-time windows, for batch and streams alike."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Combines the sessions of a key within each input task, before the shuffle.
MERGE_SESSIONS_EARLY = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """The column as a session-zone timestamp, as watermarks require."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def windowed(
    df: DataFrame,
    time: str,
    size: str,
    keys: Sequence[str] = (),
    aggregates: Mapping[str, Column] | None = None,
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Aggregates per event-time window and key; counts rows as ``n`` by default.

    Columns: ``window_start``, ``window_end`` (without zone), the keys and the aggregates.
    """
    aggregates = aggregates or {"n": F.count(F.lit(1))}
    if watermark:
        df = df.withWatermark(time, watermark)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    grouped = df.groupBy(window, *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return _flat(grouped, "window", keys, aggregates)


def session_windowed(
    df: DataFrame,
    time: str,
    gap: str,
    keys: Sequence[str],
    aggregates: Mapping[str, Column] | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Aggregates per gap-based session and key. For whole tables prefer ``sessions``."""
    aggregates = aggregates or {"n": F.count(F.lit(1))}
    if watermark:
        df = df.withWatermark(time, watermark)
    session = F.session_window(time, gap)
    grouped = df.groupBy(session, *keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return _flat(grouped, "session_window", keys, aggregates)


_LATE = "n long, late long, newest timestamp, watermark timestamp, batch long"


class LateCounter:
    """Counts exactly the rows that come behind the watermark, once per window they belong to.

    A streaming aggregate drops such rows after they have been combined in each task, so its own metric counts
    combined rows. Here each micro-batch is counted, in one pass with whatever ``write`` does with it, against the
    watermark that the earlier ones have set: the newest time seen less ``delay``. A window is late if it ends
    at the watermark or before. One small row per batch is kept below ``path``; a repeated batch replaces its own.
    """

    def __init__(self, spark: SparkSession, path: str, time: str, size: str, delay: str, slide: str | None = None):
        self.spark, self.path, self.time = spark, path, time
        self.size, self.delay, self.slide = size, delay, slide or size
        self.open: dict[int, tuple] = {}

    def on_batch(self, batch: DataFrame, number: int) -> None:
        """For ``foreachBatch``."""
        self.count(batch, number).write.mode("overwrite").format("noop").save()
        self.keep(number)

    def count(self, batch: DataFrame, number: int) -> DataFrame:
        """The batch with its counts observed; call ``keep`` when it has been written."""
        before = self._kept().filter(F.col("batch") < number)
        newest = before.agg((F.max("newest") - F.expr(f"INTERVAL {self.delay}")).alias("w")).first()["w"]
        mark = F.lit(newest).cast("timestamp")
        size, slide = (F.expr(f"INTERVAL {x}") for x in (self.size, self.slide))
        # The ends of all windows that may hold the row, the last to begin first.
        step, at = F.unix_micros(F.timestamp_micros(F.lit(0)) + slide), F.unix_micros(self.time)
        begin = F.timestamp_micros(at - F.pmod(at, step))
        ends = F.array(begin + size) if self.slide == self.size else F.sequence(begin + size, begin, -slide)
        late = F.size(F.filter(ends, lambda e: (e > F.col(self.time)) & (e <= mark)))
        rows = batch.withColumn("__late", F.lit(0) if newest is None else late)
        seen = Observation(f"late-{number}")
        counts = [F.count(F.lit(1)).alias("n"), F.sum("__late").alias("late"), F.max(self.time).alias("newest")]
        self.open[number] = (seen, newest)
        return rows.observe(seen, *counts).drop("__late")

    def keep(self, number: int) -> None:
        seen, newest = self.open.pop(number)
        found = seen.get
        row = [(found["n"], int(found["late"] or 0), found["newest"], newest)]
        kept = self.spark.createDataFrame(row, _LATE.removesuffix(", batch long")).coalesce(1)
        kept.write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def report(self) -> DataFrame:
        """(batch, n, late, watermark) of every batch."""
        return self._kept().select("batch", "n", "late", "watermark")

    def _kept(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LATE).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LATE)


def _flat(grouped: DataFrame, window: str, keys, aggregates) -> DataFrame:
    prefix = "window" if window == "window" else "session"
    return grouped.select(
        F.col(f"{window}.start").cast("timestamp_ntz").alias(f"{prefix}_start"),
        F.col(f"{window}.end").cast("timestamp_ntz").alias(f"{prefix}_end"),
        *keys,
        *aggregates,
    )
