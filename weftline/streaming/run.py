"""Running a stream over all available input and reading its result as a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from threading import Event
from time import monotonic, sleep

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from weftline.session import scratch

MODES = ("append", "update", "complete")
# State partitions of a new stateful query on a cluster. Spark keeps one metric per partition and state store, and every
# task of a micro-batch sends all of them to the driver, so what a batch sends grows with the square of this number.
STATE_PARTITIONS = 128


@dataclass
class StreamResult:
    """What a finished stream wrote, in the shared folder."""

    spark: SparkSession
    path: str
    schema: T.StructType
    mode: str
    batches: list[int] = field(default_factory=list)
    progress: list = field(default_factory=list)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def rows(self) -> DataFrame:
        """Append mode: every row. Complete mode: the last full result."""
        if self.mode == "append":
            return self.spark.read.schema(self.schema).parquet(self.path)
        if self.mode == "update":
            raise ValueError("update mode writes versions of a row: use latest(keys)")
        if not self.batches:
            return self._empty()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={max(self.batches)}")

    def versions(self) -> DataFrame:
        """Update mode: every emitted version, with its ``batch`` number."""
        schema = T.StructType([*self.schema, T.StructField("batch", T.LongType())])
        if not self.batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def latest(self, keys: Sequence[str]) -> DataFrame:
        """Update mode: the last version per key, as an upsert would leave it."""
        data = [c for c in self.schema.names if c not in keys]
        last = self.versions().groupBy(*keys).agg(F.max_by(F.struct(*data), "batch").alias("row"))
        return last.select(*keys, *[f"row.{c}" for c in data])


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the block; a query keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def state_partitions(spark: SparkSession) -> dict[str, str]:
    """The setting for a new stateful query: on a local master, no more state partitions than cores.

    Each costs a commit per micro-batch. The count is fixed by the first start of a checkpoint, so on a
    cluster it does not follow the cores at that time, nor the session's number, which is meant for batch
    shuffles: it is ``STATE_PARTITIONS``. Give ``conf`` to ``start`` or ``run`` for another number.
    """
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.sparkContext.master.startswith("local["):
        return {"spark.sql.shuffle.partitions": str(min(wanted, max(2, spark.sparkContext.defaultParallelism)))}
    return {"spark.sql.shuffle.partitions": str(STATE_PARTITIONS)}


class ProgressLog(StreamingQueryListener):
    """Every progress report of the queries started here, by run; Spark itself keeps the last 100."""

    def __init__(self) -> None:
        self.reports: dict[str, list] = {}
        self.ended: dict[str, Event] = {}

    def expect(self, run: str) -> None:
        self.reports.setdefault(run, [])
        self.ended.setdefault(run, Event())

    def onQueryStarted(self, event) -> None:
        self.expect(str(event.runId))

    def onQueryProgress(self, event) -> None:
        self.expect(str(event.progress.runId))
        self.reports[str(event.progress.runId)].append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.expect(str(event.runId))
        self.ended[str(event.runId)].set()

    def take(self, run: str) -> list | None:
        """All reports of a run that has ended, once; None if it was not started here."""
        if run not in self.ended:
            return None
        # Events come in order, so the end comes after the last report.
        if not self.ended[run].wait(60):
            raise TimeoutError("the end of a query was not reported")
        del self.ended[run]
        return self.reports.pop(run)


_logs: dict[str, ProgressLog] = {}


def progress_log(spark: SparkSession) -> ProgressLog:
    """The session's log; it is attached at the first call."""
    key = f"{spark.sparkContext.applicationId}/{spark._jsparkSession.hashCode()}"
    if key not in _logs:
        _logs[key] = ProgressLog()
        spark.streams.addListener(_logs[key])
    return _logs[key]


def start(
    df: DataFrame,
    mode: str,
    path: str,
    checkpoint: str,
    name: str | None = None,
    every: str | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    conf: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start a query: parquet files in append mode, else one folder per micro-batch.

    Without ``every`` the query handles what is there and ends. A repeated batch overwrites its
    own folder, so a restart after a failure leaves no duplicates. ``conf`` holds session settings
    for this query, besides those of ``state_partitions``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode}")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    if mode == "append" and on_batch is None:
        writer = writer.format("parquet").option("path", path)
    else:
        writer = writer.foreachBatch(on_batch or write)
    spark = df.sparkSession
    log = progress_log(spark)
    with settings(spark, {**state_partitions(spark), **(conf or {})}):
        query = writer.start()
    log.expect(str(query.runId))
    return query


def finish(query: StreamingQuery, timeout: float | None = None) -> list:
    """Wait for a query, raise its error, return all its progress reports.

    A query that is still running after ``timeout`` seconds is stopped, and a TimeoutError raised.
    """
    try:
        ended = True
        if timeout is None:
            query.awaitTermination()
        else:
            ended = query.awaitTermination(timeout)
        if query.exception() is not None:
            raise query.exception()
        if not ended:
            raise TimeoutError(f"the query had not ended after {timeout} seconds")
        for log in list(_logs.values()):
            reports = log.take(str(query.runId))
            if reports is not None:
                return reports
        return list(query.recentProgress)
    finally:
        query.stop()


def run(
    df: DataFrame, mode: str = "append", name: str | None = None, conf: Mapping[str, str] | None = None
) -> StreamResult:
    """Run a stream over all available input; state and result go to the shared folder."""
    spark = df.sparkSession
    path, checkpoint = scratch(spark, "stream"), scratch(spark, "checkpoint")
    batches: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        batches.append(number)

    on_batch = None if mode == "append" else write
    progress = finish(start(df, mode, path, checkpoint, name, on_batch=on_batch, conf=conf))
    return StreamResult(spark, path, df.schema, mode, batches, progress)


def run_until(
    df: DataFrame,
    done: Callable[[dict], bool],
    mode: str = "update",
    every: str = "1 second",
    timeout: float = 600,
    conf: Mapping[str, str] | None = None,
) -> StreamResult:
    """Run a stream that does not end by itself until ``done`` is true of a progress report, then stop it.

    For results that time itself brings about. A TimeoutError is raised after ``timeout`` seconds.
    """
    spark = df.sparkSession
    path, checkpoint = scratch(spark, "stream"), scratch(spark, "checkpoint")
    batches: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
        batches.append(number)

    query = start(df, mode, path, checkpoint, every=every, on_batch=write, conf=conf)
    try:
        end = monotonic() + timeout
        while query.exception() is None and not any(done(p) for p in query.recentProgress):
            if monotonic() > end:
                raise TimeoutError(f"the query had not come to its end after {timeout} seconds")
            sleep(0.2)
    finally:
        query.stop()
    return StreamResult(spark, path, df.schema, mode, sorted(batches), finish(query))


def run_all(streams: Sequence[tuple[str, DataFrame, str]]) -> dict[str, StreamResult]:
    """Run several (name, stream, mode) side by side in one session, each with its own checkpoint.

    As soon as any of them fails, the others are stopped and its error is raised.
    """
    started = []
    try:
        for name, df, mode in streams:
            spark = df.sparkSession
            path, checkpoint = scratch(spark, name), scratch(spark, f"{name}-checkpoint")
            query = start(df, mode, path, checkpoint, name)
            started.append((name, df, mode, path, query))
        results = {}
        while any(query.isActive for *_, query in started):
            for *_, query in started:
                if query.exception() is not None:
                    raise query.exception()
            sleep(0.2)
        for name, df, mode, path, query in started:
            progress = finish(query)
            numbers = [p["batchId"] for p in progress]
            results[name] = StreamResult(df.sparkSession, path, df.schema, mode, numbers, progress)
        return results
    finally:
        for *_, query in started:
            query.stop()
