"""Tasks per key that run by timers: periodic reports in event time, silence in processing time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

# Settings that queries with timers need; give them to ``run`` or ``start``.
TIMER_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
REPORT = "key string, period_end timestamp, n long, total double, n_so_far long, total_so_far double"
REPORT_COLUMNS = ("key", "period_end", "n", "total", "n_so_far", "total_so_far")
PERIODS = "n long, total double, reported long, ends array<long>, counts array<long>, sums array<double>"
SILENCE = "key string, was_active boolean, active boolean"


class PeriodicReport(StatefulProcessor):
    """At the end of every period of a key one report: what came in it, and all so far.

    State per key, in one value: sums of the periods still to be reported, by their end; and the sums of those
    reported. A timer stands at the end of each period with input and, as the task is periodic, of the ``after``
    periods that follow. With ``forget`` one more timer, so long after a report, drops the state of a key
    without later reports.
    """

    def __init__(self, period_ms: int, after: int, forget_ms: int | None):
        self.period, self.after, self.forget = period_ms, after, forget_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", PERIODS)

    def _get(self) -> tuple[int, float, int | None, dict[int, tuple[int, float]]]:
        if not self.state.exists():
            return 0, 0.0, None, {}
        n, total, reported, ends, counts, sums = self.state.get()
        return n, total, reported, dict(zip(ends, zip(counts, sums)))

    def _put(self, n: int, total: float, reported: int | None, due: dict[int, tuple[int, float]]) -> None:
        counts, sums = ([v[i] for v in due.values()] for i in (0, 1))
        self.state.update((n, total, reported, list(due), counts, sums))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        *done, due = self._get()
        known = set(due)
        for frame in rows:
            for period, n, total in zip(frame["period"].tolist(), frame["n"].tolist(), frame["total"].tolist()):
                for k in range(self.after + 1):
                    end = period + k * self.period
                    before = due.get(end, (0, 0.0))
                    due[end] = before if k else (before[0] + n, before[1] + total)
        for end in due.keys() - known:
            self.handle.registerTimer(end)
        self._put(*done, due)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = int(expiredTimerInfo.getExpiryTimeInMs())
        n, total, reported, due = self._get()
        if self.forget and reported is not None and reported + self.forget <= at:
            n, total, reported = 0, 0.0, None
        if at in due:
            now = due.pop(at)
            n, total, reported = n + now[0], total + now[1], at
            if self.forget:
                self.handle.registerTimer(at + self.forget)
            row = (key[0], pd.Timestamp(at, unit="ms"), *now, n, total)
            yield pd.DataFrame({name: [v] for name, v in zip(REPORT_COLUMNS, row)})
        if due or reported is not None:
            self._put(n, total, reported, due)
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def periodic_reports(
    stream: DataFrame,
    key: str,
    time: str,
    value: str,
    period_ms: int,
    watermark: str,
    after: int = 1,
    forget_ms: int | None = None,
) -> DataFrame:
    """A report per key at the end of each period, from its first row to ``after`` periods behind its last.

    Periods are multiples of ``period_ms`` since the epoch and are reported once the watermark has passed their
    end. Returns (key, period_end, n, total, n_so_far, total_so_far): rows and sum of ``value`` in the period and up
    to its end; the result does not depend on how input is cut into batches, unless rows are late. Rows without a time
    are left out; null values count as rows. Input is summed per key and period in each Arrow batch before the
    shuffle, so that a hot key reaches its state as a few rows a task. Sums so far begin anew once ``forget_ms`` of
    event time have passed since a key's last report. Append mode, with ``TIMER_SETTINGS``.
    """
    start = F.floor(F.unix_millis(time) / period_ms).cast("long")
    slim = stream.filter(F.col(time).isNotNull()).select(
        F.col(key).cast("string").alias("key"),
        ((start + 1) * period_ms).alias("period"),
        F.lit(1).cast("long").alias("n"),
        F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("total"),
        F.col(time).alias("at"),
    )

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            grouped = rows.groupby(["key", "period"], dropna=False, as_index=False)
            yield grouped.agg({"n": "sum", "total": "sum", "at": "max"})

    partial = slim.mapInPandas(reduce, slim.schema).withWatermark("at", watermark)
    made = partial.groupBy("key").transformWithStateInPandas(
        PeriodicReport(period_ms, after, forget_ms), REPORT, "append", "eventTime"
    )
    return made.withColumnRenamed("key", key).withColumn(key, F.col(key).cast(stream.schema[key].dataType))


class Silence(StatefulProcessor):
    """Whether a key is active; a key that stays silent for ``idle_ms`` is reported inactive, once, and forgotten."""

    def __init__(self, idle_ms: int):
        self.idle = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.status = handle.getValueState("status", "active boolean, place long, timer long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        active, place, timer = self.status.get() if self.status.exists() else (False, None, None)
        for frame in rows:
            frame = frame.dropna(subset=["place"])
            if len(frame):
                last = frame.loc[frame["place"].idxmax()]
                if place is None or int(last["place"]) >= place:
                    active, place = bool(last["active"]), int(last["place"])
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = int(timerValues.getCurrentProcessingTimeInMs()) + self.idle
        self.handle.registerTimer(timer)
        self.status.update((active, place, timer))
        yield pd.DataFrame({"key": [key[0]], "was_active": [active], "active": [active]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        was_active = self.status.get()[0]
        self.status.clear()
        yield pd.DataFrame({"key": [key[0]], "was_active": [was_active], "active": [False]})

    def close(self) -> None:
        pass


def idle_status(stream: DataFrame, key: str, active: str, place: str, idle_ms: int) -> DataFrame:
    """Per key whether it is active, by its newest non-null boolean ``active``; silence makes it inactive.

    Emits (key, was_active, active) per key and micro-batch with input, and once when the key has had no input for
    ``idle_ms`` of processing time, after which its state is gone. Before the shuffle each key is brought to
    one row per Arrow batch, its newest change. Update mode, with ``TIMER_SETTINGS``.
    """
    kind: StructType = stream.schema
    slim = stream.select(
        F.col(key).cast("string").alias("key"),
        F.col(active).alias("active"),
        F.when(F.col(active).isNotNull(), F.col(place).cast("long")).alias("place"),
    )

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.sort_values("place", na_position="first").groupby("key", dropna=False).tail(1)

    newest = slim.mapInPandas(reduce, slim.schema)
    made = newest.groupBy("key").transformWithStateInPandas(Silence(idle_ms), SILENCE, "update", "processingTime")
    return made.withColumnRenamed("key", key).withColumn(key, F.col(key).cast(kind[key].dataType))
