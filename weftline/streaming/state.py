"""Per-key state: whether a user is active, with alerts and time-outs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

# The actions that change a status, and the alert text.
ACTIVE_ACTION = "move"
INACTIVE_ACTION = "idle"
ALERT = "User is inactive"

STATE = "active boolean, order long, seen long"
FIRST = -(2**62)
UNCHANGED = -1


def last_status(stream: DataFrame, key: str, action: str, order: str) -> DataFrame:
    """Whether each key is active by its newest status change, as a built-in aggregate.

    Update mode emits (key, active) once per key and micro-batch. This needs no Python; use
    ``track_status`` for alerts and time-outs.
    """
    is_change = F.col(action).isin(ACTIVE_ACTION, INACTIVE_ACTION)
    newest = F.max_by(F.col(action) == ACTIVE_ACTION, F.when(is_change, F.col(order)))
    return stream.groupBy(key).agg(F.coalesce(newest, F.lit(False)).alias("active"))


def _last_actions(df: DataFrame, key: str, action: str, order: str, time: str | None, alerts: bool) -> DataFrame:
    """Per Arrow batch and key one row: the newest status change and the newest time.

    With ``alerts`` also the first action (``began`` at ``first``) and whether any was "idle".

    This runs before the shuffle, so a hot key reaches its state task as a few rows per input
    task, not as all its events.
    """
    schema = "key string, change int, order long" + (", event_time timestamp" if time else "")
    schema += ", first long, began int, idled boolean" if alerts else ""
    slim = df.select(
        # As text a key passes through pandas unchanged even if some keys are NULL.
        F.col(key).cast("string").alias("key"),
        F.when(F.col(action) == ACTIVE_ACTION, 1)
        .when(F.col(action) == INACTIVE_ACTION, 0)
        .otherwise(UNCHANGED)
        .alias("change"),
        F.coalesce(F.col(order).cast("long"), F.lit(FIRST)).alias("order"),
        *([F.col(time).alias("event_time")] if time else []),
    )

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if rows.empty:
                continue
            if alerts:
                opening = rows.sort_values(["order", "change"]).groupby("key", dropna=False)
                rows["first"], rows["began"] = opening["order"].transform("first"), opening["change"].transform("first")
                rows["idled"] = (rows["change"] == 0).groupby(rows["key"], dropna=False).transform("any")
            # Status changes sort behind other actions, so the last row of a key is its newest change.
            rows["is_change"] = rows["change"] != UNCHANGED
            if time:
                rows["event_time"] = rows.groupby("key", dropna=False)["event_time"].transform("max")
            rows = rows.sort_values(["is_change", "order"], kind="stable")
            last = rows.groupby("key", dropna=False, sort=False).tail(1)
            yield last.drop(columns="is_change")

    return slim.mapInPandas(reduce, schema)


def _merge(frames: Iterator[pd.DataFrame], active: bool, order: int, seen: int):
    """State after the partial rows of a key, which may come in any order, the first action, and whether any was "idle"."""
    opening, idled = (2**62, 1), False
    for frame in frames:
        if "idled" in frame:
            opening = min(opening, *zip(frame["first"].tolist(), frame["began"].tolist()))
            idled = idled or bool(frame["idled"].any())
        for change, place in zip(frame["change"].tolist(), frame["order"].tolist()):
            if change != UNCHANGED and place >= order:
                active, order = change == 1, place
        if "event_time" in frame:
            newest = frame["event_time"].max()
            if not pd.isna(newest):
                seen = max(seen, int(newest.timestamp() * 1000))
    return (active, order, seen), opening[1], idled


def track_status(
    stream: DataFrame,
    key: str,
    action: str,
    order: str,
    alerts: bool = False,
    time: str | None = None,
    watermark: str | None = None,
    event_timeout_ms: int | None = None,
    idle_ms: int | None = None,
) -> DataFrame:
    """Whether each key is active: "move" makes it so, "idle" not, other actions change nothing.

    Emits (key, active) once per key and micro-batch in update mode. With ``alerts`` it emits, in append
    mode, at most one message (key, message) per key and micro-batch: if any of its actions is "idle", or
    if the very first action of the key is not "move". ``order`` ranks the actions of a key, so neither the
    status nor the set of alerts depends on how input that comes in this order is cut into batches.

    ``event_timeout_ms`` (with ``time`` and ``watermark``) or ``idle_ms`` of processing time sets a
    key that stays silent to inactive and forgets it. The event-time limit counts from the later
    of the watermark and the key's newest event.
    """
    if event_timeout_ms and not (time and watermark):
        raise ValueError("an event-time timeout needs time and watermark")
    if event_timeout_ms and idle_ms:
        raise ValueError("choose one kind of timeout")
    partial = _last_actions(stream, key, action, order, time, alerts)
    if event_timeout_ms:
        partial = partial.withWatermark("event_time", watermark)
        timeout = GroupStateTimeout.EventTimeTimeout
    elif idle_ms:
        timeout = GroupStateTimeout.ProcessingTimeTimeout
    else:
        timeout = GroupStateTimeout.NoTimeout
    second = "message string" if alerts else "active boolean"

    def emit(name, active: bool, alert: bool) -> Iterator[pd.DataFrame]:
        if not alerts:
            yield pd.DataFrame({"key": [name], "active": [active]})
        elif alert:
            yield pd.DataFrame({"key": [name], "message": [ALERT]})

    def update(group, frames, state):
        (name,) = group
        if state.hasTimedOut:
            state.remove()
            yield from emit(name, False, True)
            return
        known = state.exists
        (active, last, seen), began, idled = _merge(frames, *(state.get if known else (False, FIRST, 0)))
        state.update((active, last, seen))
        if event_timeout_ms:
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), seen) + event_timeout_ms)
        elif idle_ms:
            state.setTimeoutDuration(idle_ms)
        yield from emit(name, active, idled or (not known and began != 1))

    tracked = partial.groupBy("key").applyInPandasWithState(
        update, f"key string, {second}", STATE, "append" if alerts else "update", timeout
    )
    restored = F.col("key").cast(stream.schema[key].dataType).alias(key)
    return tracked.select(restored, "message" if alerts else "active")
