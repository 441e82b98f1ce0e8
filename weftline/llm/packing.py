"""Packing of token sequences into fixed windows with a bounded number of open windows."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.tokens import Encoder
from weftline.session import settle

# Windows that a partition keeps open.
OPEN = 64
# A gap of at least this many ids in the fullest window is filled with a cut; a smaller one is padded.
LEAST_CUT = 16
# Partitions whose left-over windows are merged by one task, round by round.
MERGED = 64
# Ids that are sent to Spark at once.
BATCH_IDS = 1 << 20

_PIECES = "doc_id long, start long, length long, doc_tokens long, window long, offset long, open boolean, ids binary"


class OpenWindows:
    """At most ``limit`` open windows of ``size`` places each; items go where they fit best."""

    def __init__(self, size: int, limit: int, first: int = 0):
        self.size, self.limit, self.next = size, limit, first
        self.room: list[tuple[int, int]] = []  # (free places, window), ascending

    def place(self, length: int) -> tuple[int, int, int]:
        """(window, offset, length placed); less than asked for if the item was cut to fill a window.

        Best fit: the fullest window that holds the item. If none does, a new window is opened, for
        which the fullest one is given out when all are open; a large enough gap there is filled first.
        """
        at = bisect_left(self.room, (length, -1))
        if at < len(self.room):
            free, window = self.room.pop(at)
            return self._put(window, free, length)
        if len(self.room) == self.limit:
            free, window = self.room.pop(0)
            if free >= LEAST_CUT:
                return window, self.size - free, free
        self.next += 1
        return self._put(self.next - 1, self.size, length)

    def _put(self, window: int, free: int, length: int) -> tuple[int, int, int]:
        if free > length:
            insort(self.room, (free - length, window))
        return window, self.size - free, length


def _pack_partition(batches, path: str, size: int, end_id: int | None, limit: int) -> Iterator[pa.RecordBatch]:
    encoder, windows = Encoder(path), OpenWindows(size, limit)
    base = TaskContext.get().partitionId() << 40
    rows: list[tuple] = []
    held = 0

    def out() -> pa.RecordBatch:
        docs, starts, lengths, totals, windows_, offsets, ids = zip(*rows, strict=True) if rows else [()] * 7
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.binary()]
        flags = [False] * len(rows)
        columns = [docs, starts, lengths, totals, windows_, offsets, flags, ids]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "start", "length", "doc_tokens", "window", "offset", "open", "ids"],
        )

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            ids = encoder.ids(text.as_py() or "")
            if end_id is not None:
                ids = np.append(ids, np.array([end_id], dtype="<u4"))
            start, doc = 0, doc.as_py()
            while start < len(ids):
                if len(ids) - start >= size:
                    window, offset, length = windows.next, 0, size
                    windows.next += 1
                else:
                    window, offset, length = windows.place(len(ids) - start)
                rows.append((doc, start, length, len(ids), base + window, offset, ids[start : start + length].tobytes()))
                start, held = start + length, held + length
                if held >= BATCH_IDS:
                    yield out()
                    rows, held = [], 0
    yield out()
    # One row without ids for each window that is still open.
    left = [(None, size - free, 0, 0, base + w, 0, b"") for free, w in windows.room]
    rows = left
    if rows:
        last = out()
        yield last.set_column(6, "open", pa.array([True] * len(left)))


def pack(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 2048,
    end_id: int | None = 1,
    limit: int = OPEN,
) -> DataFrame:
    """Pieces of documents placed in sequences of at most ``size`` ids, with the ids as bytes.

    Each partition cuts off full windows, and keeps at most ``limit`` windows open for the rest of each
    document: best fit, and when none fits the fullest is given out, with a cut that fills it if at
    least ``LEAST_CUT`` places are free. Left-over windows of ``MERGED`` partitions at a time are then
    merged as whole items, round by round, until one group is left; only their sizes move.

    One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned
    32-bit). Each id lies in one piece, and the offsets of a sequence have no gap. Null or empty texts
    consist of the end id alone, and give no row without one. Repeated rows and ids are packed row by
    row; a null id stays null. Other columns are ignored. Sequence ids are unique, not consecutive.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias(text_col)).mapInArrow(
        lambda batches: _pack_partition(batches, path, size, end_id, limit), _PIECES
    )
    pieces = settle(rows, "pieces")
    left = pieces.filter("open").select("window", F.col("start").alias("used"), (F.shiftright("window", 40)).alias("part"))
    moved = settle(left.select("window", F.col("window").alias("target"), F.lit(0).cast("long").alias("shift"), "used", "part"), "left")
    while moved.select("part").distinct().limit(2).count() > 1:
        heads = moved.groupBy("target").agg(F.max(F.col("shift") + F.col("used")).alias("used"), F.min("part").alias("part"))
        roomy = heads.filter(F.col("used") * 8 <= 7 * size)
        groups = roomy.select(F.col("target").alias("window"), "used", F.floor(F.col("part") / MERGED).alias("part"))
        parts = groups.groupBy("part").agg(F.collect_list(F.struct("window", "used")).alias("items"))
        again = _merge(parts, size)
        moved = settle(
            moved.withColumnRenamed("target", "middle")
            .withColumnRenamed("shift", "before")
            .join(again.withColumnRenamed("window", "middle"), "middle", "left")
            .select(
                "window",
                F.coalesce("target", "middle").alias("target"),
                (F.col("before") + F.coalesce("shift", F.lit(0))).alias("shift"),
                "used",
                F.floor(F.col("part") / MERGED).alias("part"),
            ),
            "left",
        )
    places = moved.select("window", "target", "shift")
    return (
        pieces.filter("not open")
        .join(places, "window", "left")
        .select(
            "doc_id", "start", "length", "doc_tokens",
            F.coalesce("target", "window").alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
            "ids",
        )
    )


def _merge(parts: DataFrame, size: int) -> DataFrame:
    """Left-over windows of each group, as whole items, by falling size where they fit best.

    (window, target, shift): the window now lies in ``target``, ``shift`` places on. Windows that are
    more than seven eighths full take no further part, so groups stay small round by round.
    """

    def work(batches):
        for batch in batches:
            for items in batch.column(0).to_pylist():
                room: list[tuple[int, int]] = []
                placed = []
                for x in sorted(items, key=lambda x: (-x["used"], x["window"])):
                    used, window = x["used"], x["window"]
                    at = bisect_left(room, (used, -(1 << 62)))
                    free, target = room.pop(at) if at < len(room) else (size, window)
                    placed.append((window, target, size - free))
                    if free > used:
                        insort(room, (free - used, target))
                cols = list(zip(*placed, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=pa.int64()) for c in cols], names=["window", "target", "shift"]
                )

    return parts.select("items").mapInArrow(work, "window long, target long, shift long")


def checksums(pieces: DataFrame) -> DataFrame:
    """``pieces`` with the CRC-32 of each piece's ids instead of the ids."""

    @F.pandas_udf("long")
    def crc(ids):
        return ids.map(zlib.crc32)

    return pieces.withColumn("ids_crc32", crc("ids")).drop("ids")
