"""Token sequences in a keyed random order, in shards of fixed-stride records."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.jaccard import small
from weftline.llm.text import mix
from weftline.llm.tokens import Encoder, id_width
from weftline.session import scratch, settle

# Bytes of text per sequence; a byte-level id stands for at least one byte, so also its most ids.
SPAN = 1024
RECORDS = 256
# Up to this many documents, their places are broadcast (24 MB); beyond, texts are shuffled to them.
BROADCAST_DOCS = 1_000_000
ROUNDS = 6
# Before the ids of a record: document id, first id's place in it, number of ids, whether the id is known.
HEADER = np.dtype([("doc_id", "<i8"), ("start", "<i8"), ("length", "<u4"), ("known", "<u4")])


def permute(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. total - 1: a balanced Feistel network with cycle-walking.

    The network permutes the smallest square domain of even bit length that holds ``total``; places
    beyond it are sent through again until they fall inside, which keeps it one to one.
    """
    half = np.uint64(max(1, (max(total - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= total]
    return out.astype(np.int64)


def _numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, code, base): the place of each document's first sequence in the order of ids, and the total."""
    sizes = docs.select("doc_id", "code", F.ceil(F.octet_length("text") / SPAN).alias("many")).filter("many > 0").distinct()

    def work(batches):
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            many = batch.column(2).to_numpy()
            ends = before + np.cumsum(many)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ends - many), pa.array(ends), pa.array(np.full(len(many), part))],
                names=["doc_id", "code", "within", "end", "part"],
            )
            before = int(ends[-1]) if len(ends) else before

    ranged = sizes.repartitionByRange("doc_id", "code").sortWithinPartitions("doc_id", "code")
    placed = settle(ranged.mapInArrow(work, "doc_id long, code long, within long, end long, part long"), "numbered")
    totals = {r["part"]: r["end"] for r in placed.groupBy("part").agg(F.max("end").alias("end")).collect()}
    starts, total = [], 0
    for part in sorted(totals):  # one entry per partition
        starts.append((part, total))
        total += totals[part]
    offsets = placed.sparkSession.createDataFrame(starts, "part long, first long")
    numbered = placed.join(F.broadcast(offsets), "part")
    return numbered.select("doc_id", "code", (F.col("within") + F.col("first")).alias("base")), total


def write_shards(
    docs: DataFrame, path: str, folder: str, key: int, id_col: str = "doc_id", text_col: str = "text"
) -> int:
    """Write all sequences of ``docs`` in training order below ``folder``; returns how many.

    A sequence is the run of a document's ids whose text starts in the same ``SPAN`` bytes, so the number
    of sequences follows from byte lengths alone, and all places are known before any text is encoded.
    Sequence i in the order of document ids gets slot ``permute(i)``. Shard s holds slots from
    s * ``RECORDS`` on, as records of one length, in order; the table is partitioned by slot ranges.

    Null or empty texts have no sequence. Rows with the same id and text count once. Rows with the same
    id and other texts follow by a hash of the text; null ids come first. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("code", F.xxhash64("text"))
    numbered, total = _numbered(rows)
    numbered = small(numbered.select(F.col("doc_id").alias("id"), F.col("code").alias("of"), "base"), BROADCAST_DOCS)
    rows = rows.join(numbered, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("code") == F.col("of")))

    def encode(batches):
        encoder = Encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                docs, bases = part.column(0).to_pylist(), part.column(2).to_numpy()
                texts = [encoder.ids(t) for t in part.column(1).to_pylist()]
                sizes = [np.cumsum(encoder.lengths[ids]) for ids in texts]
                many = [-(-int(x[-1]) // SPAN) for x in sizes]
                index = np.repeat(bases, many) + np.concatenate([np.arange(m) for m in many])
                slots = permute(index, total, key).tolist()
                out: list[tuple] = []
                for doc, ids, ends, m in zip(docs, texts, sizes, many, strict=True):
                    first = np.concatenate([[0], ends[:-1]])
                    cuts = np.searchsorted(first, np.arange(m + 1) * SPAN).tolist()
                    raw = ids.astype(encoder.width).tobytes()
                    size = encoder.width.itemsize
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        out.append((slots[len(out)], doc, a, b - a, raw[size * a : size * b]))
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=k) for c, k in zip(cols, [pa.int64()] * 4 + [pa.binary()], strict=True)],
                    names=["slot", "doc_id", "start", "length", "ids"],
                )

    size = id_width(path).itemsize

    def shard(batches):
        stride = HEADER.itemsize + SPAN * size
        current, held, last = -1, [], -1

        def out():
            columns = [pa.array([current]), pa.array([current * RECORDS]), pa.array([len(held)]), pa.array([b"".join(held)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "first_slot", "records", "payload"])

        for batch in batches:
            for slot, doc, start, length, ids in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if slot == last:  # the same row again
                    continue
                if slot // RECORDS != current:
                    if held:
                        yield out()
                    current, held = slot // RECORDS, []
                head = np.array([(doc or 0, start, length, doc is not None)], dtype=HEADER).tobytes()
                held.append((head + ids).ljust(stride, b"\0"))
                last = slot
        if held:
            yield out()

    schema = "slot long, doc_id long, start long, length long, ids binary"
    sequences = rows.select("doc_id", "text", "base").mapInArrow(encode, schema)
    shards = -(-total // RECORDS)
    parts = max(1, min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    where = F.floor(F.floor(F.col("slot") / RECORDS) * parts / max(shards, 1)).cast("int")
    dealt = sequences.repartitionById(parts, where).sortWithinPartitions("slot")
    dealt.mapInArrow(shard, "shard long, first_slot long, records long, payload binary").write.option(
        "compression", "zstd"
    ).parquet(folder)
    return total


def read_shards(spark: SparkSession, folder: str, path: str, first_slot: int = 0) -> DataFrame:
    """The sequences from ``first_slot`` on: slot, shard, offset (bytes into the shard), doc_id, start, length, ids.

    Shards before it are skipped by the scan, and a record's place follows from its slot alone. ``path``
    names the vocabulary, which gives the width of an id; ids come out as unsigned 32-bit ones.
    """
    wide = id_width(path)

    def work(batches):
        stride = HEADER.itemsize + SPAN * wide.itemsize
        for batch in batches:
            for shard, first, records, payload in zip(*(batch.column(k) for k in range(4)), strict=True):
                first, data = first.as_py(), payload.as_py()
                from_ = max(0, first_slot - first)
                heads = [np.frombuffer(data, HEADER, 1, k * stride)[0] for k in range(from_, records.as_py())]
                offsets = np.arange(from_, records.as_py()) * stride
                ids = [
                    np.frombuffer(data, wide, int(h["length"]), o + HEADER.itemsize).astype("<u4").tobytes()
                    for o, h in zip(offsets.tolist(), heads, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first + np.arange(from_, from_ + len(heads))),
                        pa.array(np.full(len(heads), shard.as_py())),
                        pa.array(offsets),
                        pa.array([int(h["doc_id"]) if h["known"] else None for h in heads], pa.int64()),
                        pa.array([int(h["start"]) for h in heads], pa.int64()),
                        pa.array([int(h["length"]) for h in heads], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["slot", "shard", "offset", "doc_id", "start", "length", "ids"],
                )

    table = spark.read.schema("shard long, first_slot long, records long, payload binary").parquet(folder)
    schema = "slot long, shard long, offset long, doc_id long, start long, length long, ids binary"
    return table.filter(F.col("first_slot") > first_slot - RECORDS).mapInArrow(work, schema)


def materialise(docs: DataFrame, path: str, key: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards to a fresh folder of the session's shared folder and read them back."""
    spark = docs.sparkSession
    folder = scratch(spark, "shards")
    write_shards(docs, path, folder, key, id_col, text_col)
    return read_shards(spark, folder, path)
