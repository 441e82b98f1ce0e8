"""The trie of conversation prefixes: which conversations begin alike, and what sharing the beginning saves."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from weftline.llm.text import mix
from weftline.session import scratch_root, settle

# Cells of the count-min sketch in each of its two rows: four a prefix, within these bounds. The upper one
# bounds what is broadcast (a bit a cell, 32 MB in all); beyond it more prefixes are grouped exactly.
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 27
_BLOCK = 1 << 16
# A prefix is told by the sums of its turns' codes, each times a power of these odd numbers, modulo 2^64.
_POWERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_NODE = ("depth", "a", "b")


def coded_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, a, b, n_bytes): each turn by 128 bits of the SHA-256 of its role and text.

    Null roles and texts are empty; rows without a conversation are left out.
    """
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256)

    def half(first: int) -> Column:
        # Signed, in the order of the digits.
        return F.conv(F.substring("d", first, 16), 16, -10).cast("long").bitwiseXOR(F.lit(-(1 << 63)))

    coded = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.octet_length(t).cast("long").alias("n_bytes"),
        digest.alias("d"),
    )
    return coded.filter("conv_id IS NOT NULL").select("conv_id", "turn", half(1).alias("a"), half(17).alias("b"), "n_bytes")


def running(rows: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """Adds ``sum_<value>``: sums of long columns from the first row of each ``key`` on, modulo 2^64.

    Rows are sorted into ranges of (key, order), so a key of any size is spread over tasks; each range adds what
    the ranges before it hold of its first key. Only one row a range comes to the driver.
    """
    scratch_root(rows.sparkSession)
    held = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).checkpoint()

    def columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        get = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
        return get(key), np.stack([get(v).view(np.uint64) for v in values]) if batch.num_rows else None

    def sums(batches: Iterator[pa.RecordBatch], carried: tuple | None):
        """Each batch with its sums, and the last key with the sums up to its last row."""
        at, total = carried or (None, np.zeros(len(values), dtype=np.uint64))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, terms = columns(batch)
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            part = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
            line = np.cumsum(terms, axis=1, dtype=np.uint64)
            before = np.where(starts > 0, line[:, starts - 1], np.uint64(0))
            if at is not None and keys[0] == at:
                before[:, 0] -= total
            line = line - before[:, part]
            at, total = int(keys[-1]), line[:, -1].copy()
            yield batch, line, (int(keys[0]), at, total)

    def summary(batches):
        first = last = total = None
        for _, _, (begin, last, total) in sums(batches, None):
            first = begin if first is None else first
        if first is not None:
            number = TaskContext.get().partitionId()
            ends = [number, first, last, [int(v) for v in total.view(np.int64)]]
            yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(("p", "first", "last", "total"), ends)}, schema=told)

    told = pa.schema([("p", pa.int32()), ("first", pa.int64()), ("last", pa.int64()), ("total", pa.list_(pa.int64()))])
    carries, before = {}, (None, np.zeros(len(values), dtype=np.uint64))
    for r in sorted(held.mapInArrow(summary, "p int, first long, last long, total array<long>").collect()):
        carries[r.p] = before
        total = np.array(r.total, dtype=np.int64).view(np.uint64)
        before = (r.last, total + before[1] if r.first == r.last == before[0] else total)

    def task(batches):
        carried = carries.get(TaskContext.get().partitionId())
        for batch, line, _ in sums(batches, carried):
            more = [pa.array(v.view(np.int64)) for v in line]
            names = [*batch.schema.names, *(f"sum_{v}" for v in values)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=names)

    return held.mapInArrow(task, StructType([*held.schema.fields, *(StructField(f"sum_{v}", LongType()) for v in values)]))


def placed(coded: DataFrame) -> DataFrame:
    """``coded_turns`` with ``depth``: the place of each turn in its conversation, from 1.

    Turns follow each other by ``turn``, null first, equal ones by their SHA-256 (equal rows are different turns).
    """
    rows = coded.withColumn("missing", F.coalesce(F.col("turn"), F.lit(-(1 << 63)))).withColumn("one", F.lit(1).cast("long"))
    counted = running(rows, "conv_id", ["missing", "a", "b"], ["one"])
    return counted.select("conv_id", F.col("sum_one").alias("depth"), "a", "b", "n_bytes")


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    out, factor, left = np.ones(len(exponents), dtype=np.uint64), np.uint64(base), exponents.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] *= factor
        factor, left = factor * factor, left >> np.uint64(1)
    return out


def _prefixes(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b, n_bytes): every prefix of every conversation, the empty one included."""

    def weigh(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                get = lambda c, batch=batch: batch.column(batch.schema.get_field_index(c))
                depth = get("depth").to_numpy()
                made = []
                for name, base in zip("ab", _POWERS):
                    code = mix(get(name).to_numpy().view(np.uint64))
                    made.append(pa.array((code * _powers(base, depth)).view(np.int64)))
                yield pa.RecordBatch.from_arrays([get("conv_id"), get("depth"), *made, get("n_bytes")], names=names)

    names = ["conv_id", *_NODE, "n_bytes"]
    terms = turns.select(names).mapInArrow(weigh, "conv_id long, depth long, a long, b long, n_bytes long")
    sums = running(terms, "conv_id", ["depth"], ["a", "b"])
    deep = sums.select("conv_id", "depth", F.col("sum_a").alias("a"), F.col("sum_b").alias("b"), "n_bytes")
    zero = F.lit(0).cast("long")
    return deep.unionByName(conversations.select("conv_id", *(zero.alias(c) for c in names[1:])))


def _cells(depth: np.ndarray, a: np.ndarray, b: np.ndarray, cells: int) -> list[np.ndarray]:
    with np.errstate(over="ignore"):
        salt = depth.view(np.uint64) * np.uint64(_POWERS[0])
        return [(mix(half.view(np.uint64) + salt) & np.uint64(cells - 1)).astype(np.int64) for half in (a, b)]


def _sketch(prefixes: DataFrame, cells: int) -> dict[int, bytes]:
    """A count-min sketch of two rows as bits: which cells have counted more than one prefix.

    Tasks count batch by batch and send the cells, twice at most, to the task of their block.
    """

    def count(batches):
        for batch in batches:
            get = lambda c, batch=batch: batch.column(batch.schema.get_field_index(c)).to_numpy()
            found = _cells(get("depth"), get("a"), get("b"), cells)
            spots = np.sort(np.concatenate([found[0], found[1] + cells]))
            third = np.concatenate([[False, False], spots[2:] == spots[:-2]])[: len(spots)]
            spots = spots[~third]
            blocks, starts = np.unique(spots // _BLOCK, return_index=True)
            ends = np.concatenate([starts, [len(spots)]]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array((spots % _BLOCK).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(blocks.astype(np.int32)), lists], names=["block", "spots"])

    def merge(batches):
        block, seen = None, None
        for batch in batches:
            for b, spots in zip(batch.column(0).to_numpy(), batch.column(1)):
                if b != block:
                    if block is not None:
                        yield bits(block, seen)
                    block, seen = b, np.zeros(_BLOCK, dtype=np.uint8)
                counts = np.bincount(spots.values.to_numpy(), minlength=_BLOCK)
                seen = np.minimum(seen + np.minimum(counts, 2), 2).astype(np.uint8)
        if block is not None:
            yield bits(block, seen)

    def bits(block, seen):
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "bits": [np.packbits(seen > 1).tobytes()]})

    counted = prefixes.filter("depth > 0").select(*_NODE).mapInArrow(count, "block int, spots array<int>")
    merged = counted.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary")
    return {r.block: bytes(r.bits) for r in merged.collect()}


def _screened(prefixes: DataFrame, cells: int) -> DataFrame:
    """Adds ``shared``: false where the sketch proves that no other conversation has the prefix."""
    spark = prefixes.sparkSession
    found = _sketch(prefixes, cells)
    whole = b"".join(found.get(k, bytes(_BLOCK // 8)) for k in range(2 * cells // _BLOCK))
    sent = spark.sparkContext.broadcast(whole)

    def probe(batches):
        sketch = np.frombuffer(sent.value, dtype=np.uint8)
        for batch in batches:
            get = lambda c, batch=batch: batch.column(batch.schema.get_field_index(c)).to_numpy()
            both = _cells(get("depth"), get("a"), get("b"), cells)
            spots = [both[0], both[1] + cells]
            crowded = [(sketch[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 == 1 for s in spots]
            shared = (crowded[0] & crowded[1]) | (get("depth") == 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared)], names=[*batch.schema.names, "shared"])

    schema = StructType([*prefixes.schema.fields, StructField("shared", BooleanType())])
    marked = settle(prefixes.mapInArrow(probe, schema), "screened")
    sent.destroy()
    return marked


def _ends(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): the digest of the conversations that end at each node.

    Ids are sorted over all tasks and written to pieces of text first; only the digest of a node, which has no
    parallel form, is taken from its pieces in one task, piece by piece.
    """

    def write(batches):
        node, first, ids, size = None, None, [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if row[:3] != node or size > 1 << 18:
                    if ids:
                        yield piece(node, first, ids)
                    node, first, ids, size = row[:3], row[3], [], 0
                ids.append(str(row[3]))
                size += len(ids[-1]) + 1
        if ids:
            yield piece(node, first, ids)

    def piece(node, first, ids):
        values = {"depth": node[0], "a": node[1], "b": node[2], "first": first, "ids": ",".join(ids)}
        return pa.RecordBatch.from_pylist([values], schema=pieces)

    def digest(batches):
        node, state, made = None, None, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(3)), batch.column(4)):
                if row[:3] != node:
                    if node is not None:
                        made.append((*node, state.hexdigest()))
                    node, state = row[:3], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row[3].as_py().encode())
            yield rows(made)
            made = []
        if node is not None:
            yield rows([(*node, state.hexdigest())])

    def rows(made):
        return pa.RecordBatch.from_pylist([dict(zip(digests.names, m)) for m in made], schema=digests)

    keys = [(c, pa.int64()) for c in _NODE]
    pieces = pa.schema([*keys, ("first", pa.int64()), ("ids", pa.string())])
    digests = pa.schema([*keys, ("ends_sha256", pa.string())])
    order = [*_NODE, "conv_id"]
    written = ends.select(order).repartitionByRange(*order).sortWithinPartitions(*order)
    written = written.mapInArrow(write, "depth long, a long, b long, first long, ids string")
    dealt = written.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return dealt.mapInArrow(digest, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations, from placed turns (``placed``) and the table of ``conv_id``.

    A node is a distinct sequence of first turns (role and text); the root is the empty one, which every
    conversation passes, also one without turns. Returns per node: ``conv_id``, the smallest member (conversation that
    begins so); ``depth``; ``parent_conv_id``, that of its parent (null at the root); ``n_convs``, members;
    ``n_children``; ``n_leaves``, childless nodes below or at it; ``saved_tokens``, over the nodes below and at it, the
    UTF-8 bytes of the node's last text for each member but one; ``ends_sha256``, of the members that
    end there, their ids in numeric order, comma-joined. No conversations, no nodes.

    A count-min sketch screens the prefixes: an estimate of one proves that no other conversation has it, nor any
    longer one, so the rest of that conversation becomes nodes on the spot. Only other prefixes are grouped.
    Sums over subtrees need no walk by levels: a node belongs to its smallest member, which passes all
    its ancestors, so a node's subtree is what its members own at its depth or below. Prefixes are compared
    by 128 bits and their length.
    """
    conversations = conversations.select("conv_id")
    prefixes = settle(_prefixes(turns, conversations), "prefixes")
    cells = LEAST_CELLS
    while cells < min(MOST_CELLS, 4 * prefixes.count()):
        cells *= 2
    marked = _screened(prefixes, cells)

    ends = F.max("depth").alias("length")
    alone = F.min(F.when(~F.col("shared"), F.col("depth")))
    lengths = marked.groupBy("conv_id").agg(ends, F.coalesce(alone, F.max("depth") + 1).alias("alone"))
    lengths = settle(lengths, "lengths")
    grouped = settle(marked.filter("shared").join(lengths, "conv_id").filter("depth < alone").drop("shared"), "grouped")

    members = F.count("*").alias("n_convs")
    nodes = grouped.groupBy(*_NODE).agg(members, F.min("conv_id").alias("owner"), F.max("length").alias("deepest"))
    passed = settle(grouped.join(settle(nodes, "nodes"), list(_NODE)), "passed")
    own = F.col("owner") == F.col("conv_id")
    kept = F.when(own, F.col("depth"))
    leaf = own & (F.col("depth") == F.col("length")) & (F.col("deepest") == F.col("length"))
    each = passed.withColumn("saves", F.when(own, (F.col("n_convs") - 1) * F.col("n_bytes")).otherwise(F.lit(0).cast("long")))
    paths = each.groupBy("conv_id", "length", "alone").agg(
        F.coalesce(F.min(kept), F.col("alone")).alias("owned"),
        F.max_by(F.when(~own, F.col("owner")), F.when(~own, F.col("depth"))).alias("above"),
        F.sum("saves").alias("all_saves"),
        F.max(F.when(leaf | (F.col("alone") <= F.col("length")), 1).otherwise(0)).cast("long").alias("leaf"),
    )
    paths = settle(paths, "paths")
    parent = F.when(F.col("depth") == F.col("owned"), F.col("above")).otherwise(F.col("conv_id"))

    columns = ["conv_id", *_NODE, "n_convs", "owner", "saves"]
    below = running(each.filter(own).select(*columns, (-F.col("depth")).alias("up")), "conv_id", ["up"], ["saves"])
    below = below.drop("up").unionByName(each.filter(~own).select(*columns, F.lit(None).cast("long").alias("sum_saves")))
    below = below.join(paths, "conv_id")
    child = (F.col("depth") < F.col("length")) & (F.col("depth") + 1 >= F.col("owned"))
    shared = below.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.max(F.when(own, parent)).alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.sum(child.cast("long")).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.coalesce("sum_saves", "all_saves")).alias("saved_tokens"),
    )
    shared = shared.join(_ends(passed.filter("depth = length")), list(_NODE), "left")
    nothing = F.sha2(F.lit(""), 256)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    shared = shared.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).select(names)

    # Tails in runs, as one conversation may be very long.
    run = 10_000
    starts = F.sequence(F.col("alone"), F.col("length"), F.lit(run).cast("long"))
    depths = F.sequence(F.col("start"), F.least(F.col("start") + (run - 1), F.col("length")))
    one, last = F.lit(1).cast("long"), F.col("depth") == F.col("length")
    tails = (
        paths.filter("alone <= length")
        .withColumn("start", F.explode(starts))
        .withColumn("depth", F.explode(depths))
        .select(
            "conv_id",
            "depth",
            parent.alias("parent_conv_id"),
            one.alias("n_convs"),
            (~last).cast("long").alias("n_children"),
            one.alias("n_leaves"),
            F.lit(0).cast("long").alias("saved_tokens"),
            F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
        )
    )
    return shared.unionByName(tails)


def grafted(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Placed turns of conversations that begin with turns of another one, and the table of their ``conv_id``.

    Conversation ``c`` gets the first ``h`` turns of conversation ``c - c % every`` (all it has, none if
    absent; the remainder has the sign of ``c``), then its own turns after its first ``h``, where ``h`` is the
    unsigned CRC-32 of the decimal ``c`` modulo ``most``.
    """
    turns = settle(turns, "turns")
    lengths = settle(turns.groupBy("conv_id").agg(F.max("depth").alias("length")), "lengths")
    convs = lengths.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"),
    )
    based = lengths.select(F.col("conv_id").alias("base"), F.col("length").alias("there"))
    convs = convs.join(based, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = settle(convs.select("conv_id", "base", "h", "taken"), "convs")
    heads = turns.filter((F.col("depth") < most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")
    names = ["conv_id", "depth", "a", "b", "n_bytes"]
    begun = heads.join(convs, "base").filter("depth <= taken").select(names)
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("depth > h")
    own = own.withColumn("depth", F.col("depth") - F.col("h") + F.col("taken")).select(names)
    return begun.unionByName(own), convs.select("conv_id")
