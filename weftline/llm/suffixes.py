"""Repeated byte strings removed by a distributed difference-cover suffix sort."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.jaccard import small
from weftline.llm.text import mix, slices
from weftline.session import scratch, settle

# Length of the strings compared, and of the grams that anchor them: each string holds such a gram.
LENGTH, GRAM = 100, 50
# Text that one suffix sort takes on, and window starts that are looked at together.
CHUNK, PART = 1 << 20, 1 << 19
# Repeated grams that are sent to tasks as one array (8 bytes each); more are joined to their texts.
KNOWN_GRAMS = 4_000_000
# A gram with more distinct surroundings than this is split by the strings themselves.
CROWDED = 4096


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` bytes, by doubling."""
    power = mix(data.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    out, covered, size = None, 0, 1
    while True:
        if length & size:
            if out is None:
                out = power
            else:
                n = len(data) - covered - size + 1
                out = mix(out[:n] * np.uint64(0xD1342543DE82EF95) + power[covered : covered + n])
            covered += size
        if 2 * size > length:
            return out
        n = max(0, len(power) - size)
        power = mix(power[:n] * np.uint64(0xA0761D6478BD642F) + power[size : size + n])
        size *= 2


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each window of ``LENGTH`` bytes picks the gram with the smallest hash inside it, the first of equals.

    Returns, per run of windows with the same pick: first and last window, the gram's place and hash.
    The pick depends on the window's bytes alone, so equal windows pick the same place inside.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    hashes = grams(data, GRAM)
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    keys = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width = LENGTH - GRAM + 1
    low, size = keys, 1
    while 2 * size <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    low = np.minimum(low[:n], low[width - size : width - size + n])
    place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [n]]) - 1
    return first, last, place[first], hashes[place[first]]


def _parts(text: bytes):
    """(offset, bytes): pieces whose windows together are the windows of the text, for long texts."""
    if len(text) <= PART + LENGTH:
        yield 0, np.frombuffer(text, np.uint8)
        return
    for at in range(0, len(text) - LENGTH + 1, PART):
        yield at, np.frombuffer(text, np.uint8, min(PART + LENGTH - 1, len(text) - at), at)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, and the text's digest in two longs: ``code`` and ``rest``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.md5("text")
    half = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return rows.withColumn("code", half(1)).withColumn("rest", half(17))


def _grams_of(rows: DataFrame) -> DataFrame:
    """Per document: sizes and digests, its picked grams, and which of them it holds more than once."""

    def work(batches):
        for batch, texts in slices(batches, "text"):
            once, more = [], []
            for text in texts:
                found = [(at + p, h) for at, data in _parts(text) for _, _, p, h in [anchors(data)]]
                places = np.concatenate([p for p, _ in found])
                hashes = np.concatenate([h for _, h in found])
                _, where = np.unique(places, return_index=True)
                values, many = np.unique(hashes[where], return_counts=True)
                once.append(values[many == 1].view(np.int64))
                more.append(values[many > 1].view(np.int64))
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, x)]), type=pa.int32()), pa.array(np.concatenate(x), type=pa.int64())
                )
                for x in (once, more)
            ]
            sizes = pa.array([len(t) for t in texts], type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), sizes, *lists],
                names=["doc_id", "code", "rest", "n_bytes", "once", "more"],
            )

    schema = "doc_id long, code long, rest long, n_bytes long, once array<long>, more array<long>"
    return rows.select("doc_id", "text", "code", "rest").mapInArrow(work, schema)


_UNIT = "gram long, shift long, context binary, doc_id long, code long, start long"


def _settle_text(df: DataFrame, label: str) -> DataFrame:
    """``settle`` with a codec that finds the overlaps between contexts."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _units(rows: DataFrame, repeated: np.ndarray | None) -> DataFrame:
    """Runs of windows around repeated grams: the bytes they cover, where they start, the gram's place.

    The repeated grams, also those that one text alone repeats, are given as a sorted array, or else in the
    column ``repeated`` of each row.
    """
    given = rows.sparkSession.sparkContext.broadcast(repeated)

    def work(batches):
        for batch, texts in slices(batches, "text"):
            out: list[tuple] = []
            docs, codes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, text in enumerate(texts):
                common = given.value
                if common is None:
                    common = np.sort(np.array(batch.column(3)[i].as_py() or [], dtype=np.int64))
                if not len(common):
                    continue
                for at, data in _parts(text):
                    first, last, place, hashes = anchors(data)
                    keys = hashes.view(np.int64)
                    use = common[np.minimum(np.searchsorted(common, keys), len(common) - 1)] == keys
                    for a, b, p, k in zip(first[use].tolist(), last[use].tolist(), place[use].tolist(), keys[use].tolist(), strict=True):
                        out.append((k, p - a, text[at + a : at + b + LENGTH], docs[i], codes[i], at + a))
                if len(out) > 4096:
                    yield _unit_batch(out)
                    out = []
            yield _unit_batch(out)

    return rows.mapInArrow(work, _UNIT)


def _unit_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    cols = list(zip(*out, strict=True)) or [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(cols, kinds, strict=True)],
        names=["gram", "shift", "context", "doc_id", "code", "start"],
    )


def suffix_order(symbols: np.ndarray, need: int, span: int = 1) -> np.ndarray:
    """The places of ``symbols`` (from 1 up) in the order of the suffixes there, as far as ``need`` symbols tell.

    Difference cover modulo 3: triples at places that are 1 or 2 modulo 3 are sorted and named; if names
    repeat, the order of the string of names is found in the same way; the remaining suffixes are sorted
    by one symbol and the rank behind it, and merged. A symbol stands for ``span`` symbols of the first
    string, so names are fine enough as soon as three of them cover ``need``.
    """
    n = len(symbols)
    s = np.concatenate([symbols, np.zeros(5, dtype=np.int64)])
    places = np.concatenate([np.arange(1, n, 3), np.arange(2, n, 3)])
    split = len(range(1, n, 3))
    top = int(symbols.max(initial=0)) + 1
    pairs = s[places] * top + s[places + 1]
    if top**3 >= 1 << 62:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    _, names = np.unique(pairs * top + s[places + 2], return_inverse=True)
    names = names.astype(np.int64) + 1
    if len(names) and names.max() < len(names) and 3 * span < need:
        # A zero keeps the two parts apart.
        shorter = np.concatenate([names[:split], [0], names[split:]])
        order = suffix_order(shorter, need, 3 * span)
        order = order[order != split]
        order = order - (order > split)
    else:
        order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 5, dtype=np.int64)
    rank[places[order]] = np.arange(1, len(places) + 1)

    rest = np.arange(0, n, 3)
    wide = np.int64(n + 6)
    rest = rest[np.argsort(s[rest] * wide + rank[rest + 1], kind="stable")]
    one = places[order][places[order] % 3 == 1]
    two = places[order][places[order] % 3 == 2]
    # Against places 1 modulo 3 one symbol and a rank decide, against places 2 modulo 3 two and a rank.
    rest_one, keys_one = s[rest] * wide + rank[rest + 1], s[one] * wide + rank[one + 1]
    both = np.concatenate([rest, two])
    heads = np.unique(s[both] * top + s[both + 1], return_inverse=True)[1].astype(np.int64) * wide + rank[both + 2]
    rest_two, keys_two = heads[: len(rest)], heads[len(rest) :]
    spot = np.empty(n, dtype=np.int64)
    spot[rest] = np.arange(len(rest)) + np.searchsorted(keys_one, rest_one) + np.searchsorted(keys_two, rest_two)
    spot[one] = rank[one] - 1 + np.searchsorted(rest_one, keys_one, "right")
    spot[two] = rank[two] - 1 + np.searchsorted(rest_two, keys_two, "right")
    return np.argsort(spot, kind="stable")


def _later(contexts: list[bytes], docs: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """(context, from, to) runs of windows that occur earlier: in a smaller (document, code, start)."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    lengths = np.array([len(c) for c in contexts], dtype=np.int64)
    ends = np.cumsum(lengths)
    order = suffix_order(data.astype(np.int64) + 1, LENGTH)
    owner = np.repeat(np.arange(len(contexts)), lengths)
    inside = ends[owner] - np.arange(len(data)) >= LENGTH
    order = order[inside[order]]
    # Adjacent prefixes, eight bytes at a time.
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)[: len(data)]
    eights = np.ascontiguousarray(eights).view(np.uint64).ravel()
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for at in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        same &= eights[order[1:] + at] == eights[order[:-1] + at]
    group = np.concatenate([[0], np.cumsum(~same)])[: len(order)]
    who = owner[order]
    begin = starts[who] + order - (ends[who] - lengths[who])
    ranked = np.lexsort((begin, codes[who], docs[who], group))
    first = np.concatenate([[True], group[ranked][1:] != group[ranked][:-1]])[: len(ranked)]
    late = np.sort(order[ranked[~first]])
    if not len(late):
        return []
    cut = np.flatnonzero((np.diff(late) > 1) | (np.diff(owner[late]) > 0)) + 1
    runs = [(late[a], late[b - 1]) for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(late)], strict=True)]
    return [(int(owner[a]), int(a - ends[owner[a]] + lengths[owner[a]]), int(b - ends[owner[a]] + lengths[owner[a]]) + LENGTH) for a, b in runs]


def _sort_groups(units: DataFrame) -> DataFrame:
    """Runs of bytes to remove, from distinct contexts sorted by gram: whole grams at a time."""

    def work(batches):
        held: list[tuple] = []
        size = 0

        def out():
            lowest = -(1 << 63)
            docs = np.array([lowest if x[2] is None else x[2] for x in held], dtype=np.int64)
            codes, starts = (np.array([x[k] for x in held], dtype=np.int64) for k in (3, 4))
            rows = [
                (held[c][2], held[c][3], int(starts[c]) + a, int(starts[c]) + b)
                for c, a, b in _later([x[1] for x in held], docs, codes, starts)
            ]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in cols], names=["doc_id", "code", "from", "to"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if size >= CHUNK and row[0] != held[-1][0]:
                    yield out()
                    held, size = [], 0
                held.append(row)
                size += len(row[1])
        if held:
            yield out()

    ordered = units.repartition("gram").sortWithinPartitions("gram")
    return ordered.select("gram", "context", "doc_id", "code", "start").mapInArrow(
        work, "doc_id long, code long, from long, to long"
    )


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, code, spans): the byte runs (from, to) of each text that strings of ``LENGTH`` bytes seen
    earlier cover; ``code`` tells texts with the same id apart. Texts without any are left out.

    1. Of equal texts one is looked at; in the others every byte is covered.
    2. Each string picks a gram of ``GRAM`` bytes; only strings whose gram occurs again can recur. Runs of
       strings with the same pick become contexts, and of equal contexts only the earliest goes on.
    3. Contexts are dealt to tasks by their gram, so equal strings meet in one task. There a suffix sort
       (``suffix_order``) brings equal strings together; of each set the earliest stays.
    Grams with very many contexts are split by the strings themselves, combined before the shuffle.
    """
    rows = _keyed(docs, id_col, text_col)
    picked = settle(_grams_of(rows), "grams")
    firsts = picked.groupBy("code", "rest").agg(F.min("doc_id").alias("first"), F.count("*").alias("many"))
    firsts = firsts.filter("many > 1")
    copies = picked.join(firsts, ["code", "rest"]).filter("not doc_id <=> first")
    copies = settle(copies.select("doc_id", "code", "rest", "n_bytes").distinct(), "copies")
    whole = copies.filter(F.col("n_bytes") >= LENGTH).select(
        "doc_id", "code", F.lit(0).cast("long").alias("from"), F.col("n_bytes").alias("to")
    )

    def without_copies(df: DataFrame) -> DataFrame:
        gone = small(copies.select(F.col("doc_id").alias("d"), F.col("code").alias("c"), F.col("rest").alias("r")))
        return df.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("code") == F.col("c")) & (F.col("rest") == F.col("r")), "left_anti")

    leaders = without_copies(picked)
    # A gram that one document holds more than once counts twice, so it is repeated without another document.
    each = leaders.select(F.explode(F.concat("once", "more", "more")).alias("gram"))
    often = each.groupBy("gram").count().filter("count > 1")
    often = settle(often.select("gram"), "often")
    leading = without_copies(rows)
    if often.limit(KNOWN_GRAMS + 1).count() <= KNOWN_GRAMS:
        found = _units(leading.select("doc_id", "text", "code"), np.sort(often.toArrow()["gram"].to_numpy()))
    else:
        mine = leaders.select("doc_id", "code", F.explode(F.concat("once", "more")).alias("gram")).join(often, "gram")
        mine = mine.groupBy(F.col("doc_id").alias("d"), F.col("code").alias("c")).agg(F.collect_set("gram").alias("repeated"))
        joined = leading.join(mine, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("code") == F.col("c")), "left")
        found = _units(joined.select("doc_id", "text", "code", "repeated"), None)
    found = _settle_text(found, "contexts")

    rank = F.struct("doc_id", "code", "start")
    sums = found.groupBy("gram", "shift", "context").agg(F.min(rank).alias("x"), F.count("*").alias("many"))
    sums = _settle_text(sums, "distinct")
    repeated = sums.filter("many > 1").select("gram", "shift", "context", "x")
    again = found.join(repeated, ["gram", "shift", "context"]).filter(~rank.eqNullSafe(F.col("x")))
    again = again.select("doc_id", "code", F.col("start").alias("from"), (F.col("start") + F.length("context")).alias("to"))

    crowds = sums.groupBy("gram").count().filter("count > 1")
    busy = small(crowds.filter(F.col("count") > CROWDED).select("gram"))
    several = sums.join(crowds.select("gram"), "gram", "left_semi").select("gram", "shift", "context", "x.*")
    several = _settle_text(several, "several")
    sorted_ = _sort_groups(several.join(busy, "gram", "left_anti"))
    windows = several.join(busy, "gram", "left_semi").select(
        "doc_id", "code", "start", "context", F.explode(F.sequence(F.lit(0), F.length("context") - LENGTH)).alias("k")
    )
    windows = windows.select("doc_id", "code", (F.col("start") + F.col("k")).alias("start"), F.substring("context", F.col("k") + 1, F.lit(LENGTH)).alias("string"))
    heads = windows.groupBy("string").agg(F.min(rank).alias("x"), F.count("*").alias("many")).filter("many > 1")
    split = windows.join(heads, "string").filter(~rank.eqNullSafe(F.col("x")))
    split = split.select("doc_id", "code", F.col("start").alias("from"), (F.col("start") + LENGTH).alias("to"))

    covered = sorted_.unionByName(again).unionByName(split).unionByName(whole)
    spans = F.array_sort(F.collect_list(F.struct("from", "to")))
    return covered.groupBy("doc_id", "code").agg(_merged(spans).alias("spans"))


def _merged(spans):
    """Sorted runs as disjoint ones; runs that touch become one."""

    @F.pandas_udf("array<struct<from:long,to:long>>")
    def merge(column):
        out = []
        for runs in column:
            joined: list[list[int]] = []
            for r in runs:
                if joined and r["from"] <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], r["to"])
                else:
                    joined.append([r["from"], r["to"]])
            out.append([{"from": a, "to": b} for a, b in joined])
        return type(column)(out, dtype=object)

    return merge(spans)


def drop_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, spans (byte runs removed, maximal and disjoint), kept (the bytes left).

    A byte is removed if a string of ``LENGTH`` bytes over it also starts earlier: in a smaller id, or
    earlier in the same text; strings are judged on the input and never reach across texts. Null texts
    count as empty. Rows with the same id and text are one document, reported once per row; of other
    texts with the same id, the one with the smaller digest is earlier; null ids come first. Other
    columns are ignored.
    """
    spans = settle(repeated_spans(docs, id_col, text_col), "spans")
    spans = spans.select(F.col("doc_id").alias("d"), F.col("code").alias("c"), "spans")
    if (spans.agg(F.sum(F.size("spans") + 2)).first()[0] or 0) <= 1_000_000:
        spans = F.broadcast(spans)  # at most a million pairs of longs
    rows = _keyed(docs, id_col, text_col)
    found = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("code") == F.col("c")), "left")
    none = F.array().cast("array<struct<from:bigint,to:bigint>>")

    def cut(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                sizes, kept = [], []
                for text, gaps in zip(part.column(1).cast(pa.binary()), part.column(2), strict=True):
                    text, at, left = text.as_py(), 0, []
                    for gap in gaps.as_py():
                        left.append(text[at : gap["from"]])
                        at = gap["to"]
                    sizes.append(len(text))
                    kept.append(b"".join([*left, text[at:]]))
                columns = [part.column(0), pa.array(sizes, pa.int64()), part.column(2), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "spans", "kept"])

    rows = found.select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    return rows.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<from:long,to:long>>, kept binary")

