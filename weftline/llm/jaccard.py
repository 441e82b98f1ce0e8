"""Near-duplicate documents by a grouped prefix join on shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.components import components
from weftline.llm.text import lists, shingles, slices
from weftline.session import settle

# Tables of up to this many pairs of longs may be broadcast; larger ones are shuffled.
BROADCAST_VALUES = 100_000
# How many of the most frequent shingles the order knows (9 bytes each). Any order gives the same
# links; one that knows all repeated shingles finds them with the fewest candidates.
ORDER_VALUES = 8_000_000
# Sets that are put in order at once.
SETS_AT_ONCE = 256


def _lacking(n, percent: int):
    """How many shingles of a set of n may be missing from a set that it links with."""
    return n * (100 - percent) // 100


def small(df: DataFrame, limit: int = BROADCAST_VALUES) -> DataFrame:
    """``df``, to be broadcast if a count that stops at the limit proves it small."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def shingle_heads(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, code: Column) -> DataFrame:
    """Per row: id, set size n, class (hash of the whole set), a prefix of the set in hash order, and ``code``.

    Linked sets share at least ceil(share of the smaller) of a prefix that is as much longer than
    the usual one; rows that share less with any other class need no further look.
    """

    def work(batches):
        for batch, texts in slices(batches, text_col):
            offsets, values = shingles(texts, width)
            sizes = np.diff(offsets)
            take = np.minimum(sizes, _lacking(sizes, percent) + _spare(sizes, percent))
            keep = np.arange(len(values)) - np.repeat(offsets[:-1], sizes) < np.repeat(take, sizes)
            classes = [
                xxhash.xxh3_64_intdigest(values[a:b].tobytes()) if b > a else 0
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes),
                    pa.array(np.array(classes, dtype=np.uint64).view(np.int64)),
                    lists(np.concatenate([[0], np.cumsum(take)]), values[keep]),
                    batch.column(2),
                ],
                names=["doc_id", "n", "class", "head", "code"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias(text_col), code.alias("code__"))
    return rows.mapInArrow(work, "doc_id long, n long, class long, head array<long>, code string")


def _spare(n, percent: int):
    """By how much the prefix is longer than needed for one shared shingle: a twentieth, at least one."""
    return -(-n // 20)


def _shared_least(n, percent: int):
    """How many shingles of its longer prefix a set of size n shares with any set it links with."""
    smallest = -(-n * percent // 100)
    return -(-smallest // 20)


def _full_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    def work(batches):
        for batch, texts in slices(batches, text_col):
            offsets, values = shingles(texts, width)
            classes = [
                xxhash.xxh3_64_intdigest(values[a:b].tobytes()) if b > a else 0
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(classes, dtype=np.uint64).view(np.int64)),
                    batch.column(0),
                    pa.array(np.diff(offsets)),
                    lists(offsets, values),
                ],
                names=["class", "wanted", "n", "shingles"],
            )

    found = docs.select("wanted", F.col(text_col).alias(text_col)).mapInArrow(
        work, "class long, wanted long, n long, shingles array<long>"
    )
    return found.filter("class = wanted").drop("wanted")


def _prefix_groups(sets: DataFrame, order: tuple[np.ndarray, np.ndarray], complete: bool, percent: int) -> DataFrame:
    """Per class: its group (same size, same prefix), and the prefix with rare shingles first.

    ``order`` holds sorted shingle hashes and their counts; others count as rarer than these. If it
    is ``complete``, others occur in one class only: they are counted (``lone``) and not emitted.
    """
    shared = sets.sparkSession.sparkContext.broadcast(order)

    def work(batches):
        keys, counts = shared.value
        parts = (b.slice(i, SETS_AT_ONCE) for b in batches for i in range(0, b.num_rows, SETS_AT_ONCE))
        for batch in parts:
            ids, sizes, column = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2)
            offsets = column.offsets.to_numpy() - column.offsets[0].as_py()
            flat = column.flatten().to_numpy()
            at = np.minimum(np.searchsorted(keys, flat), max(len(keys) - 1, 0))
            known = keys[at] == flat if len(keys) else np.zeros(len(flat), dtype=bool)
            weight = np.where(known, counts[at] if len(keys) else 0, 0)
            groups, lone, heads, places = [], [], [], []
            for k in range(len(ids)):
                a, b = offsets[k], offsets[k + 1]
                ranks = np.lexsort((flat[a:b], weight[a:b]))[: _lacking(int(sizes[k]), percent) + 1]
                head, common = flat[a:b][ranks], known[a:b][ranks]
                groups.append(xxhash.xxh3_64_intdigest(head.tobytes(), seed=int(sizes[k])))
                lone.append(int((~known[a:b]).sum()) if complete else 0)
                use = common if complete else np.ones(len(head), dtype=bool)
                heads.append(head[use])
                places.append(np.flatnonzero(use))
            ends = np.concatenate([[0], np.cumsum([len(x) for x in heads])]) if heads else np.array([0])
            flat_of = lambda parts: np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids),
                    pa.array(np.array(groups, dtype=np.uint64).view(np.int64)),
                    pa.array(sizes),
                    pa.array(sizes - np.array(lone, dtype=np.int64)),
                    lists(ends, flat_of(heads)),
                    lists(ends, flat_of(places).astype(np.int64)),
                ],
                names=["class", "group", "n", "most", "head", "places"],
            )

    return sets.select("class", "n", "shingles").mapInArrow(
        work, "class long, group long, n long, most long, head array<long>, places array<long>"
    )


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs of classes (a, b) whose similarity reaches the threshold, by their whole sets."""
    one = sets.select(F.col("class").alias("a"), F.col("n").alias("an"), F.col("shingles").alias("aset"))
    two = sets.select(F.col("class").alias("b"), F.col("n").alias("bn"), F.col("shingles").alias("bset"))
    both = F.size(F.array_intersect("aset", "bset"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", "an", "bn", both.alias("both"))
        .filter(f"100 * both >= {percent} * (an + bn - both)")
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """Per row of ``docs``: its id, the size of its shingle set, and its component's smallest id.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets of word shingles.
    Equal sets form one class and are compared once. Classes whose prefix in hash order shares too
    little with others are settled at once. The rest are ordered by how often their shingles occur,
    and classes with the same size and prefix form a group. Each group is first verified against one
    central group per shared shingle; then only group pairs whose members lie in different components
    are filtered by size, place and rare shingles, expanded and verified. Links inside a component
    cannot change it, so they are not tried.

    Null or empty texts have the empty set and link with nothing; their component is their own id.
    Repeated rows and ids are kept, row by row; a null id is never a component's smallest if there is
    another. Columns other than id and text are ignored. Sets hold 64-bit hashes of shingles.
    """
    rows = _labelled_rows(docs, id_col, text_col, width, percent, F.lit(""))
    component = F.when(F.col("n") > 0, F.col("lowest.doc_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def text_code(text_col: str = "text") -> Column:
    """What tells the texts of rows with the same id apart; null counts as empty."""
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def later_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """(doc_id, code) of all rows but the first of each component of ``near_duplicates``.

    ``code`` is the text's, so rows that share an id, also a null one, are judged one by one. The first has
    the smallest id (null is last), then the smallest code; rows with its id and text are first as well.
    """
    rows = _labelled_rows(docs, id_col, text_col, width, percent, text_code(text_col))
    later = ~(F.col("doc_id").eqNullSafe(F.col("lowest.doc_id")) & (F.col("code") == F.col("lowest.code")))
    return rows.filter((F.col("n") > 0) & later).select("doc_id", "code").distinct()


def _labelled_rows(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, code: Column) -> DataFrame:
    """Per row: doc_id, n, code, and ``lowest``: id and code of the first row of its component."""
    spark = docs.sparkSession
    rows = settle(shingle_heads(docs, id_col, text_col, width, percent, code), "heads")
    heads = rows.filter("n > 0").select("doc_id", "class", "n", F.explode("head").alias("shingle"))
    common = heads.groupBy("shingle").agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
    common = settle(common.filter("lo <> hi").select("shingle"), "common")
    shared = heads.join(small(common), "shingle").groupBy("class", "n", "doc_id").count()
    fit = shared.filter(F.col("count") >= _least_sql(percent))
    open_rows = settle(
        fit.groupBy("class").agg(F.min("doc_id").alias("wanted_id")), "open"
    )

    wanted = small(open_rows.select(F.col("class").alias("wanted"), "wanted_id"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias(text_col)).join(
        wanted, F.col("id").eqNullSafe(F.col("wanted_id"))
    )
    sets = settle(_full_sets(texts, "id", text_col, width).dropDuplicates(["class"]), "sets")

    often = sets.select(F.explode("shingles").alias("shingle")).groupBy("shingle").count().filter("count > 1")
    often = settle(often.withColumn("count", F.least("count", F.lit(255)).cast("short")), "often")
    heights = often.groupBy("count").agg(F.count("*").alias("many")).orderBy(F.desc("count")).collect()
    least, held = 2, 0
    for row in heights:  # at most 254 rows
        if held + row["many"] > ORDER_VALUES:
            least = row["count"] + 1
            break
        held += row["many"]
    chosen = often.filter(F.col("count") >= least).toArrow()  # at most ORDER_VALUES rows
    keys, counts = chosen["shingle"].to_numpy(), chosen["count"].to_numpy().astype("uint8")
    del chosen
    ranks = np.argsort(keys)
    keys, counts = keys[ranks], counts[ranks]
    del ranks
    grouped = settle(_prefix_groups(sets, (keys, counts), least == 2, percent), "groups")

    members = grouped.select("group", "class")
    chief = members.groupBy("group").agg(F.min("class").alias("chief"))
    listed = grouped.groupBy("group", "n").agg(
        F.max("most").alias("most"), F.first("head").alias("head"), F.first("places").alias("places")
    )
    listed = listed.select("group", "n", "most", F.explode(F.arrays_zip("head", "places")).alias("x"))
    listed = listed.select("group", "n", "most", F.col("x.head").alias("shingle"), F.col("x.places").alias("place"))
    listed = settle(listed, "prefixes")

    # Each group against the central group (fewest rare shingles) that it meets most often.
    centre = listed.groupBy("shingle").agg(
        F.min_by("group", F.struct(F.col("n") - F.col("most"), F.col("group"))).alias("centre"),
        F.count("*").alias("many"),
    )
    met = listed.join(centre.filter("many > 1"), "shingle").filter("group <> centre")
    met = met.groupBy("group", "centre").count().groupBy("group").agg(
        F.max_by("centre", F.struct("count", "centre")).alias("centre")
    )
    to_centre = (
        met.join(chief, "group")
        .join(chief.select(F.col("group").alias("centre"), F.col("chief").alias("b")), "centre")
        .select(F.col("chief").alias("a"), "b")
    )
    inside = members.join(chief, "group").select(F.col("class").alias("a"), F.col("chief").alias("b")).filter("a <> b")
    links = settle(_linked(to_centre.unionByName(inside), sets, percent), "links")

    labels = components(links).select(F.col("node").alias("class"), "label")
    labelled = settle(
        members.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class")), "labelled"
    )
    spans = labelled.groupBy("group").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    more = settle(_linked(_across(listed, spans, labelled, percent), sets, percent), "links")

    final = components(links.unionByName(more)).select(F.col("node").alias("class"), "label")
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("code"))
    firsts = rows.filter("n > 0").groupBy("class").agg(F.min(rank).alias("first"))
    named = firsts.join(final, "class", "left").withColumn("label", F.coalesce("label", "class"))
    lowest = named.groupBy("label").agg(F.min("first").alias("lowest"))
    named = named.join(lowest, "label").select("class", F.col("lowest"))
    return rows.select("doc_id", "n", "class", "code").join(named, "class", "left").select("doc_id", "n", "code", "lowest")


def _least_sql(percent: int):
    return F.ceil(F.ceil(F.col("n") * percent / 100) / 20)


def _across(listed: DataFrame, spans: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components whose groups may link: (a, b), each once.

    Per shingle, the component with the most groups is the main one. Only groups outside it look
    for partners, so a shingle whose groups all lie in one component makes no pair.
    """
    rows = listed.join(spans, "group")
    sums = rows.groupBy("shingle", "lo").agg(F.count("*").alias("many"), F.max("hi").alias("hi"))
    main = sums.groupBy("shingle").agg(
        F.max_by("lo", F.struct("many", "lo")).alias("main"), F.min("lo").alias("least"), F.max("hi").alias("highest")
    )
    rows = rows.join(main.filter("least <> highest").select("shingle", "main"), "shingle")
    rows = rows.withColumn("outside", (F.col("lo") != F.col("main")) | (F.col("hi") != F.col("main")))
    rows = settle(rows, "mixed")
    one = rows.filter("outside").select("shingle", *(F.col(c).alias(f"a_{c}") for c in ("group", "n", "most", "place", "lo", "hi")))
    two = rows.select("shingle", "outside", *(F.col(c).alias(f"b_{c}") for c in ("group", "n", "most", "place", "lo", "hi")))
    share = 100 + percent
    pairs = one.join(
        two,
        (one["shingle"] == two["shingle"])
        & F.expr(f"{percent} * greatest(a_n, b_n) <= 100 * least(a_n, b_n)")
        & F.expr("not (a_lo = a_hi and b_lo = b_hi and a_lo = b_lo)")
        & F.expr("not outside or a_group <= b_group")
        & F.expr(f"{share} * least(a_most, b_most) >= {percent} * (a_n + b_n)")
        & F.expr(f"{share} * least(a_n - a_place, b_n - b_place) >= {percent} * (a_n + b_n)"),
    ).select("a_group", "b_group").distinct()
    a = labelled.select(F.col("group").alias("a_group"), F.col("class").alias("x"), F.col("label").alias("x_label"))
    b = labelled.select(F.col("group").alias("b_group"), F.col("class").alias("y"), F.col("label").alias("y_label"))
    return (
        pairs.join(a, "a_group")
        .join(b, "b_group")
        .filter("x_label <> y_label")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
