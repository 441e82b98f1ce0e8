"""Winnowing: sparse, position-keeping fingerprints of texts. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words of a gram, and grams of a window: equal passages of GRAM + WINDOW - 1 words always share a hash.
GRAM, WINDOW = 5, 8
# Rows are dealt by ranges of ids: at most so many, of about so many rows.
MOST_RANGES, ROWS_PER_RANGE = 65_536, 64

# A word: a run of letters, marks and digits; in scripts without blanks (Thai, Lao, Burmese, Khmer, Chinese,
# Japanese), and of all other signs, each one. Blocks are tested much faster than scripts.
_ALONE = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
_WORD = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{_ALONE}]]+|\S"
# Rolling hashes are polynomials in _BASE modulo the prime _PRIME; a place takes the bits below them.
_PRIME, _BASE, _BITS = (1 << 31) - 1, 1_000_003, 31


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _from(values: Column, skip: int, fewer: int) -> Column:
    return F.slice(values, F.lit(skip + 1), F.greatest(F.size(values) - fewer, F.lit(0)))


def _pairs(values: Column, apart: int, use) -> Column:
    """``use`` of each two values that are ``apart`` places from each other."""
    return _let(values, lambda v: F.zip_with(_from(v, 0, apart), _from(v, apart, apart), use))


def _rolling(codes: Column, width: int) -> Column:
    """The polynomial hash of each ``width`` neighbouring codes, by doubling and adding one."""

    def times(power: int):
        return lambda a, b: (a * F.lit(pow(_BASE, power, _PRIME)) + b) % F.lit(_PRIME)

    have, sums = 1, codes
    for bit in bin(width)[3:]:
        sums = _pairs(sums, have, times(have))
        have *= 2
        if bit == "1":
            sums = F.zip_with(_from(sums, 0, 1), _from(codes, have, have), times(1))
            have += 1
    return sums


def _least_of_each(values: Column, width: int) -> Column:
    """The least of each ``width`` neighbours, by doubling the width."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = _pairs(values, step, lambda a, b: F.least(a, b))
        have += step
    return values


def fingerprint(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The winnowed grams of a text, as an array of (position, hash) by position.

    Every ``gram`` neighbouring words have a rolling hash (31 bits), and of every ``window`` neighbouring hashes
    the least is chosen, the rightmost of equal ones; ``position`` is the number of words before the gram. So
    two texts that share ``gram + window - 1`` words in a row share a hash. A text with fewer grams than
    a window has one window; a text with fewer words than a gram is one gram; a text without words (null,
    empty, blanks) has none. Blanks are not looked at, everything else is. Hashes of all places come from hashes
    of half their width, since SQL functions carry no state along an array; work is linear in the text.
    """
    if gram < 1 or window < 1:
        raise ValueError("gram and window must be positive")
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0))
    last = F.lit((1 << _BITS) - 1)

    def packed(sums: Column) -> Column:
        return F.transform(sums, lambda h, i: F.shiftleft(h, _BITS) + (last - i))

    def all_grams(codes: Column) -> Column:
        few = F.aggregate(
            codes, F.lit(0).cast("long"), lambda h, c: (h * F.lit(_BASE) + c) % F.lit(_PRIME)
        )
        return F.when(F.size(codes) >= gram, _rolling(codes, gram)).when(F.size(codes) > 0, F.array(few)).otherwise(codes)

    def least(grams: Column) -> Column:
        return (
            F.when(F.size(grams) >= window, _least_of_each(grams, window))
            .when(F.size(grams) > 0, F.array(F.array_min(grams)))
            .otherwise(grams)
        )

    codes = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(_PRIME)))
    return F.transform(
        F.array_distinct(_let(packed(_let(codes, all_grams)), least)),
        lambda v: F.struct((last - v.bitwiseAND(last)).alias("position"), F.shiftright(v, _BITS).alias("hash")),
    )


def hashes(found: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(found, lambda x: x["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Common share (0 to 1) of two arrays of distinct hashes; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    all_ = F.size(a) + F.size(b) - both
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)


def rendered(found: Column) -> Column:
    """A fingerprint as text: ``position:hash`` in hexadecimal digits, comma-joined."""
    return F.array_join(
        F.transform(found, lambda x: F.concat_ws(":", x["position"].cast("string"), F.lower(F.hex(x["hash"])))), ","
    )


def _ranges(rows: DataFrame) -> tuple[list[int], list[int]]:
    """Where ranges of ``r`` begin, and the values so frequent that they are a range of their own."""
    count = rows.count()
    ranges = max(1, min(MOST_RANGES, count // ROWS_PER_RANGE))
    dealt = rows.repartitionByRange(ranges, "r").groupBy(F.spark_partition_id().alias("p")).agg(F.min("r").alias("r"))
    cuts = [r.r for r in dealt.collect()]
    share = 4 * max(ROWS_PER_RANGE, count // ranges)
    hot = [r.r for r in rows.groupBy("r").count().filter(F.col("count") > share).collect()]
    top = (1 << 63) - 1
    return sorted({*cuts, *hot, *(h + 1 for h in hot if h < top)}), sorted(hot)


def _place(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most ``value``, by groups of cuts first."""
    wide = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + wide] for i in range(0, len(cuts), wide)]

    def longs(values: list[int]) -> Column:
        return F.from_json(F.lit(str(values)), "array<bigint>")

    group = F.size(F.filter(longs([g[0] for g in groups]), lambda c: c <= value))
    inner = F.get(F.from_json(F.lit(str(groups)), "array<array<bigint>>"), group - 1)
    return F.when(group == 0, F.lit(0)).otherwise(
        (group - 1) * wide + F.size(F.filter(inner, lambda c: c <= value))
    )


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """(doc_id, text, next_text, ...) and the window in which the next row is the next document.

    Documents follow each other by falling ``doc_id``, rows without one last, equal ids by the XXH64 of their
    texts; the first follows the last. Rows are dealt by ranges of ids in one shuffle of the texts; the first row
    of each range also stands, as a guard, at the end of the range before. An id with many rows is
    split by the hash of its texts (rows equal in both stay together and are streamed). Filter by
    ``guard`` once all following rows have been looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("r", F.bitwise_not(F.coalesce("doc_id", F.lit(-(1 << 63)))))
    cuts, hot = _ranges(rows.select("r"))
    rows = rows.withColumn("digest", F.xxhash64("text")).withColumn("g", _place(F.col("r"), cuts))
    part = F.shiftright("digest", 56) if hot else F.lit(0).cast("long")
    rows = rows.withColumn("part", F.when(F.col("r").isin(hot), part).otherwise(F.lit(0)) if hot else part)

    first = rows.groupBy("g").agg(F.min("r").alias("first")).select("first")
    if hot:
        first = first.unionByName(docs.sparkSession.createDataFrame([(h,) for h in hot], "first long")).distinct()
    place = F.struct("r", "digest")
    guards = (
        rows.join(F.broadcast(first), F.col("r") == F.col("first"), "left_semi")
        .groupBy("g", "part")
        .agg(F.min(place).alias("at"), F.min_by(F.struct("doc_id", "text"), place).alias("row"))
    )
    order = Window.orderBy("g", "part")
    last = Window.orderBy(F.desc("g"), F.desc("part"))
    before = guards.select(
        F.coalesce(F.lag("g").over(order), F.first("g").over(last)).alias("g"),
        F.coalesce(F.lag("part").over(order), F.first("part").over(last)).alias("part"),
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.text").alias("text"),
        F.lit(True).alias("guard"),
        F.col("at.r").alias("r"),
        F.col("at.digest").alias("digest"),
    )
    both = rows.withColumn("guard", F.lit(False)).unionByName(before)
    window = Window.partitionBy("g", "part").orderBy("guard", "r", "digest")
    return both.withColumn("next_text", F.lead("text").over(window)), window


def compare_edited(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text has its last ``floor(n_chars / 2)`` code points replaced by the first as many (or all) of
    the next document (``with_next``). Returns (doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next), a row per row of ``docs``. Null texts are empty; rows are never dropped; other columns
    are not looked at.
    """
    rows, following = with_next(docs)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.left("text", F.col("n_chars") - half)
    found = (
        rows.withColumn("n_chars", F.length("text"))
        .withColumn("edited", F.concat(kept, F.coalesce(F.left("next_text", half), F.lit(""))))
        .withColumn("fingerprint", fingerprint(F.col("text"), gram, window))
        .withColumn("edited_fingerprint", fingerprint(F.col("edited"), gram, window))
        .drop("text", "next_text")
        .withColumn("own", hashes(F.col("fingerprint")))
        .withColumn("next", F.lead("own").over(following))
    )
    return found.filter(~F.col("guard")).select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("own"), hashes(F.col("edited_fingerprint"))).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
