"""Joins: by hint, size-checked broadcast, hot-key salting, ranges and time intervals."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 2**20
CELL_STEP = 32


def has_at_most(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    ``take`` reads a few partitions at a time and stops one row beyond the limit; the rows it
    brings to the driver have one constant column.
    """
    return len(df.select(F.lit(1)).take(max_rows + 1)) <= max_rows


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: lengths of text and binary, JSON of nested values, else 8 each."""
    sizes = [F.lit(8 * len(df.columns))]
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(f.name), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0)))
    return reduce(Column.__add__, sizes)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within both bounds.

    Only the size of at most ``max_rows`` + 1 rows is summed, so a table beyond the bounds is not
    read to its end, and one row comes to the driver.
    """
    some = df.select(row_bytes(df).cast("long").alias("bytes")).limit(max_rows + 1)
    found = some.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def broadcast_join(
    left: DataFrame,
    right: DataFrame,
    on,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join with ``right`` broadcast if it is proven small in rows and bytes, else as Catalyst and AQE decide.

    A side that is costly to compute should be written first (``settle``), as the proof computes it too.
    """
    if fits(right, max_rows, max_bytes):
        right = F.broadcast(right)
    return left.join(right, on, how)


def merge_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Shuffle sort-merge join, asked for by hint for this join alone."""
    return left.join(right.hint("merge"), on, how)


def hash_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Shuffle hash join that builds its table from ``right``."""
    return left.join(right.hint("shuffle_hash"), on, how)


def pair_join(left: DataFrame, right: DataFrame, condition: Column, names=("left", "right")) -> DataFrame:
    """Inner join that keeps each side whole as one struct column."""
    joined = left.alias("l").join(right.alias("r"), condition)
    return joined.select(
        F.struct("l.*").alias(names[0]),
        F.struct("r.*").alias(names[1]),
    )


def members(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-null keys: all that a semi or anti join needs from its right side."""
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def semi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    keys = members(right, right_key)
    return left.join(keys, left[left_key] == keys[right_key], "left_semi")


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    keys = members(right, right_key)
    return left.join(keys, left[left_key] == keys[right_key], "left_anti")


def full_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer join where ``left`` may have hot keys and ``right`` has unique ones.

    AQE cannot split a skewed full outer join, but it can split the left side of a left outer
    one; the right rows without a partner come from an anti join against the distinct left keys.
    Columns keep their names, also those that both sides have.
    """
    l, r = (F.struct(*(df[c] for c in df.columns)) for df in (left, right))
    matched = left.join(right, left[left_key] == right[right_key], "left").select(
        l.alias("__l"), F.when(right[right_key].isNotNull(), r).alias("__r")
    )
    alone = anti_join(right, left, right_key, left_key)
    alone = alone.select(F.lit(None).cast(left.schema).alias("__l"), F.struct("*").alias("__r"))
    return matched.union(alone).select("__l.*", "__r.*")


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold more than ``share`` of the rows: fewer than ``1 / share`` values."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).count()
    limit = max(1, int(df.count() * share))
    return [row[0] for row in counts.filter(F.col("count") > limit).select(key).collect()]


def salt_pair(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    spread_by: Sequence[str],
    hot: Sequence,
    salts: int = 64,
    into: str = "salt",
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column, so that no hot key of ``fact`` meets in one partition.

    Rows of a ``hot`` key (see ``hot_keys``) take one of ``salts`` salts from a hash of
    ``spread_by``; the other rows have salt 0. ``dim`` repeats only its hot rows, once per salt.
    Join on (key, salt). With the keys given it works on streams, where AQE does not split.
    """
    salt, copies = F.lit(0), F.array(F.lit(0))
    if hot:
        spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
        salt = F.when(F.col(fact_key).isin(list(hot)), spread).otherwise(salt)
        each = F.array(*[F.lit(i) for i in range(salts)])
        copies = F.when(F.col(dim_key).isin(list(hot)), each).otherwise(copies)
    return fact.withColumn(into, salt), dim.withColumn(into, F.explode(copies))


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    spread_by: Sequence[str],
    hot: Sequence,
    how: str = "inner",
    salts: int = 64,
) -> DataFrame:
    """Inner or left join of ``fact`` with ``dim`` in which hot keys are spread over partitions."""
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left, not {how}")
    if not hot:
        return fact.join(dim, F.col(fact_key) == F.col(dim_key), how)
    left, right = salt_pair(fact, dim, fact_key, dim_key, spread_by, hot, salts, "__salt")
    right = right.withColumnRenamed("__salt", "__copy")
    condition = (F.col(fact_key) == F.col(dim_key)) & (F.col("__salt") == F.col("__copy"))
    return left.join(right, condition, how).drop("__salt", "__copy")


def range_join(
    points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float
) -> DataFrame:
    """Pairs with ``low <= point < high``, as an equi-join on cells.

    Each range is repeated for the cells it covers and a point lies in exactly one cell, so no
    pair is found twice and none is lost. Cells have the given ``width``, best near the usual
    length of a range. A range too long for that uses cells that are wider by powers of
    ``CELL_STEP``, so it never covers more than a few dozen; points are repeated once per cell
    size in use. A bound may be infinite: such a range covers cells as far as there are points.
    """
    ranges = ranges.filter(F.col(low) < F.col(high))
    from_, to = F.col(low).cast("double"), F.col(high).cast("double")
    if not ranges.filter((from_ == float("-inf")) | (to >= float("inf"))).isEmpty():
        ends = points.filter(F.abs(F.col(point).cast("double")) < float("inf"))
        least, most = ends.agg(F.min(point).cast("double"), F.max(point).cast("double")).first()
        if least is None:
            least, most = 0.0, 0.0
        from_, to = F.greatest(from_, F.lit(least)), F.least(to, F.lit(most + width))
    steps = F.log((to - from_) / F.lit(width)) / F.lit(math.log(CELL_STEP))
    level = F.greatest(F.ceil(steps) - 1, F.lit(0)).cast("int")
    covered = ranges.filter(from_ < to).withColumn("__level", level)
    top = covered.agg(F.max("__level")).first()[0] or 0

    def cell(value: Column) -> Column:
        size = F.lit(float(width)) * F.pow(F.lit(float(CELL_STEP)), F.col("__level"))
        return F.floor(value / size).cast("long")

    cells = F.sequence(cell(from_), cell(to))
    covered = covered.withColumn("__cell", F.explode(cells))
    levels = F.array(*[F.lit(i) for i in range(top + 1)])
    left = points.withColumn("__level", F.explode(levels)).withColumn("__cell", cell(F.col(point)))
    inside = (F.col(point) >= F.col(low)) & (F.col(point) < F.col(high))
    return left.join(covered, ["__level", "__cell"]).filter(inside).drop("__level", "__cell")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_time: str,
    right_time: str,
    seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Pairs of one key with ``left_time <= right_time <= left_time + seconds``; batch or stream.

    Time is cut into cells of the interval's length. A left row lies in one cell and a right row
    is repeated for the two cells where its partners can lie, so a key with many rows is spread
    over its cells and is never compared with itself as a whole. Only the right side is repeated,
    which keeps ``how="left"`` correct. On streams set watermarks on both times first; the time
    bounds in the condition let Spark drop old join state.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"interval_join supports inner and left, not {how}")
    width = seconds * 1_000_000

    def cell(name: str) -> Column:
        micros = F.unix_micros(F.col(name))
        return micros - F.pmod(micros, F.lit(width))

    a = left.withColumn("__lcell", cell(left_time))
    own = cell(right_time)
    b = right.withColumn("__rcell", F.explode(F.array(own, own - F.lit(width))))
    condition = (
        (F.col(left_key) == F.col(right_key))
        & (F.col("__lcell") == F.col("__rcell"))
        & (F.col(right_time) >= F.col(left_time))
        & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {seconds} SECONDS"))
    )
    return a.join(b, condition, how).drop("__lcell", "__rcell")
