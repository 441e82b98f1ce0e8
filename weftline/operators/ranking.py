"""Ranks, running counts, exact quantiles and top values for groups of any size.

A plain analytic window sorts each group in one task, which fails when one group holds a large
part of the table. Here equal values are counted first, the value range is cut into chunks of
about equal size, and only (group, chunk) pieces are sorted; the counts of the earlier chunks are
then added. Results are exact wherever the cuts fall.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A group up to this size may be sorted by one task; beyond it the pieces are used.
WHOLE_ROWS = 1_000_000
CHUNK_ROWS = 100_000
MAX_CHUNKS = 16_384
SAMPLES_PER_CHUNK = 200
PICKED_PIECES = 10_000


def as_double(df: DataFrame, name: str) -> Column:
    """A non-decreasing map of the column to double, for cutting only; times become microseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"{name} must be numeric or a time, not {kind.simpleString()}")


def cut_points(df: DataFrame, name: str, rows: int, parts: int) -> list[float]:
    """At most ``parts - 1`` rising values that cut the column into parts of about equal size.

    Like Spark's own range partitioning this looks at a sample, as quantile sketches of a whole
    large table are slow to merge. Where the cuts fall affects balance, never results.
    """
    if parts <= 1:
        return []
    share = min(1.0, parts * SAMPLES_PER_CHUNK / max(1, rows))
    seen = df.select(as_double(df, name).alias("v"))
    if share < 1.0:
        seen = seen.sample(share, seed=7)
    found = seen.approxQuantile("v", [i / parts for i in range(1, parts)], 1 / (4 * parts))
    return sorted({p for p in found if math.isfinite(p)})


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name where NULL matches NULL; keeps the left keys."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def add_chunk(df: DataFrame, value: str, rows: int, rows_per_chunk: int, into: str = "chunk") -> DataFrame:
    """Number the pieces of the value range so that one piece holds about ``rows_per_chunk`` rows.

    Rows with the same value share a piece; NULL, the smallest value, gets piece -1.
    """
    points = cut_points(df, value, rows, min(MAX_CHUNKS, math.ceil(rows / rows_per_chunk)))
    cut = df.withColumn("__cut", as_double(df, value))
    if not points:
        return cut.withColumn(into, F.when(F.col("__cut").isNull(), -1).otherwise(0)).drop("__cut")
    splits = [-math.inf, *points, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="__cut", outputCol="__chunk", handleInvalid="keep")
    chunk = F.coalesce(F.col("__chunk").cast("int"), F.lit(-1))
    return bucketizer.transform(cut).withColumn(into, chunk).drop("__cut", "__chunk")


def _pieces(df: DataFrame, groups: Sequence[str], sizes: Mapping[str, Column]) -> DataFrame:
    """Per (group, chunk) and size: its amount, ``<size>_ahead`` in earlier chunks, ``group_<size>``."""
    pieces = df.groupBy(*groups, "chunk").agg(*[size.alias(f"piece_{s}") for s, size in sizes.items()])
    earlier = Window.partitionBy(*groups).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    columns = []
    for s in sizes:
        amount = F.col(f"piece_{s}")
        columns += [
            amount,
            F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias(f"{s}_ahead"),
            F.sum(amount).over(whole).alias(f"group_{s}"),
        ]
    return pieces.select(*groups, "chunk", *columns)


def cumulative(
    df: DataFrame, groups: Sequence[str], value: str, rows_per_chunk: int = CHUNK_ROWS
) -> DataFrame:
    """One row per (group, value), with counts over the ordered group.

    Columns: the groups, ``value``, ``n`` (rows with this value), ``before`` (rows with a smaller
    value), ``position`` (1 for the smallest value), ``group_rows`` and ``group_values``.
    """
    groups = list(groups)
    slim = add_chunk(df.select(*groups, value), value, df.count(), rows_per_chunk)
    counts = slim.groupBy(*groups, "chunk", value).agg(F.count(F.lit(1)).alias("n"))

    pieces = _pieces(counts, groups, {"rows": F.sum("n"), "values": F.count(F.lit(1))})

    inside = Window.partitionBy(*groups, "chunk").orderBy(value)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = counts.select(
        "*",
        (F.sum("n").over(so_far) - F.col("n")).alias("local_before"),
        F.row_number().over(inside).alias("local_position"),
    )
    return null_safe_join(local, pieces, [*groups, "chunk"]).select(
        *groups,
        value,
        "n",
        (F.col("rows_ahead") + F.col("local_before")).alias("before"),
        (F.col("values_ahead") + F.col("local_position")).alias("position"),
        "group_rows",
        "group_values",
    )


def with_ranks(
    df: DataFrame,
    groups: Sequence[str],
    order_by: str,
    descending: bool = False,
    rank: str | None = None,
    dense_rank: str | None = None,
    running_count: str | None = None,
    row_number: str | None = None,
    tie_break: str | None = None,
    whole_rows: int = WHOLE_ROWS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Add the named analytic columns over ``groups`` ordered by ``order_by``.

    ``running_count`` uses the default frame, so rows with equal order values share it.
    ``row_number`` needs ``tie_break``, a column that is unique within the group and not NULL.
    Groups of up to ``whole_rows`` rows are ranked by plain windows.
    """
    groups = list(groups)
    if row_number and not tie_break:
        raise ValueError("row_number needs a unique tie_break column to be repeatable")
    names = dict(rank=rank, dense_rank=dense_rank, running_count=running_count, row_number=row_number)
    spec = dict(order_by=order_by, descending=descending, tie_break=tie_break, **names)
    if not groups:
        if df.count() <= whole_rows:
            return _plain_ranks(df, groups, **spec)
        return _chunked_ranks(df, groups, whole_rows, rows_per_chunk, **spec)

    sizes = df.groupBy(*groups).count().filter(F.col("count") > whole_rows).select(*groups)
    large = sizes.limit(PICKED_PIECES + 1).collect()
    if not large:
        return _plain_ranks(df, groups, **spec)
    if len(large) > PICKED_PIECES:
        return _chunked_ranks(df, groups, whole_rows, rows_per_chunk, **spec)
    # Only the large groups take the longer way.
    listed = F.broadcast(df.sparkSession.createDataFrame(large, sizes.schema))
    others = null_safe_join(df, listed, groups, "left_anti")
    hot = null_safe_join(df, listed, groups, "left_semi")
    return _plain_ranks(others, groups, **spec).unionByName(
        _chunked_ranks(hot, groups, whole_rows, rows_per_chunk, **spec)
    )


def _chunked_ranks(
    df,
    groups,
    whole_rows,
    rows_per_chunk,
    order_by,
    descending,
    rank,
    dense_rank,
    running_count,
    row_number,
    tie_break,
) -> DataFrame:
    keys = [*groups, order_by]
    table = cumulative(df, groups, order_by, rows_per_chunk)
    after = F.col("group_rows") - F.col("before") - F.col("n")
    ahead = after if descending else F.col("before")
    position = F.col("group_values") - F.col("position") + 1 if descending else F.col("position")
    columns = []
    if rank:
        columns.append((ahead + 1).cast("int").alias(rank))
    if dense_rank:
        columns.append(position.cast("int").alias(dense_rank))
    if running_count:
        columns.append((ahead + F.col("n")).alias(running_count))
    rows = df
    if row_number:
        # Rows of equal value may again be many: they are numbered by the tie break in the same way.
        rows = with_ranks(
            df, keys, tie_break, rank="__tie", whole_rows=whole_rows, rows_per_chunk=rows_per_chunk
        )
        columns.append(ahead.alias("__ahead"))
    out = null_safe_join(rows, table.select(*keys, *columns), keys)
    if row_number:
        out = out.withColumn(row_number, (F.col("__ahead") + F.col("__tie")).cast("int"))
    added = [c for c in (rank, dense_rank, running_count, row_number) if c]
    return out.select(*df.columns, *added)


def _plain_ranks(
    df, groups, order_by, descending, rank, dense_rank, running_count, row_number, tie_break
) -> DataFrame:
    """Spark's analytic functions, which sort each group in one task."""
    key = F.col(order_by).desc() if descending else F.col(order_by).asc()
    w = Window.partitionBy(*groups).orderBy(key)
    columns = []
    if rank:
        columns.append(F.rank().over(w).alias(rank))
    if dense_rank:
        columns.append(F.dense_rank().over(w).alias(dense_rank))
    if running_count:
        columns.append(F.count("*").over(w).alias(running_count))
    if row_number:
        columns.append(
            F.row_number().over(Window.partitionBy(*groups).orderBy(key, tie_break)).alias(row_number)
        )
    return df.select("*", *columns)


def top_values(
    df: DataFrame, groups: Sequence[str], value: str, k: int, into: str = "rank"
) -> DataFrame:
    """Rows whose value is among the ``k`` largest distinct values of their group, with that rank.

    One scan and one shuffle: Spark limits ``dense_rank`` below the shuffle, so a task receives from
    each map task only rows with its ``k`` largest values per group.
    """
    w = Window.partitionBy(*groups).orderBy(F.col(value).desc())
    return df.withColumn(into, F.dense_rank().over(w)).filter(F.col(into) <= k)


def exact_quantiles(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    groups: Sequence[str] = (),
    interpolate: bool = True,
    whole_rows: int = WHOLE_ROWS,
    rows_per_chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Exact quantiles of the non-null values, one column per entry of ``quantiles``.

    ``interpolate=True`` is linear between neighbours; ``False`` returns the smallest value whose
    share of the rows reaches the quantile. If no group has more than ``whole_rows`` values, one
    pass sorts each group as a whole; beyond that, two passes sort only the pieces that matter.
    """
    groups = list(groups)
    known = df.filter(F.col(value).isNotNull()).select(*groups, value)

    def indexes(p: float) -> list[Column]:
        """The places, counted from 0, of the rows that decide the quantile."""
        rows = F.col("group_rows")
        if interpolate:
            return [F.floor(F.lit(p) * (rows - 1)), F.ceil(F.lit(p) * (rows - 1))]
        return [F.greatest(rows - F.floor(rows - F.lit(p) * rows), F.lit(1)) - 1]

    sizes = known.groupBy(*groups).agg(F.count(F.lit(1)).alias("group_rows"))
    few = sizes.limit(PICKED_PIECES + 1).collect()
    if len(few) <= PICKED_PIECES:
        largest = max((row["group_rows"] for row in few), default=0)
        sizes = F.broadcast(df.sparkSession.createDataFrame(few, sizes.schema))
    else:
        largest = sizes.agg(F.max("group_rows")).first()[0]
    if largest <= whole_rows:
        counts = known.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
        so_far = Window.partitionBy(*groups).orderBy(value)
        so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        table = counts.withColumn("upto", F.sum("n").over(so_far))
        if groups:
            table = null_safe_join(table, sizes, groups)
        else:
            table = table.withColumn("group_rows", F.lit(largest).cast("bigint"))
    else:
        places = [index for p in quantiles.values() for index in indexes(p)]
        table = _deciding_pieces(known, groups, value, places, rows_per_chunk)

    aggregates, outputs = [F.max("group_rows").alias("__rows")], []
    for name, p in quantiles.items():
        hits = [(F.col("upto") - F.col("n") <= i) & (i < F.col("upto")) for i in indexes(p)]
        ends = [f"__{k}_{name}" for k in range(len(hits))]
        aggregates += [F.min(F.when(hit, F.col(value))).alias(e) for hit, e in zip(hits, ends)]
        result = F.col(ends[0])
        if interpolate:
            spot = F.lit(p) * (F.col("__rows") - 1)
            share = spot - F.floor(spot)
            result = result * (1 - share) + F.col(ends[1]) * share
        outputs.append(result.alias(name))
    return table.groupBy(*groups).agg(*aggregates).select(*groups, *outputs)


def _deciding_pieces(
    known: DataFrame, groups: list[str], value: str, places: list[Column], rows_per_chunk: int
) -> DataFrame:
    """Values with their counts, ``upto`` and ``group_rows``, for the pieces that hold a place.

    The pieces are counted first, without a shuffle of rows; then only the chosen ones are sorted.
    """
    chunked = add_chunk(known, value, known.count(), rows_per_chunk)
    begin, end = F.col("rows_ahead"), F.col("rows_ahead") + F.col("piece_rows")
    wanted = F.lit(False)
    for place in places:
        wanted = wanted | ((place >= begin) & (place < end))
    picked = _pieces(chunked, groups, {"rows": F.count(F.lit(1))}).filter(wanted)
    picked = picked.select(*groups, "chunk", "rows_ahead", "group_rows")
    few = picked.limit(PICKED_PIECES + 1).collect()
    if len(few) <= PICKED_PIECES:
        picked = F.broadcast(known.sparkSession.createDataFrame(few, picked.schema))
    inside = null_safe_join(chunked, picked, [*groups, "chunk"])
    counts = inside.groupBy(*groups, "chunk", "rows_ahead", "group_rows", value).agg(
        F.count(F.lit(1)).alias("n")
    )
    so_far = Window.partitionBy(*groups, "chunk").orderBy(value)
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("upto", F.col("rows_ahead") + F.sum("n").over(so_far))
