"""Gap-based sessions over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.ranking import null_safe_join

# Cells of a key that one task puts in order.
CHUNK_CELLS = 10_000


def sessions(
    df: DataFrame,
    key: str,
    time: str,
    gap_seconds: int,
    sums: Sequence[tuple[str, Column]] = (),
    chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """Sessions per key that end when the next row is more than ``gap_seconds`` away.

    Rows of one key in one cell of the gap's length are always in the same session, so they are
    combined before the shuffle. Time is cut into chunks of ``chunk_cells`` cells: sessions are found per key
    and chunk, then stitched where the last of a chunk and the first of the next are no gap apart. So a hot
    key is spread over its chunks, and what is looked at as a whole is one row per chunk. ``sums`` are
    additive aggregates by name, such as ``("total", F.col("value"))``.
    Columns: key, ``session_start``, ``session_end`` (last row plus the gap), ``n`` and the sums.
    """
    width = gap_seconds * 1_000_000
    names = [name for name, _ in sums]
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    cells = (
        df.withColumn("__t", micros)
        .withColumn("__cell", F.col("__t") - F.pmod(F.col("__t"), F.lit(width)))
        .groupBy(key, "__cell")
        .agg(
            F.min("__t").alias("__first"),
            F.max("__t").alias("__last"),
            F.count(F.lit(1)).alias("n"),
            *[F.sum(c).alias(name) for name, c in sums],
        )
        .withColumn("__chunk", F.floor(F.col("__cell") / width / chunk_cells))
    )
    ordered = Window.partitionBy(key, "__chunk").orderBy("__cell")
    starts = F.col("__first") - F.lag("__last").over(ordered) > F.lit(width)
    numbered = cells.withColumn("__new", F.coalesce(starts, F.lit(False)).cast("int"))
    numbered = numbered.withColumn("__number", F.sum("__new").over(ordered))
    parts = [F.min("__first").alias("__first"), F.max("__last").alias("__last"), F.sum("n").alias("n")]
    parts += [F.sum(name).alias(name) for name in names]
    local = numbered.groupBy(key, "__chunk", "__number").agg(*parts)

    edges = local.groupBy(key, "__chunk").agg(
        F.min("__first").alias("__begin"), F.max("__last").alias("__end"), F.max("__number").alias("__top")
    )
    chunks = Window.partitionBy(key).orderBy("__chunk")
    linked = F.coalesce(F.col("__begin") - F.lag("__end").over(chunks) <= F.lit(width), F.lit(False))
    edges = edges.withColumn("__linked", linked)
    # The chunk in which the session began that is open at the end of a chunk.
    began = F.when((F.col("__top") > 0) | ~F.col("__linked"), F.col("__chunk"))
    edges = edges.withColumn("__origin", F.last(began, ignorenulls=True).over(chunks))
    edges = edges.withColumn("__before", F.lag("__origin").over(chunks))
    edges = edges.select(key, "__chunk", "__top", "__linked", "__before")

    joined = null_safe_join(local, edges, [key, "__chunk"])
    goes_on = F.col("__linked") & (F.col("__number") == 0)
    is_last = F.col("__number") == F.col("__top")
    joined = joined.withColumn("__from", F.when(goes_on, F.col("__before")).otherwise(F.col("__chunk")))
    joined = joined.withColumn("__session", F.when(goes_on | is_last, F.lit(-1)).otherwise(F.col("__number")))
    out = joined.groupBy(key, "__from", "__session").agg(*parts)
    return out.select(
        key,
        F.timestamp_micros("__first").alias("session_start"),
        F.timestamp_micros(F.col("__last") + F.lit(width)).alias("session_end"),
        "n",
        *names,
    )
