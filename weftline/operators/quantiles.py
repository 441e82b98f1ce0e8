"""Exact quantiles of several columns in two scans: a sketch bounds each place, a count decides it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.ranking import as_double, null_safe_join
from weftline.session import settle

# Size of the KLL sketches: about 3 x 8 x K bytes a group and column at most.
K = 16_384


def rank_error(k: int) -> float:
    """Thrice the share of ranks by which a KLL sketch of size ``k`` errs at 99 % (its published bound)."""
    return 3 * 2.296 / k**0.9021


def two_scan_quantiles(
    df: DataFrame,
    columns: Mapping[str, Mapping[str, float]],
    groups: Sequence[str] = (),
    interpolate: bool = True,
    k: int = K,
) -> DataFrame:
    """Exact quantiles of the non-null values: a row per group and column.

    ``columns`` maps each numeric or time column to {name: p}. Returns the groups, ``column_name`` and every name
    (null where a column does not ask for it; values as doubles if there are several columns). ``interpolate=True``
    is linear between neighbours; ``False`` takes the smallest value whose share of the rows reaches p. Groups
    without a value in a column have no row for it, and NaN is above all numbers.

    The first scan makes a mergeable sketch per group, whose rank bounds give a range of values for each quantile. The
    second keeps only values within such a range, counted by value, and one count for each gap between ranges, both
    before the shuffle; so of a group of any size a few thousandths are sorted. The ranges are written, so
    a lost executor cannot change them between the two. Should a place fall outside its range after
    all, the job fails and asks for a larger ``k``.
    """
    groups, names = list(groups), list(columns)
    keys = [f"__d{i}" for i in range(len(names))]
    # NaN, which sketches pass over, counts as the largest value.
    as_key = [F.nanvl(as_double(df, c), F.lit(float("inf"))).alias(d) for c, d in zip(names, keys)]
    marked = df.select(*groups, *names, *as_key)

    error = rank_error(k)
    sketches = marked.groupBy(*groups).agg(*[F.kll_sketch_agg_double(d, F.lit(k)).alias(d) for d in keys])

    def at(d: str, share: float, outside: float) -> Column:
        return F.kll_sketch_get_quantile_double(d, F.lit(share)) if 0 <= share <= 1 else F.lit(outside)

    def ranges(d: str, wanted: Mapping[str, float]) -> Column:
        """Ranges half as wide again as the error, for the neighbours of a place; small groups are sorted whole."""
        n, top = F.kll_sketch_get_n_double(d), float("inf")
        pairs = [
            F.struct(at(d, p - 1.5 * error, -top).alias("lo"), at(d, p + 1.5 * error, top).alias("hi"))
            for p in sorted(set(wanted.values()))
        ]
        whole = F.array(F.struct(F.lit(-top).alias("lo"), F.lit(top).alias("hi")))
        return F.when(n * error > 4, F.array(*pairs)).when(n > 0, whole).alias(d.replace("__d", "__r"))

    bounds = settle(sketches.select(*groups, *[ranges(d, columns[c]) for c, d in zip(names, keys)]), "bounds")
    if groups:
        joined = null_safe_join(marked, bounds, groups)
    else:  # one row, by an equal key
        one = bounds.withColumn("__one", F.lit(1))
        joined = marked.withColumn("__one", F.lit(1)).join(F.broadcast(one), "__one")

    def cell(i: int) -> Column:
        """The value, if it lies in a range, else the number of ranges below it."""
        d, r = F.col(keys[i]), F.col(f"__r{i}")
        inside = F.exists(r, lambda x: (x["lo"] <= d) & (d <= x["hi"]))
        gap = F.size(F.filter(r, lambda x: x["hi"] < d))
        value = F.col(names[i]) if len(names) == 1 else F.col(names[i]).cast("double")
        return F.struct(F.lit(i).alias("i"), gap.alias("gap"), inside.alias("inside"), F.when(inside, value).alias("v"), d.alias("d"))

    cells = [F.when(F.col(d).isNotNull(), cell(i)) for i, d in enumerate(keys)]
    if len(names) == 1:
        rows = joined.filter(F.col(keys[0]).isNotNull()).select(*groups, cells[0].alias("x"))
    else:
        rows = joined.select(*groups, F.explode(F.array_compact(F.array(*cells))).alias("x"))
    by = [*groups, "i", "inside", "gap", "v"]
    counted = rows.select(*groups, "x.*").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("d"))

    line = Window.partitionBy(*groups, "i")
    so_far = line.orderBy("d", "inside", "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("upto", F.sum("n").over(so_far)).withColumn("rows", F.sum("n").over(line))

    asked = list(dict.fromkeys(name for wanted in columns.values() for name in wanted))
    outside = F.raise_error("a quantile lies outside its bounds: use a larger k")
    aggregates, outputs = [F.max("rows").alias("__rows")], []
    for name in asked:
        share = F.coalesce(*[F.when(F.col("i") == i, F.lit(float(columns[c][name]))) for i, c in enumerate(names) if name in columns[c]])
        n = F.col("rows")
        if interpolate:
            places = [F.floor(share * (n - 1)), F.ceil(share * (n - 1))]
        else:
            places = [F.greatest(n - F.floor(n - share * n), F.lit(1)) - 1]
        for j, place in enumerate(places):
            hit = share.isNotNull() & (F.col("upto") - F.col("n") <= place) & (place < F.col("upto"))
            found = F.when(F.col("inside"), F.col("v")).otherwise(outside)
            aggregates.append(F.min(F.when(hit, found)).alias(f"__{j}_{name}"))
        aggregates.append(F.max(share).alias(f"__p_{name}"))
        low = F.col(f"__0_{name}")
        if interpolate:
            spot = F.col(f"__p_{name}") * (F.col("__rows") - 1)
            part = spot - F.floor(spot)
            low = low * (1 - part) + F.col(f"__1_{name}") * part
        outputs.append(low.alias(name))
    column_name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("i") + 1).alias("column_name")
    return placed.groupBy(*groups, "i").agg(*aggregates).select(*groups, column_name, *outputs)


def quantiles(
    df: DataFrame, value: str, wanted: Mapping[str, float], groups: Sequence[str] = (), interpolate: bool = True, k: int = K
) -> DataFrame:
    """``two_scan_quantiles`` of one column: the groups and a column per quantile; without values one row of nulls."""
    found = two_scan_quantiles(df, {value: wanted}, groups, interpolate, k).drop("column_name")
    return found if groups else found.agg(*[F.max(n).alias(n) for n in wanted])
