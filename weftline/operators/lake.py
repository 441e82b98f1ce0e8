"""Row changes and snapshots as table-to-table functions.

Each function returns the new table; write it to a fresh folder, never over a path being read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.schemas import schema_difference


def update(target: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; a NULL condition changes nothing."""
    return target.select(
        *[
            F.when(condition, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
            for c in target.columns
        ]
    )


def delete(target: DataFrame, condition: Column) -> DataFrame:
    """Remove rows where the condition is true; a NULL condition keeps the row."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source`` unchanged, or a failing job if any key occurs twice; NULL equals no other key."""
    whole = F.lit(True)
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    unmatched, source = source.filter(~whole), source.filter(whole)
    rest = [c for c in source.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*rest)).alias("__row")
    )
    message = f"several source rows for one key ({', '.join(keys)})"
    checked = grouped.filter(F.assert_true(F.col("__n") == 1, message).isNull())
    return checked.select(*keys, "__row.*").select(*source.columns).unionByName(unmatched)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the others are added."""
    fresh = one_row_per_key(source, keys)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh)


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source rows whose key the target does not have."""
    known = target.select(*keys).distinct()
    return target.unionByName(source.join(known, list(keys), "left_anti"))


@dataclass(frozen=True)
class Clause:
    """One merge clause, tried in order: the first whose condition is true decides the row.

    ``kind`` is "update" or "delete" for matched keys, "insert" for new ones. ``when`` and
    ``values`` refer to the two rows as ``t.<column>`` and ``s.<column>``; without ``values``
    the whole source row is taken.
    """

    kind: str
    when: str | None = None
    values: Mapping[str, str] = field(default_factory=dict)


def merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], clauses: Sequence[Clause]
) -> DataFrame:
    """Apply ordered merge clauses to the pairs of rows with equal keys and to the rows without a partner.

    A left join and an anti join take the place of a full outer one, whose hot keys AQE cannot split.
    """
    unknown = {c.kind for c in clauses} - {"update", "delete", "insert"}
    if unknown:
        raise ValueError(f"unknown merge clause: {sorted(unknown)}")
    columns = target.columns
    t = target.select(*keys, F.struct(*columns).alias("t"))
    s = one_row_per_key(source, keys).select(*keys, F.struct(*source.columns).alias("s"))
    new = s.join(t.select(*keys).distinct(), list(keys), "left_anti")
    both = t.join(s, list(keys), "left").unionByName(new, allowMissingColumns=True)

    matched = F.col("t").isNotNull() & F.col("s").isNotNull()
    is_new = F.col("t").isNull()
    action = F.lit(None).cast("int")
    for i, clause in reversed(list(enumerate(clauses))):
        applies = is_new if clause.kind == "insert" else matched
        if clause.when:
            applies = applies & F.coalesce(F.expr(clause.when), F.lit(False))
        action = F.when(applies, i).otherwise(action)
    both = both.withColumn("__action", action)

    removed = [i for i, c in enumerate(clauses) if c.kind == "delete"]
    keep = F.col("t").isNotNull() | F.col("__action").isNotNull()
    if removed:
        keep = keep & ~F.coalesce(F.col("__action").isin(removed), F.lit(False))

    def new_value(c: str) -> Column:
        value = F.col(f"t.{c}")
        for i, clause in enumerate(clauses):
            if clause.kind == "delete":
                continue
            if c in clause.values:
                chosen = F.expr(clause.values[c])
            elif clause.values and clause.kind == "update":
                chosen = F.col(f"t.{c}")
            elif c in source.columns and not clause.values:
                chosen = F.col(f"s.{c}")
            else:
                chosen = F.lit(None)
            kind = target.schema[c].dataType
            value = F.when(F.col("__action") == i, chosen.cast(kind)).otherwise(value)
        return value.alias(c)

    return both.filter(keep).select(*[new_value(c) for c in columns])


def append_strict(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append, or an error if the source's columns or types differ."""
    problems = schema_difference(source.schema, target.schema)
    if problems:
        raise ValueError("cannot append: " + "; ".join(problems))
    return target.unionByName(source)


def append_evolving(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append; columns that only one side has are NULL in the rows of the other."""
    return target.unionByName(source, allowMissingColumns=True)


def create_empty(target_path: str, schema: T.StructType, spark) -> DataFrame:
    """Write a table without rows unless the path holds one already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(target_path)
    return spark.read.schema(schema).parquet(target_path)


def snapshot(
    log: DataFrame,
    keys: Sequence[str],
    version: int | None = None,
    as_of: Column | None = None,
    order_within: str | None = None,
) -> DataFrame:
    """The table as a change log describes it at a version or at a commit time.

    The log has ``version``, ``commit_ts`` and ``op`` ("put", "delete" or "overwrite") beside the
    data columns. A version is committed as a whole, at the time of its last entry; a time means the
    newest version committed by then. An overwrite version drops everything before it. Per key the last entry wins,
    by one map-side combined aggregate, so a key with many changes needs no sort.
    """
    entries = log
    if version is not None:
        entries = entries.filter(F.col("version") <= version)
    if as_of is not None:
        times = log.groupBy("version").agg(F.max("commit_ts").alias("committed"))
        newest = times.filter(F.col("committed") <= as_of).agg(F.max("version").alias("v")).scalar()
        entries = entries.filter(F.col("version") <= newest)
    resets = entries.filter(F.col("op") == "overwrite")
    start = resets.agg(F.coalesce(F.max("version"), F.lit(-1)).cast("long").alias("v")).scalar()
    entries = entries.filter(F.col("version") >= start)

    hidden = {"version", "commit_ts", "op", *keys, *([order_within] if order_within else [])}
    data = [c for c in log.columns if c not in hidden]
    order = F.struct("version", order_within) if order_within else F.col("version")
    last = entries.groupBy(*keys).agg(F.max_by(F.struct("op", *data), order).alias("row"))
    return last.filter(F.col("row.op") != "delete").select(*keys, *[f"row.{c}" for c in data])


def history(log: DataFrame, last: int) -> DataFrame:
    """The newest ``last`` versions with commit time, operations, and the number of entries of each kind."""
    return (
        log.groupBy("version")
        .agg(
            F.max("commit_ts").alias("commit_ts"),
            F.array_join(F.array_sort(F.collect_set("op")), "+").alias("operation"),
            F.count(F.lit(1)).alias("entries"),
            *(F.count_if(F.col("op") == op).alias(f"{op}s") for op in ("put", "delete", "overwrite")),
        )
        .orderBy(F.col("version").desc())
        .limit(last)
    )
