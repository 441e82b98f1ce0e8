"""Column builders: bucketing, tolerant parsing, text splitting, JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bucketize(column: Column, edges: Sequence[tuple[float, str]], beyond: str) -> Column:
    """The label of the first edge that the value does not exceed, else ``beyond``.

    Edges are inclusive and adjoin, so each non-null value gets exactly one label.
    """
    out = None
    for edge, label in edges:
        test = column <= edge
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.when(column.isNotNull(), beyond)


def two_way(condition: Column, yes: str, no: str) -> Column:
    return F.when(condition, yes).otherwise(no)


def tiered_cost(usage: Column, limit: float, above: float, below: float) -> Column:
    """Usage times ``above`` beyond the limit, times ``below`` up to it."""
    return F.when(usage > limit, usage * above).otherwise(usage * below)


def parse_money(column: Column, symbols: str = "$,") -> Column:
    """A number from text such as ``$1,200.00``; NULL if the rest is no number."""
    return F.translate(column, symbols, "").try_cast("double")


def parse_time(column: Column, pattern: str) -> Column:
    """A timestamp by pattern, NULL where the text does not match."""
    return F.try_to_timestamp(column, F.lit(pattern))


def year_of(column: Column) -> Column:
    return F.date_format(column, "yyyy").cast("int")


def _literal(text: str) -> str:
    """A pattern that matches exactly this text."""
    return "".join(c if c.isalnum() or c.isspace() else "\\" + c for c in text)


def words(column: Column, delimiter: str = " ") -> Column:
    """Text split at single delimiters; empty parts at the end are dropped, others are kept."""
    mark = _literal(delimiter)
    return F.split(F.regexp_replace(column, f"(?:{mark})+$", ""), mark)


def split_field(column: Column, delimiter: str, index: int, kind: str) -> Column:
    """Field ``index`` (from 1) of delimited text as ``kind``; NULL if absent or malformed."""
    return F.try_element_at(F.split(column, _literal(delimiter)), F.lit(index)).try_cast(kind)


def cast_by_type(df: DataFrame, source: type[T.DataType], target: str) -> DataFrame:
    """Cast every column of one type, in one projection."""
    return df.select(
        *[
            F.col(f.name).cast(target).alias(f.name) if isinstance(f.dataType, source) else f.name
            for f in df.schema
        ]
    )


def stable_number(below: int, *columns: str | int) -> Column:
    """A number from 0 to ``below - 1`` that depends only on the given columns and constants.

    The same on any partitioning and in any engine with MD5.
    """
    parts = [F.lit(c) if isinstance(c, int) else F.col(c) for c in columns]
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % below


def hash_split(df: DataFrame, key: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts by key hash; unlike ``randomSplit`` it repeats on any partitioning."""
    score = stable_number(100, key)
    return df.filter(score < percent), df.filter(score >= percent)
