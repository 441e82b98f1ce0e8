"""Compare a Spark result with its SQL twin in DuckDB over the same tables."""

from __future__ import annotations

import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(rows, order):
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if names, types and the multiset of rows agree, else what differs."""
    names = sorted(df.columns)
    theirs = con.execute(sql)
    their_names = [d[0] for d in theirs.description]
    if names != sorted(their_names):
        return f"columns {names} != {sorted(their_names)}"
    kinds = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    their_kinds = {d[0]: str(d[1]) for d in theirs.description}
    wrong = [f"{n}: {kinds[n]} != {their_kinds[n]}" for n in names if kinds[n] != their_kinds[n]]
    expected = _rows(theirs.fetchall(), [their_names.index(n) for n in names])
    found = _rows([tuple(r) for r in df.collect()], [df.columns.index(n) for n in names])
    if found != expected:
        extra = [r for r in found if r not in set(expected)][:3]
        lacking = [r for r in expected if r not in set(found)][:3]
        return f"{len(found)} rows, expected {len(expected)}; only ours {extra}; only theirs {lacking}"
    return f"types {wrong}" if wrong else None
