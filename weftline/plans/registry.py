"""The named queries: each is a function over the given tables, with its SQL twin if it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The parquet tables of one folder, loaded by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``Tables -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        return lambda spark, folder: fn(Tables(spark, folder))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def all_sql() -> dict[str, str]:
    return dict(_SQL)
