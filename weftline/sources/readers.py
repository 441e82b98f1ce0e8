"""Reading tables: files with a schema from four places, catalog tables, local rows, ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.columns import stable_number
from weftline.schemas import require_schema, schema_of

NULL_MARK = "\\N"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    separator: str = ",",
    header: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Delimited text by ``StructType`` or DDL string; without a schema the types are inferred.

    Inference reads the data twice, so give a schema for anything large. ``multiline`` allows line
    breaks inside quotes, at the price that a file is no longer split between tasks.
    """
    # Quotes as write_csv doubles them. An unquoted empty field is NULL and a quoted one an empty text,
    # which needs a null mark other than the empty text.
    options = {"header": header, "sep": separator, "quote": '"', "escape": '"', "nullValue": NULL_MARK}
    if multiline:
        options["multiLine"] = True
    if schema is None:
        return spark.read.csv(path, inferSchema=True, **options)
    return spark.read.schema(schema).csv(path, **options)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | type | None = None, infer: bool = False
) -> DataFrame:
    """JSON lines by schema or by dataclass; ``infer=True`` infers first and then checks it."""
    wanted = schema_of(schema) if isinstance(schema, type) else schema
    if infer or wanted is None:
        df = spark.read.json(path)
        return require_schema(df, wanted) if wanted is not None else df
    return spark.read.schema(wanted).json(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if schema is not None else spark.read.parquet(path)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A table from rows written in the program."""
    return spark.createDataFrame(list(rows), schema)


def number_range(spark: SparkSession, start: int, end: int, into: str = "id") -> DataFrame:
    """The integers from ``start`` up to but not including ``end``, made on the executors."""
    return spark.range(start, end).withColumnRenamed("id", into)


def synthetic_usage(keys: DataFrame, key: str, seed: int = 42, top: int = 1000) -> DataFrame:
    """A usage row per key: name and a usage below ``top`` that depend on key and seed only."""
    return keys.select(
        F.col(key).alias("uid"),
        F.concat(F.lit("user-"), F.col(key).cast("string")).alias("uname"),
        stable_number(top, key, seed).cast("int").alias("usage"),
    )


def column_listing(spark: SparkSession, view: str) -> DataFrame:
    """The columns of a catalog table or view, in order; as long as the table is wide."""
    rows = [
        (i, c.name, c.dataType) for i, c in enumerate(spark.catalog.listColumns(view))
    ]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string")


def database_listing(spark: SparkSession) -> DataFrame:
    """The databases of the current catalog."""
    rows = [(d.name, d.catalog) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "database_name string, catalog string")


def table_listing(spark: SparkSession, database: str | None = None, pattern: str | None = None) -> DataFrame:
    """Tables and temporary views, with their database (NULL for temporary views) and width.

    ``pattern`` is one of the catalog, where * stands for any characters.
    """
    rows = []
    for x in spark.catalog.listTables(database, pattern):
        place = x.namespace[-1] if x.namespace else None
        name = x.name if x.isTemporary or place is None else f"{place}.{x.name}"
        rows.append((place, x.name, x.tableType, x.isTemporary, len(spark.catalog.listColumns(name))))
    names = "database_name string, table_name string, kind string, is_temporary boolean, n_columns int"
    return spark.createDataFrame(rows, names)
