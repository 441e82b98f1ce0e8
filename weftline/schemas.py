"""Schemas: derived from dataclasses, checked on read, and the record types used by the jobs."""

from __future__ import annotations

import dataclasses
import datetime
import decimal
import types
import typing

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_SCALARS: dict[type, T.DataType] = {
    str: T.StringType(),
    bool: T.BooleanType(),
    int: T.LongType(),
    float: T.DoubleType(),
    bytes: T.BinaryType(),
    decimal.Decimal: T.DecimalType(38, 0),
    datetime.datetime: T.TimestampType(),
    datetime.date: T.DateType(),
}


def _field_type(hint) -> tuple[T.DataType, bool]:
    """Spark type and nullability of one dataclass annotation."""
    origin, args = typing.get_origin(hint), typing.get_args(hint)
    if origin is typing.Annotated:
        # Annotated[int, IntegerType()] narrows the default mapping.
        return args[1], False
    if origin in (typing.Union, types.UnionType):
        inner = [a for a in args if a is not type(None)]
        if len(inner) != 1:
            raise TypeError(f"only Optional unions map to a column type, not {hint}")
        return _field_type(inner[0])[0], True
    if origin is list:
        return T.ArrayType(_field_type(args[0])[0]), False
    if dataclasses.is_dataclass(hint):
        return schema_of(hint), False
    if hint in _SCALARS:
        return _SCALARS[hint], False
    raise TypeError(f"no Spark type for {hint}")


def schema_of(cls: type) -> T.StructType:
    """The ``StructType`` of a dataclass; ``X | None`` becomes a nullable field."""
    hints = typing.get_type_hints(cls, include_extras=True)
    fields = []
    for field in dataclasses.fields(cls):
        kind, nullable = _field_type(hints[field.name])
        fields.append(T.StructField(field.name, kind, nullable))
    return T.StructType(fields)


def schema_difference(actual: T.StructType, expected: T.StructType) -> list[str]:
    """What differs by name or type; nullability is left out, as file sources drop it."""
    have = {f.name: f.dataType.simpleString() for f in actual}
    want = {f.name: f.dataType.simpleString() for f in expected}
    missing = [f"missing {n} {t}" for n, t in want.items() if n not in have]
    extra = [f"unexpected {n} {t}" for n, t in have.items() if n not in want]
    wrong = [f"{n} is {have[n]}, not {t}" for n, t in want.items() if n in have and have[n] != t]
    return missing + extra + wrong


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """``df`` with the columns in the expected order, or an error that lists every difference."""
    problems = schema_difference(df.schema, expected)
    if problems:
        raise ValueError("schema mismatch: " + "; ".join(problems))
    return df.select(*expected.names)


Int = typing.Annotated[int, T.IntegerType()]


@dataclasses.dataclass
class Order:
    """One row of the orders table as JSON holds it (the date as text)."""

    o_orderkey: int
    o_custkey: int
    o_orderstatus: str | None
    o_totalprice: float | None
    o_orderdate: str | None
    o_orderpriority: str | None


@dataclasses.dataclass
class Customer:
    """One row of the customer table."""

    c_custkey: int
    c_name: str | None
    c_nationkey: Int
    c_acctbal: float | None
    c_mktsegment: str | None


CONVERSATION = T.StructType(
    [
        T.StructField("conv_id", T.LongType(), False),
        T.StructField("roles", T.ArrayType(T.StringType()), True),
    ]
)
EVENT_PAYLOAD = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)
EVENT_PROPS = T.StructType([T.StructField("k", T.LongType())])
