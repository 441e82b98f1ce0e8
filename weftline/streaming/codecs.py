"""Key/value records as message brokers carry them; batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode_kv(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Binary key and value: the key as text, the value as one JSON object of the columns."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*columns)).cast("binary").alias("value"),
    )


def encode_text(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Binary key and value: the key as text, the value as built."""
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"),
    )


def decode_json(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """The fields of a JSON value, binary or text; fields that do not parse are NULL."""
    data = F.from_json(F.col(value).cast("string"), schema)
    return df.select(data.alias("data")).select("data.*")


def broker_stream(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest"
) -> DataFrame:
    """The records of a Kafka topic; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )
