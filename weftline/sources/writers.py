"""Writing tables: files, catalog tables, bucketed tables, several results at once."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> str:
    out = df.repartition(files) if files else df
    out.write.mode(mode).parquet(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_csv(df: DataFrame, path: str, separator: str = ",", mode: str = "overwrite") -> str:
    """Delimited text with a header and doubled quotes, in as many files as there are tasks."""
    options = {"header": True, "sep": separator, "escape": '"'}
    # By default the writer would trim the values.
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options).csv(path)
    return path


def write_report_csv(df: DataFrame, path: str) -> str:
    """One CSV file with a header, of any length: computed in parallel, then passed through one writer."""
    return write_csv(df.repartition(1), path)


def write_table(df: DataFrame, name: str, path: str | None = None, mode: str = "errorifexists") -> str:
    """A catalog table; the default mode fails if it exists."""
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return name


def bucket_count(rows: int, rows_per_bucket: int = 5_000_000, least: int = 8) -> int:
    """A bucket count for a table of this size; give the larger table's count to both sides."""
    return max(least, math.ceil(rows / rows_per_bucket))


def write_bucketed(
    df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str], sort: Sequence[str] | None = None
) -> str:
    """A table bucketed and sorted by the keys, replacing one of the same name.

    Rows are first brought together by bucket, so each bucket is one file and stays sorted. Two
    tables join without a shuffle only if their bucket counts are equal. Against a hot key add the
    salt column of ``salt_pair`` to the keys on both sides.
    """
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, *keys)
        .write.option("path", path)
        .bucketBy(buckets, keys[0], *keys[1:])
        .sortBy(*(sort or keys))
        .saveAsTable(name)
    )
    return name


def write_many(frames: Mapping[str, DataFrame], parallelism: int = 4) -> dict[str, str]:
    """Write each frame to its path, several Spark jobs at a time; fails if one of them fails."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return dict(zip(frames, pool.map(lambda e: write_parquet(e[1], e[0]), frames.items())))
