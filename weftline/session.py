"""Session set-up, scratch folders and scoped caching."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# For clusters. Batch shuffles start with many partitions, which AQE merges to about 128 MB each;
# state partitions of streams follow spark.sql.shuffle.partitions instead, fixed at the first start.
# Large state belongs on disk, not in the executors' heap.
CLUSTER = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Scratch folders made for sessions that name none, by application id (local masters only).
_own_folders: dict[str, str] = {}


def build_session(
    name: str = "weftline", master: str | None = None, shuffle_partitions: int | None = None, **conf
) -> SparkSession:
    """A session with the settings the operators expect: UTC, AQE and AQE skew handling.

    On a cluster leave ``master`` unset, as ``spark-submit`` names it; ``CLUSTER`` is then added.
    """
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        for key, value in CLUSTER.items():
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a local master may run without it; it then gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own_folders:
        folder = tempfile.mkdtemp(prefix="weftline-")
        sc.setCheckpointDir(folder)
        _own_folders[sc.applicationId] = folder
    return _own_folders[sc.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that no earlier call has returned."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage, and the result survives the loss of any executor.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores.

    For work that is heavy per row over a table of few, unsplittable files; ``df`` should be a plain
    scan. A table that already has enough partitions is left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@contextmanager
def reuse(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` persisted for the block, and always release it."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
