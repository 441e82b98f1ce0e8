"""Progress reports of streaming queries as a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PROGRESS_SCHEMA = (
    "batch_id long, input_rows long, output_rows long, state_rows long, "
    "rows_dropped_by_watermark long, watermark string"
)


def progress_table(spark: SparkSession, progress: Sequence) -> DataFrame:
    """One row per micro-batch."""
    rows = []
    for p in progress:
        operators = p["stateOperators"]
        rows.append(
            (
                int(p["batchId"]),
                int(p["numInputRows"]),
                int(p["sink"]["numOutputRows"]),
                sum(int(o["numRowsTotal"]) for o in operators),
                sum(int(o["numRowsDroppedByWatermark"]) for o in operators),
                (p["eventTime"] or {}).get("watermark"),
            )
        )
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def dropped_rows(progress: Sequence) -> int:
    """Rows that all stateful operators dropped as late."""
    return sum(int(o["numRowsDroppedByWatermark"]) for p in progress for o in p["stateOperators"])
