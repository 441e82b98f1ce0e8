"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores. Each query runs
once to warm up and then BENCH_RUNS times; its time is the median. A query is timed from building
its plan to the last row, written to Spark's "noop" sink, so that no result is cut short by a
count or held back by the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark import StorageLevel
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weftline.plans import all_queries  # noqa: E402
from weftline.session import build_session, reuse  # noqa: E402

HEADLINES = [
    # scans, filters, functions
    "agg_count_col", "filter_and", "bucket_case", "word_count", "json_expand", "fn_parse_ts",
    # aggregation, quantiles, ranking
    "agg_global", "agg_count_distinct", "agg_pivot", "by_week", "quantile_exact_rank", "quantile_interp",
    "summary_stats", "win_rank", "win_row_number", "win_running_count", "top3_per_group", "sort_multi",
    "topk", "session_batch", "udaf_generic",
    # joins
    "join_inner", "join_broadcast", "join_sort_merge", "join_shuffle_hash", "join_bucketed", "join_salted",
    "join_full", "interval_join_batch", "table_diff",
    # tables and files
    "src_csv_schema", "src_json_class", "snk_parquet", "lake_upsert", "lake_merge_clauses", "lake_version_as_of",
    # streams
    "stream_file_count", "stream_tumbling", "stream_word_count", "stream_dedup", "stream_static_join",
    "stream_interval_inner", "state_user_status",
    # models
    "ml_linreg_hot", "ml_tree", "ml_gbt", "ml_map_in_pandas_score",
]


def timed(action) -> float:
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def published(spark, folder: str) -> dict[str, float]:
    """The few jobs for which the baseline has numbers, on the same row counts where stated."""
    times = {}
    squares = spark.range(10_000_000).withColumn("square", F.col("id") * F.col("id"))
    for label, level in (("cache", StorageLevel.MEMORY_AND_DISK_DESER), ("disk", StorageLevel.DISK_ONLY)):
        with reuse(squares, level) as kept:
            times[f"range_10m_{label}_first"] = timed(kept.count)
            times[f"range_10m_{label}_again"] = timed(kept.count)
    path = f"{folder}/customer.parquet"
    people = (
        spark.read.parquet(path)
        .filter(F.col("c_acctbal") > 800)
        .filter(F.col("c_custkey") > 40)
        .filter(F.col("c_name").startswith("C"))
        .filter(F.col("c_mktsegment").startswith("B"))
    )
    people.count()
    times["four_filters_count"] = timed(people.count)
    times["delay_job_block"] = timed(lambda: delay_block(spark, folder))
    return times


def delay_block(spark, folder: str) -> None:
    """Long lines, their origins, one slow route, six classes three ways: about ten actions."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        F.col("l_quantity").cast("int").alias("delay"), F.col("l_partkey").alias("origin"), F.col("l_suppkey").alias("target")
    )
    with reuse(lines) as kept:
        kept.count()
        far = kept.filter("delay > 30").orderBy(F.col("delay").desc(), "origin")
        far.limit(20).collect()
        far.stat.freqItems(["target"]).collect()
        for origin in (1, 2):
            far.filter(F.col("origin") == origin).count()
        kept.filter("origin = 1 AND target = 1 AND delay >= 12").orderBy(F.col("delay").desc()).collect()
        label = F.when(F.col("delay") > 36, "very long").when(F.col("delay") > 12, "long").otherwise("short")
        classed = kept.withColumn("class", label)
        classed.orderBy("origin", F.col("delay").desc()).limit(20).collect()
        classed.groupBy("class").count().collect()
        kept.createOrReplaceTempView("bench_lines")
        spark.sql("SELECT delay, origin FROM bench_lines ORDER BY origin, delay DESC LIMIT 10").collect()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench", f"local[{cpus}]", cpus, spark__ui__enabled=False, spark__ui__showConsoleProgress=False,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    for name in names:
        job = queries[name]
        consume(job(spark, folder))
        taken = [timed(lambda job=job: consume(job(spark, folder))) for _ in range(runs)]
        times[name] = round(statistics.median(taken), 4)
    baseline = {k: round(v, 4) for k, v in published(spark, folder).items()}
    total = round(sum(times.values()), 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                "published_jobs": baseline, "sf": sf, "cpus": cpus, "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
