"""Cases that once gave wrong or incomplete results."""

import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from weftline.functions.columns import split_field, words
from weftline.operators import lake
from weftline.operators.joins import full_join, range_join
from weftline.operators.ranking import top_values
from weftline.plans import all_queries
from weftline.session import scratch
from weftline.sources.readers import read_csv
from weftline.sources.writers import write_csv
from weftline.streaming.progress import progress_table
from weftline.streaming.run import finish, run, run_all, start


@pytest.mark.parametrize("multiline", [False, True])
def test_csv_round_trip(spark, multiline):
    texts = ['a "b", c', "", None, "back\\slash", '"', "x,y", " spaced ", "\\"] + (["two\nlines"] if multiline else [])
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    path = write_csv(df, scratch(spark, "csv"))
    assert rows(read_csv(spark, path, "n int, t string", multiline=multiline)) == rows(df)


def test_a_time_means_whole_versions(spark):
    at = lambda h: datetime.datetime(2024, 1, 1, h)
    log = [(1, 0, at(8), "put", "a"), (2, 0, at(8), "put", "b"), (1, 1, at(10), "overwrite", "c"), (3, 1, at(12), "overwrite", "d")]
    df = spark.createDataFrame(log, "k int, version long, commit_ts timestamp_ntz, op string, x string")
    read = lambda h: rows(lake.snapshot(df, ["k"], as_of=F.lit(at(h)).cast("timestamp_ntz")))
    assert read(11) == [(1, "a"), (2, "b")] and read(12) == [(1, "c"), (3, "d")] and read(7) == []
    both = lake.history(spark.createDataFrame([(0, at(8), "put"), (0, at(8), "delete")], "version long, commit_ts timestamp_ntz, op string"), 5).first()
    assert (both.operation, both.entries, both.puts, both.deletes) == ("delete+put", 2, 1, 1)


def test_null_keys_are_inserted(spark):
    schema = "k int, x string"
    target = spark.createDataFrame([(1, "old"), (None, "kept")], schema)
    source = spark.createDataFrame([(1, "new"), (None, "p"), (None, "q")], schema)
    expected = rows(spark.createDataFrame([(1, "new"), (None, "kept"), (None, "p"), (None, "q")], schema))
    assert rows(lake.upsert(target, source, ["k"])) == expected
    assert rows(lake.merge(target, source, ["k"], [lake.Clause("update"), lake.Clause("insert")])) == expected


def test_bucket_of_null_is_null(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    gap = events.withColumn("value", F.when(F.col("event_id") % 2 == 0, F.col("value")))
    gap.write.parquet(str(tmp_path / "events.parquet"))
    found = all_queries()["udf_bucket"](spark, str(tmp_path))
    assert found.filter("delay is null").count() > 0
    assert found.filter("(delay is null) <> (delay_class is null)").count() == 0


def test_open_ended_ranges(spark):
    points = spark.createDataFrame([(float(i),) for i in (-5, 0, 3, 99, 1000)], "p double")
    inf = float("inf")
    bands = spark.createDataFrame([(0.0, 10.0, "low"), (10.0, inf, "high"), (-inf, 0.0, "below"), (-inf, inf, "all")], "a double, b double, n string")
    got = rows(range_join(points, bands, "p", "a", "b", 5.0).select("p", "n"))
    assert got == sorted(((p, n) for p in (-5.0, 0.0, 3.0, 99.0, 1000.0) for a, b, n in ((0, 10, "low"), (10, inf, "high"), (-inf, 0, "below"), (-inf, inf, "all")) if a <= p < b), key=repr)


def test_full_join_of_sides_with_the_same_names(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, x string")
    right = spark.createDataFrame([(2, "B"), (3, "C"), (None, "D")], "k int, x string")
    got = sorted((tuple(r) for r in full_join(left, right, "k", "k").collect()), key=repr)
    assert got == sorted([(1, "a", None, None), (2, "b", 2, "B"), (None, "c", None, None), (None, None, 3, "C"), (None, None, None, "D")], key=repr)


def test_delimiters_are_plain_text(spark):
    df = spark.createDataFrame([("ab|7||", "a.b..")], "x string, y string")
    r = df.select(split_field(F.col("x"), "|", 2, "int").alias("n"), words(F.col("x"), "|").alias("w"), words(F.col("y"), ".").alias("v")).first()
    assert (r.n, r.w, r.v) == (7, ["ab", "7"], ["a", "b"])


def test_top_values_shuffle_once(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 5, 4, 3, 2)] + [(None, 1)], "g string, v int")
    best = top_values(df, ["g"], "v", 3)
    assert rows(best) == sorted([("a", 5, 1), ("a", 5, 1), ("a", 4, 2), ("a", 3, 3), (None, 1, 1)], key=repr)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_every_progress_report_is_kept(spark):
    path = scratch(spark, "many")
    spark.range(110).repartition(110).write.option("maxRecordsPerFile", 1).parquet(path)
    files = spark.read.parquet(path).inputFiles()
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    result = run(stream)
    table = progress_table(spark, result.progress).filter("input_rows > 0")
    assert table.count() == len(files) > 100 and table.agg(F.sum("input_rows")).first()[0] == 110


def test_a_timeout_is_an_error(spark):
    query = start(spark.readStream.format("rate").load(), "append", scratch(spark, "r"), scratch(spark, "c"), every="1 second")
    with pytest.raises(TimeoutError):
        finish(query, 2)
    assert not query.isActive


def test_the_first_failure_ends_all(spark):
    path = scratch(spark, "in")
    spark.range(40).repartition(40).write.parquet(path)
    good = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    bad = spark.readStream.schema("id long").parquet(path).select(F.raise_error(F.lit("wrong on purpose")).alias("x"))
    with pytest.raises(Exception, match="wrong on purpose"):
        run_all([("slow", good, "append"), ("bad", bad, "append")])
    assert not any(q.name == "slow" for q in spark.streams.active)
