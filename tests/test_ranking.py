"""Chunked ranking against plain windows and numpy, on groups that are hot and full of ties."""

import random

import numpy as np
import pytest
from conftest import rows

from weftline.operators.ranking import cumulative, exact_quantiles, top_values, with_ranks
from weftline.operators.sessions import sessions


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, half of those on one value; NULL groups and values."""
    r = random.Random(5)
    data = []
    for i in range(600):
        group = "hot" if i % 3 == 0 else r.choice(["a", "b", "c", None])
        value = 7.0 if group == "hot" and r.random() < 0.5 else r.choice([None, *map(float, range(40))])
        data.append((i, group, value))
    return spark.createDataFrame(data, "id INT, g STRING, v DOUBLE").repartition(5).cache()


@pytest.mark.parametrize("whole_rows", [0, 150])
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_equal_plain_windows(skewed, descending, whole_rows):
    wanted = dict(rank="r", dense_rank="d", running_count="c", row_number="n", tie_break="id")
    chunked = with_ranks(skewed, ["g"], "v", descending, **wanted, whole_rows=whole_rows, rows_per_chunk=20)
    plain = with_ranks(skewed, ["g"], "v", descending, **wanted)
    assert chunked.dtypes == plain.dtypes
    assert rows(chunked) == rows(plain)


def test_ranks_without_groups(skewed):
    chunked = with_ranks(skewed, [], "v", rank="r", row_number="n", tie_break="id", whole_rows=0, rows_per_chunk=50)
    plain = with_ranks(skewed, [], "v", rank="r", row_number="n", tie_break="id")
    assert rows(chunked) == rows(plain)


def test_ranks_by_time(spark):
    df = spark.range(200).selectExpr(
        "id", "id % 2 AS g", "timestamp_seconds(id div 3) AS ts", "cast(timestamp_seconds(id div 3) AS timestamp_ntz) AS tn"
    )
    for column in ("ts", "tn"):
        chunked = with_ranks(df, ["g"], column, running_count="c", whole_rows=0, rows_per_chunk=10)
        assert rows(chunked) == rows(with_ranks(df, ["g"], column, running_count="c"))


def test_row_number_needs_a_tie_break(skewed):
    with pytest.raises(ValueError, match="tie_break"):
        with_ranks(skewed, ["g"], "v", row_number="n")


def test_text_cannot_be_cut(skewed):
    with pytest.raises(TypeError, match="numeric or a time"):
        cumulative(skewed, ["id"], "g", rows_per_chunk=10)


@pytest.mark.parametrize("whole_rows, rows_per_chunk", [(0, 15), (0, 10_000), (1000, 15)])
def test_quantiles_equal_numpy(skewed, whole_rows, rows_per_chunk):
    wanted = {"low": 0.1, "mid": 0.5, "high": 0.75, "top": 1.0}
    found = exact_quantiles(skewed, "v", wanted, ["g"], True, whole_rows, rows_per_chunk)
    by_group = {}
    for _, g, v in skewed.collect():
        if v is not None:
            by_group.setdefault(g, []).append(v)
    assert found.count() == len(by_group)
    for row in found.collect():
        expected = np.quantile(by_group[row["g"]], list(wanted.values()))
        assert [row[n] for n in wanted] == pytest.approx(list(expected))


@pytest.mark.parametrize("whole_rows", [0, 100])
def test_quantile_of_one_to_ten(spark, whole_rows):
    df = spark.range(1, 11)
    cut = dict(whole_rows=whole_rows, rows_per_chunk=3)
    assert exact_quantiles(df, "id", {"q": 0.75}, **cut).first()["q"] == 7.75
    found = exact_quantiles(df, "id", {"a": 0.25, "b": 0.75, "c": 0.0}, interpolate=False, **cut)
    assert tuple(found.first()) == (3, 8, 1)


def test_top_values_keep_ties(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("a", 1), ("b", 2)], "g STRING, v INT")
    assert rows(top_values(df, ["g"], "v", 2)) == [("a", 3, 2), ("a", 5, 1), ("a", 5, 1), ("b", 2, 1)]


def test_sessions_end_at_the_gap(spark):
    seconds = [0, 9, 18, 28, 50, 51]
    df = spark.createDataFrame([("u", s) for s in seconds], "k STRING, s INT").selectExpr(
        "k", "timestamp_seconds(s) AS ts"
    )
    found = sessions(df, "k", "ts", 10).selectExpr("unix_seconds(session_start)", "unix_seconds(session_end)", "n")
    # 18 and 28 are exactly one gap apart, which does not end the session.
    assert rows(found) == [(0, 38, 4), (50, 61, 2)]


def test_sessions_equal_session_window(spark):
    from pyspark.sql import functions as F

    r = random.Random(2)
    data = [("hot" if r.random() < 0.4 else f"u{r.randrange(5)}", r.randrange(3000)) for _ in range(400)]
    df = spark.createDataFrame(data, "k STRING, s INT").selectExpr("k", "timestamp_seconds(s) AS ts")
    plain = df.groupBy("k", F.session_window("ts", "10 seconds")).count()
    plain = plain.select("k", "session_window.start", "session_window.end", "count")
    assert rows(sessions(df, "k", "ts", 10)) == rows(plain)


@pytest.mark.parametrize("chunk_cells", [1, 3, 50])
def test_sessions_are_stitched_over_chunks(spark, chunk_cells):
    """A key with a third of the rows over ten years, null keys, and sessions over many chunks."""
    from pyspark.sql import functions as F

    r = random.Random(6)
    data = [("hot", r.randrange(10 * 365 * 24)) for _ in range(1000)]
    data += [("long", h) for h in range(1000, 1400)] + [("long", 2000), ("long", 2002)]
    data += [(r.choice([None, "a", "b"]), r.randrange(900)) for _ in range(300)]
    df = spark.createDataFrame(data, "k STRING, h INT").selectExpr("k", "timestamp_seconds(h * 3600) AS ts", "h")
    plain = df.groupBy("k", F.session_window("ts", "7201 seconds")).agg(F.count("*").alias("n"), F.sum("h").alias("s"))
    # The built-in window is open at its end, so two hours are within 7201 seconds.
    plain = plain.select("k", "session_window.start", "n", "s")
    found = sessions(df, "k", "ts", 7200, [("s", F.col("h"))], chunk_cells)
    assert rows(found, "k", "session_start", "n", "s") == rows(plain)
    longest = found.filter("k = 'long'").agg(F.max("n")).first()[0]
    assert longest == 400
