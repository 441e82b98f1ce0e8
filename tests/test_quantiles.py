"""Exact quantiles in two scans: against numpy, with small sketches so that ranges leave most rows out."""

import datetime
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from weftline.operators.quantiles import quantiles, two_scan_quantiles

WANTED = {"low": 0.1, "mid": 0.5, "high": 0.75, "all": 1.0, "none": 0.0}


@pytest.fixture(scope="module")
def skewed(spark):
    """A group with most of the rows, one with a value that most of its rows have, null keys and values."""
    r = random.Random(4)
    data = [("hot", r.gauss(0, 9)) for _ in range(30_000)]
    data += [("same", 7.0 if r.random() < 0.9 else r.gauss(7, 1)) for _ in range(4000)]
    data += [(None, float(i)) for i in range(50)] + [("one", 3.5), ("empty", None), ("two", 1.0), ("two", None), ("two", 2.0)]
    return spark.createDataFrame(data, "g STRING, v DOUBLE").repartition(4)


def by_group(df):
    out = {}
    for g, v in df.collect():
        if v is not None:
            out.setdefault(g, []).append(v)
    return out


@pytest.mark.parametrize("k", [200, 16_384])
def test_interpolated_quantiles_equal_numpy(skewed, k):
    known = by_group(skewed)
    found = quantiles(skewed, "v", WANTED, ["g"], True, k).collect()
    assert {r.g for r in found} == set(known)
    for r in found:
        assert [r[n] for n in WANTED] == pytest.approx(list(np.quantile(known[r.g], list(WANTED.values()))))


@pytest.mark.parametrize("k", [200, 16_384])
def test_quantiles_that_are_values(skewed, k):
    known = by_group(skewed)
    for r in quantiles(skewed, "v", WANTED, ["g"], False, k).collect():
        assert [r[n] for n in WANTED] == list(np.quantile(known[r.g], list(WANTED.values()), method="inverted_cdf"))


def test_ranges_leave_most_rows_of_a_hot_group_out(skewed):
    """What is sorted is a small part of the group, and the table is read by two scans."""
    found = quantiles(skewed.filter("g = 'hot'"), "v", {"mid": 0.5}, k=4096)
    found.collect()
    plan = found._jdf.queryExecution().toString()
    assert "Window" in plan and plan.count("kll") == 0
    kept = skewed.filter("g = 'hot'").agg(F.expr("count_if(abs(v) < 9 * 2.6 * 3 * 2.296 / pow(4096, 0.9021))")).first()[0]
    assert kept < 3000


def test_several_columns_times_whole_numbers_and_nan(spark):
    start = datetime.datetime(2024, 1, 1)
    data = [(i, start + datetime.timedelta(seconds=i * i), float("nan") if i % 4 == 0 else float(i)) for i in range(1, 41)]
    df = spark.createDataFrame(data, "a LONG, t TIMESTAMP, x DOUBLE")
    found = two_scan_quantiles(df, {"a": {"q": 0.25, "m": 0.5}, "x": {"m": 0.5, "top": 0.9}}, interpolate=False)
    got = {r.column_name: r for r in found.collect()}
    assert (got["a"].q, got["a"].m, got["a"].top) == (10.0, 20.0, None)
    assert got["x"].q is None and got["x"].m == 26.0 and np.isnan(got["x"].top)
    assert rows(quantiles(df, "t", {"m": 0.5}, interpolate=False)) == [(start + datetime.timedelta(seconds=400),)]
    assert quantiles(df, "a", {"m": 0.5}, interpolate=False).first() == (20,)
    assert rows(quantiles(df.filter("a > 99"), "x", {"m": 0.5})) == [(None,)]
    with pytest.raises(TypeError):
        quantiles(df.withColumn("s", F.lit("x")), "s", {"m": 0.5})
