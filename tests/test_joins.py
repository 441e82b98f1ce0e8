"""Joins against brute force, with hot keys, and the physical plans they get."""

import random
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from weftline.operators import joins, sets
from weftline.session import scratch
from weftline.sources.writers import write_bucketed
from weftline.streaming.run import settings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows carry key 1; some keys have no partner, some rows no key."""
    r = random.Random(3)
    data = [(i, 1 if i % 3 == 0 else r.choice([None, *range(2, 30)])) for i in range(300)]
    return spark.createDataFrame(data, "id INT, k INT")


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(k, f"n{k}") for k in range(0, 20)], "dk INT, name STRING")


def on(fact, dim):
    return fact.k == dim.dk


def test_strategies(fact, dim):
    assert "BroadcastHashJoin" in plan(joins.broadcast_join(fact, dim, on(fact, dim)))
    assert "SortMergeJoin" in plan(joins.merge_join(fact, dim, on(fact, dim)))
    assert "ShuffledHashJoin" in plan(joins.hash_join(fact, dim, on(fact, dim)))


def test_broadcast_needs_a_small_side(spark, fact, dim):
    assert joins.has_at_most(dim, 20) and not joins.has_at_most(dim, 19)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert "Broadcast" not in plan(joins.broadcast_join(fact, dim, on(fact, dim), max_rows=19))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_salted_join_equals_plain(fact, dim):
    hot = joins.hot_keys(fact, "k", 0.1)
    assert hot == [1]
    for how in ("inner", "left"):
        plain = fact.join(dim, on(fact, dim), how)
        salted = joins.salted_join(fact, dim, "k", "dk", ["id"], hot, how, salts=5)
        assert rows(salted) == rows(plain)


def test_hot_key_is_spread(fact, dim):
    left, right = joins.salt_pair(fact, dim, "k", "dk", ["id"], [1], salts=8)
    assert left.filter("k = 1").select("salt").distinct().count() == 8
    assert left.filter("k <> 1").select("salt").distinct().count() == 1
    assert right.count() == dim.count() + 7


def test_full_join_equals_plain(fact, dim):
    assert rows(joins.full_join(fact, dim, "k", "dk")) == rows(fact.join(dim, on(fact, dim), "full"))


def test_semi_and_anti(fact, dim):
    semi, anti = joins.semi_join(dim, fact, "dk", "k"), joins.anti_join(dim, fact, "dk", "k")
    assert rows(semi) == rows(dim.join(fact, on(fact, dim), "left_semi"))
    assert rows(anti) == rows(dim.join(fact, on(fact, dim), "left_anti"))


def test_pair_join_keeps_both_sides(fact, dim):
    pairs = joins.pair_join(fact, dim, on(fact, dim), ("f", "d"))
    assert pairs.columns == ["f", "d"]
    assert rows(pairs.select("f.*", "d.*")) == rows(fact.join(dim, on(fact, dim)))


def test_range_join_equals_brute_force(spark):
    r = random.Random(9)
    points = [(i, r.uniform(-50, 50)) for i in range(120)]
    # Lengths from below one cell to several thousand, and some empty ranges.
    lengths = [-2.0, 0.0, 0.01, 5.0, 25.0, 7.0, 224.0, 300.0, 9000.0, 60000.0]
    ranges = [(j, lo, lo + lengths[j % 10]) for j, lo in enumerate(r.uniform(-60, 50) for _ in range(40))]
    ranges += [(j + 40, lo - n / 2, hi) for (j, lo, hi), n in zip(ranges, lengths * 4)]
    p = spark.createDataFrame(points, "i INT, x DOUBLE")
    q = spark.createDataFrame(ranges, "j INT, lo DOUBLE, hi DOUBLE")
    expected = sorted((i, j) for i, x in points for j, lo, hi in ranges if lo <= x < hi)
    for width in (7.0, 0.5, 1e6):
        found = joins.range_join(p, q, "x", "lo", "hi", width)
        assert sorted(tuple(t) for t in found.select("i", "j").collect()) == expected


def test_long_ranges_cover_few_cells(spark):
    q = spark.createDataFrame([(0.0, 1e9)], "lo DOUBLE, hi DOUBLE")
    p = spark.createDataFrame([(5e8,)], "x DOUBLE")
    found = joins.range_join(p, q, "x", "lo", "hi", 1.0)
    assert found.count() == 1


def interval_rows(spark, seed=4):
    r = random.Random(seed)
    left = [(i, "hot" if i % 3 == 0 else r.choice("abc"), r.randrange(-500, 4000)) for i in range(150)]
    right = [(j, "hot" if j % 3 == 0 else r.choice("abd"), r.randrange(-500, 4000)) for j in range(150)]
    a = spark.createDataFrame(left, "i INT, a STRING, s INT").selectExpr("i", "a", "timestamp_seconds(s) AS ta")
    b = spark.createDataFrame(right, "j INT, b STRING, s INT").selectExpr("j", "b", "timestamp_seconds(s) AS tb")
    return left, right, a, b


@pytest.mark.parametrize("seconds", [1, 60, 900])
def test_interval_join_equals_brute_force(spark, seconds):
    left, right, a, b = interval_rows(spark)
    pairs = [(i, j) for i, k, s in left for j, m, u in right if k == m and s <= u <= s + seconds]
    inner = joins.interval_join(a, b, "a", "b", "ta", "tb", seconds).select("i", "j")
    assert sorted(tuple(t) for t in inner.collect()) == sorted(pairs)
    outer = joins.interval_join(a, b, "a", "b", "ta", "tb", seconds, "left").select("i", "j")
    matched = {i for i, _ in pairs}
    expected = pairs + [(i, None) for i, _, _ in left if i not in matched]
    assert sorted((tuple(t) for t in outer.collect()), key=repr) == sorted(expected, key=repr)


def test_broadcast_is_bounded_by_bytes(spark):
    wide = spark.range(20).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 1000).alias("text"), F.array("id").alias("ids"))
    size = wide.agg(F.sum(joins.row_bytes(wide))).first()[0]
    assert 20 * 1024 <= size <= 20 * 1100
    assert joins.fits(wide, max_bytes=size) and not joins.fits(wide, max_bytes=size - 1)
    assert joins.fits(wide.limit(0)) and not joins.fits(wide, max_rows=19)
    assert joins.fits(wide.select(F.lit(None).cast("string").alias("n")))


def test_full_join_of_a_hot_key_is_split(spark):
    """AQE splits the hot partition of the left join that a full join is built from."""
    hot = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.repeat(F.lit("x"), 50).alias("pad")
    )
    other = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("dk"), F.lit("y").alias("name"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    with settings(spark, conf):
        joined = joins.full_join(hot, other, "k", "dk")
        assert joined.count() == 60_000 + 20_000
        found = joined.filter("k IS NOT NULL")
        found.collect()
        assert "skew=true" in plan(found)


def test_cells_spread_a_hot_key(spark):
    _, _, a, b = interval_rows(spark)
    text = plan(joins.interval_join(a, b, "a", "b", "ta", "tb", 60))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    # The equi-join has two keys: the user and the time cell.
    keys = [line for line in text.splitlines() if "Join [" in line][0]
    assert "__lcell" in keys and "__rcell" in keys


def test_equal_buckets_need_no_shuffle(spark, fact, dim):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        mark = uuid.uuid4().hex[:8]
        f = write_bucketed(fact, f"f_{mark}", scratch(spark, "b"), 4, ["k"])
        d4 = write_bucketed(dim, f"d4_{mark}", scratch(spark, "b"), 4, ["dk"])
        d6 = write_bucketed(dim, f"d6_{mark}", scratch(spark, "b"), 6, ["dk"])
        f, d4, d6 = spark.table(f), spark.table(d4), spark.table(d6)
        assert "Exchange" not in plan(f.join(d4, on(f, d4)))
        assert "Exchange" in plan(f.join(d6, on(f, d6)))
        assert rows(f.join(d4, on(f, d4))) == rows(fact.join(dim, on(fact, dim)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_slices_equal_union_of_filters(spark):
    df = spark.range(0, 400, 20)
    slices = [("low", F.col("id") <= 60), ("middle", F.col("id").between(60, 120)), ("none", F.col("id") == 0)]
    union = sets.union_all([df.filter(c).withColumn("label", F.lit(n)) for n, c in slices])
    found = sets.labelled_slices(df, slices, "label")
    assert rows(found) == rows(union)
    # The edges overlap: 0 and 60 appear twice.
    assert found.filter("id = 60").count() == 2 and found.filter("id = 0").count() == 2


def test_table_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x INT")
    b = spark.createDataFrame([(1,), (2,), (3,)], "x INT")
    assert rows(sets.table_difference(a, b)) == [(1, "left"), (3, "right")]


def test_scaled_copy(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", None)], "n STRING, v DOUBLE")
    assert rows(sets.with_scaled_copy(df, "v", 0.5)) == [("a", 10.0), ("a", 5.0), ("b", None), ("b", None)]
