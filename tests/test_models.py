"""Feature preparation, models, Python aggregates and per-partition work."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.partitions import filter_opaque, map_partitions, score_linear
from weftline.functions.udaf import Aggregator, aggregate
from weftline.operators import features as P
from weftline.operators import models as M
from weftline.session import scratch


@pytest.fixture(scope="module")
def listings(spark):
    r = random.Random(6)
    data = []
    for _ in range(400):
        kind, beds = r.choice(["flat", "house", "room"]), r.randrange(1, 6)
        price = 40.0 * beds + {"flat": 50, "house": 90, "room": 0}[kind] + r.uniform(-2, 2)
        data.append((kind, beds, price))
    return spark.createDataFrame(data, "kind STRING, beds INT, price DOUBLE").cache()


def test_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 5.0), (4, 9.0)], "id INT, x DOUBLE")
    assert rows(P.missing_flags(df, ["x"]), "id", "x_na") == [(1, 0.0), (2, 1.0), (3, 0.0), (4, 0.0)]
    for exact in (True, False):
        assert P.impute_median(df, ["x"], exact).filter("id = 2").first()["x"] == 5.0


def test_columns_by_type(listings):
    assert P.split_by_type(listings, leave_out=["price"]) == (["kind"], ["beds"])


def test_indexer_skips_unseen_values(spark, listings):
    model = P.indexer(["kind"]).fit(listings)
    other = spark.createDataFrame([("flat",), ("tent",), (None,)], "kind STRING")
    assert model.transform(other).count() == 1


def test_linear_regression_recovers_the_prices(spark, listings):
    model = M.linear_pipeline(["kind"], ["beds"], "price").fit(listings)
    found = M.r_squared(model.transform(listings), "price", "prediction").first()
    assert found["rmse"] < 1.5 and found["r2"] > 0.99
    predictions = model.transform(listings)
    assert found["rmse"] == pytest.approx(M.evaluate(predictions, "price", "rmse"))
    assert found["r2"] == pytest.approx(M.evaluate(predictions, "price", "r2"))
    weights = M.coefficients(M.linear_pipeline([], ["beds"], "price").fit(listings), ["beds"], spark)
    assert weights.filter("term = 'beds'").first()["weight"] == pytest.approx(40, abs=8)


def test_trees_take_a_text_column_with_many_values(spark):
    df = spark.range(240).selectExpr("concat('k', id % 60) AS kind", "CAST(id % 60 AS DOUBLE) AS price")
    model = M.tree_pipeline(df, ["kind"], [], "price", maxDepth=2).fit(df)
    assert M.tree_bins(df, ["kind"]) == 60
    assert model.transform(df).count() == 240


def test_log_label(listings):
    logged = M.with_log_label(listings, "price", "log_price")
    model = M.linear_pipeline(["kind"], ["beds"], "log_price").fit(logged)
    scored = model.transform(logged).withColumn("prediction", F.exp("prediction"))
    assert M.r_squared(scored, "price", "prediction").first()["r2"] > 0.85


def test_mean_baseline(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "y DOUBLE")
    found = M.mean_baseline(train, spark.createDataFrame([(2.0,), (4.0,)], "y DOUBLE"), "y").first()
    assert tuple(found) == (2.0, pytest.approx(math.sqrt(2)))


def test_trees_and_importances(spark, listings):
    for kind, params in (("tree", {}), ("forest", {"numTrees": 5}), ("boosted", {"maxIter": 5})):
        model = M.tree_pipeline(listings, ["kind"], ["beds"], "price", kind, maxDepth=4, **params).fit(listings)
        assert M.r_squared(model.transform(listings), "price", "prediction").first()["r2"] > 0.9
    table = M.importances(model, ["kind", "beds"], spark).collect()
    assert table[0]["feature"] == "beds" and sum(r["importance"] for r in table) == pytest.approx(1)


def test_depth_is_honoured(listings):
    flat = M.tree_pipeline(listings, ["kind"], ["beds"], "price", "tree", maxDepth=1).fit(listings)
    assert flat.stages[-1].depth == 1


@pytest.mark.parametrize("whole", [True, False])
def test_grid_search(spark, listings, whole):
    pipeline = M.tree_pipeline(listings, ["kind"], ["beds"], "price", "tree")
    model = M.cross_validate(pipeline, listings, "price", {"maxDepth": [1, 4]}, folds=2, whole_pipeline=whole)
    table = M.cv_table(model if whole else model.stages[-1], spark).collect()
    assert [r["params"] for r in table] == ["maxDepth=4", "maxDepth=1"]


@pytest.fixture(scope="module")
def sizes(spark):
    r = random.Random(7)
    data = [(r.choice("abc"), r.randrange(9), r.randrange(5), r.uniform(0, 9)) for _ in range(1500)]
    return spark.createDataFrame([(k, a, b, y + a * b + 9 * (k == "b")) for k, a, b, y in data], "kind STRING, a INT, b INT, y DOUBLE").cache()


def test_search_of_boosted_trees_fits_each_depth_once_on_bins(spark, sizes, monkeypatch):
    """Errors are those of plain fits on all rows; points that differ in iterations alone share a fit per fold."""
    fits, plain = [], M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, df, *a: fits.append(df.count()) or plain(self, df, *a))
    pipeline = M.tree_pipeline(sizes, ["kind"], ["a", "b"], "y", "boosted", stepSize=0.5)
    grid = {"maxDepth": [3], "maxIter": [1, 4]}
    model = M.cross_validate(pipeline, sizes, "y", grid, folds=2)
    assert len(fits) == 3 and max(fits) <= 3 * 9 * 5
    for point, found in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True):
        folds = model_folds(pipeline, sizes, point)
        assert found == pytest.approx(sum(folds) / 2, rel=1e-6)
    best = dict(zip(map(str, model.getEstimatorParamMaps()), model.avgMetrics))
    assert len(best) == 2 and model.bestModel.transform(sizes).count() == 1500


def model_folds(pipeline, df, point):
    draw = df.withColumn("draw", F.rand(42))
    for fold in (draw.draw < 0.5, draw.draw >= 0.5):
        model = pipeline.fit(draw.filter(~fold), point)
        yield M.evaluate(model.transform(draw.filter(fold)), "y", "rmse")


def test_search_prepares_each_fold_once(spark, listings, monkeypatch):
    fits, plain = [], P.StringIndexer.fit
    monkeypatch.setattr(P.StringIndexer, "fit", lambda self, df, *a: fits.append(1) or plain(self, df, *a))
    pipeline = M.tree_pipeline(listings, ["kind"], ["beds"], "price", "forest")
    model = M.cross_validate(pipeline, listings, "price", {"maxDepth": [1, 4], "numTrees": [2, 3]}, folds=2)
    assert len(fits) == 3 and len(model.avgMetrics) == 4


def test_search_still_refuses_a_missing_label(spark, listings):
    gap = listings.union(listings.limit(1).select("kind", "beds", F.lit(None).cast("double")))
    pipeline = M.tree_pipeline(gap, ["kind"], ["beds"], "price", "boosted", maxIter=1)
    with pytest.raises(Exception, match="(?i)null|label"):
        M.cross_validate(pipeline, gap, "price", {"maxDepth": [1]}, folds=2)


def test_saved_model_scores_the_same(spark, listings):
    model = M.linear_pipeline(["kind"], ["beds"], "price").fit(listings)
    path = scratch(spark, "model")
    M.save(model, path)
    assert rows(M.load(path).transform(listings), "prediction") == rows(model.transform(listings), "prediction")


# ---- Python in tasks ----


def spread():
    """Largest minus smallest value; a local class travels to the workers by value."""

    class Spread(Aggregator):
        output_type = T.DoubleType()

        def zero(self):
            return math.inf, -math.inf

        def reduce(self, buffer, rows):
            return self.merge(buffer, (rows["v"].min(), rows["v"].max()))

        def merge(self, left, right):
            return min(left[0], right[0]), max(left[1], right[1])

        def finish(self, buffer):
            return float(buffer[1] - buffer[0])

    return Spread()


@pytest.mark.parametrize("fan_in", [1, 3, 64])
def test_user_aggregate(spark, fan_in):
    data = [("hot" if i % 3 == 0 else f"k{i % 5}", i % 2, float(i)) for i in range(300)]
    df = spark.createDataFrame(data, "k STRING, p INT, v DOUBLE").repartition(6)
    found = aggregate(df, ["k", "p"], ["v"], spread(), "spread", fan_in)
    plain = df.groupBy("k", "p").agg((F.max("v") - F.min("v")).alias("spread"))
    assert rows(found) == rows(plain)


def test_user_aggregate_of_many_keys_and_a_hot_one(spark):
    """Tasks that hold few buffers send them on early; a hot key then has hundreds of them."""
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, -1, id % 4000) AS k", "cast(id AS double) AS v").repartition(5)
    found = aggregate(df, ["k"], ["v"], spread(), "spread", 4, most_keys=50)
    plain = df.groupBy("k").agg((F.max("v") - F.min("v")).alias("spread"))
    assert rows(found) == rows(plain)
    assert aggregate(df.limit(0), ["k"], ["v"], spread(), "spread").count() == 0


def test_user_aggregate_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 4.0), ("a", 2.0)], "k STRING, v DOUBLE")
    assert rows(aggregate(df, ["k"], ["v"], spread(), "spread")) == [("a", 0.0), (None, 3.0)]


def test_one_resource_per_partition(spark):
    opened, closed = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def connect():
        opened.add(1)
        return math.sqrt

    def use(root, batch):
        return pd.DataFrame({"root": [root(v) for v in batch["id"]]})

    out = map_partitions(spark.range(0, 1000, 1, 4), connect, use, "root double", lambda _: closed.add(1))
    assert out.agg(F.sum("root")).first()[0] == pytest.approx(np.sqrt(np.arange(1000)).sum())
    assert opened.value == closed.value == 4


def test_opaque_filter_and_numpy_model(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2.0)
    assert filter_opaque(df, ["id", "x"], lambda i, x: i + x > 20).count() == 3
    scored = score_linear(df, ["id", "x"], [1.0, 0.5], 3.0, "y")
    assert rows(scored, "y") == sorted([(2.0 * i + 3,) for i in range(10)], key=repr)


@pytest.mark.parametrize("kind, params", [("tree", {}), ("forest", {"numTrees": 7, "maxDepth": 6}), ("boosted", {"maxIter": 6, "maxDepth": 4})])
def test_exported_trees_predict_as_the_library(spark, kind, params):
    """Continuous and categorical splits, nulls, extra columns, and rows of no category seen in training."""
    from pyspark.sql import functions as F

    from weftline.operators.foreign import Trees, export_trees, score_trees
    from weftline.operators.models import tree_pipeline
    from weftline.session import scratch

    df = spark.range(600).selectExpr(
        "id", "concat('c', id * 7 % 23) AS kind", "cast(id * 37 % 101 AS double) AS size", "cast(sin(id) * 10 + id * 7 % 23 * (id % 3) AS double) AS y"
    )
    *prepared, model = tree_pipeline(df, ["kind"], ["size"], "y", kind, **params).fit(df).stages
    saved, file = scratch(spark, "trees"), scratch(spark, "arrays")
    model.write().save(saved)
    export_trees(spark, saved, file)
    trees = Trees(bytes(spark.read.parquet(file).first().model))
    assert trees.categorical.any() and (~trees.categorical & (trees.feature >= 0)).any()
    for stage in prepared:
        df = stage.transform(df)
    known = model.transform(df).select("id", "kind_index", "size", F.col("prediction").alias("known")).repartition(3)
    scored = score_trees(known, file, ["kind_index", "size"]).collect()
    assert len(scored) == 600 and all(abs(r.prediction - r.known) < 1e-9 for r in scored)
    missing = known.limit(2).withColumn("size", F.lit(None).cast("double"))
    assert [r.prediction for r in score_trees(missing, file, ["kind_index", "size"]).collect()] == [None, None]
