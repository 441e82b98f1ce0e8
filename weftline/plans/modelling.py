"""Feature preparation and regression."""

from __future__ import annotations

import itertools

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from weftline.functions.columns import hash_split
from weftline.functions.partitions import score_linear
from weftline.operators import features as P
from weftline.operators import models as M
from weftline.operators.foreign import export_trees, score_trees
from weftline.plans.registry import query
from weftline.session import reuse, scratch, spread
from weftline.streaming.run import run
from weftline.streaming.sources import table_stream

TEXT, NUMERIC, LABEL = ["p_brand", "p_type"], ["p_size", "p_partkey"], "p_retailprice"


def parts(t):
    return t.part.select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")


def split_parts(t):
    return hash_split(parts(t), "p_partkey", 80)


def spread_parts(t):
    """The same split, dealt over all cores: a search reads its rows many times, and they come from a small file."""
    return hash_split(spread(parts(t)), "p_partkey", 80)


_SPLIT = "CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"

# ---- preparation ----

_RATED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def rated(t):
    scores = t.labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
    return t.documents.select("doc_id", "n_chars").join(scores, "doc_id", "left")


@query(
    "ml_na_flags",
    f"""SELECT d.doc_id, CAST(CASE WHEN quality IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS quality_na,
        CAST(CASE WHEN n_chars IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS n_chars_na FROM {_RATED}""",
)
def ml_na_flags(t):
    return P.missing_flags(rated(t), ["quality", "n_chars"]).select("doc_id", "quality_na", "n_chars_na")


_GAPPY = """(SELECT p_partkey, CAST(CASE WHEN p_type <> 'PROMO' THEN p_size END AS DOUBLE) AS size FROM part)"""


def gappy_sizes(t):
    size = F.when(F.col("p_type") != "PROMO", F.col("p_size")).cast("double")
    return t.part.select("p_partkey", size.alias("size"))


@query(
    "ml_impute_median",
    f"SELECT p_partkey, coalesce(size, (SELECT quantile_disc(size, 0.5) FROM {_GAPPY})) AS size FROM {_GAPPY}",
)
def ml_impute_median(t):
    return P.impute_median(gappy_sizes(t), ["size"], exact=True)


@query(
    "ml_impute_median_approx",
    f"SELECT p_partkey, size IS NULL AS filled, true AS as_bounded FROM {_GAPPY}",
)
def ml_impute_median_approx(t):
    """The place of the imputed value among the known ones is within 0.001 of the middle, the bound of MLlib."""
    gappy = gappy_sizes(t)
    filled = P.impute_median(gappy, ["size"]).withColumnRenamed("size", "imputed").join(gappy, "p_partkey")
    value = filled.filter(F.col("size").isNull()).agg(F.max("imputed").alias("m")).scalar()
    known = gappy.filter(F.col("size").isNotNull()).withColumn("m", value)
    low, high = F.avg((F.col("size") < F.col("m")).cast("int")), F.avg((F.col("size") <= F.col("m")).cast("int"))
    near = known.agg(((low <= 0.501) & (high >= 0.499)).alias("near")).scalar()
    kept = F.col("imputed") == F.col("size")
    return filled.select(
        "p_partkey", F.col("size").isNull().alias("filled"), F.coalesce(kept, near).alias("as_bounded")
    )


_TYPE_INDEX = "(SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS i FROM part GROUP BY p_type)"


@query(
    "ml_split_by_type",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{kind}' AS kind, count({c}) AS n, count(DISTINCT {c}) AS n_values FROM part"
        for c, kind in [("p_name", "text"), ("p_brand", "text"), ("p_type", "text"), ("p_size", "numeric"), ("p_retailprice", "numeric")]
    ),
)
def ml_split_by_type(t):
    """Columns by the kind of preparation they need, with what decides on it: values and different ones."""
    text, numeric = P.split_by_type(t.part, leave_out=["p_partkey"])
    kinds = {**{c: "text" for c in text}, **{c: "numeric" for c in numeric}}
    found = t.part.agg(*[F.struct(F.count(c).alias("n"), F.count_distinct(c).alias("n_values")).alias(c) for c in kinds])
    each = [F.struct(F.lit(c).alias("column_name"), F.lit(k).alias("kind"), f"{c}.n", f"{c}.n_values") for c, k in kinds.items()]
    return found.select(F.explode(F.array(*each)).alias("x")).select("x.*")


@query(
    "ml_string_index",
    f"SELECT p_partkey, CAST(i AS DOUBLE) AS p_type_index FROM part JOIN {_TYPE_INDEX} USING (p_type)",
)
def ml_string_index(t):
    indexed = P.indexer(["p_type"]).fit(t.part).transform(t.part)
    return indexed.select("p_partkey", "p_type_index")


@query(
    "ml_one_hot",
    f"""SELECT p_partkey, (SELECT string_agg(CASE WHEN k = i THEN '1' ELSE '0' END, '' ORDER BY k)
        FROM range((SELECT count(DISTINCT p_type) - 1 FROM part)) r(k)) AS hot
    FROM part JOIN {_TYPE_INDEX} USING (p_type)""",
)
def ml_one_hot(t):
    indexed = P.indexer(["p_type"]).fit(t.part).transform(t.part)
    hot = P.one_hot(["p_type"]).fit(indexed).transform(indexed)
    digits = F.transform(vector_to_array("p_type_hot"), lambda v: v.cast("int").cast("string"))
    return hot.select("p_partkey", F.array_join(digits, "").alias("hot"))


@query(
    "ml_assemble",
    "SELECT p_partkey, CAST(p_size AS DOUBLE) AS first, p_retailprice AS second, CAST(2 AS INTEGER) AS width FROM part",
)
def ml_assemble(t):
    vector = vector_to_array("features")
    rows = P.assembler(["p_size", "p_retailprice"]).transform(t.part)
    return rows.select("p_partkey", vector[0].alias("first"), vector[1].alias("second"), F.size(vector).alias("width"))


@query(
    "ml_rformula",
    f"""SELECT p_partkey, p_retailprice AS label, CAST(p_size AS DOUBLE) AS size_feature,
        CAST((SELECT count(DISTINCT p_type) FROM part) AS INTEGER) AS width,
        CAST(CASE WHEN i = 0 THEN 1 ELSE 0 END AS DOUBLE) AS most_common FROM part JOIN {_TYPE_INDEX} USING (p_type)""",
)
def ml_rformula(t):
    model = P.formula("p_retailprice ~ p_size + p_type").fit(t.part)
    vector = vector_to_array("features")
    return model.transform(t.part).select(
        "p_partkey",
        "label",
        vector[0].alias("size_feature"),
        F.size(vector).alias("width"),
        vector[1].alias("most_common"),
    )


# ---- models ----


@query(
    "ml_baseline_rmse",
    f"""SELECT round(m, 4) AS prediction, round(sqrt(avg((p_retailprice - m) * (p_retailprice - m))), 4) AS rmse
    FROM part, (SELECT avg(p_retailprice) AS m FROM part WHERE {_SPLIT} < 80) WHERE {_SPLIT} >= 80 GROUP BY m""",
)
def ml_baseline_rmse(t):
    out = M.mean_baseline(*split_parts(t), LABEL)
    return out.select(F.round("prediction", 4).alias("prediction"), F.round("rmse", 4).alias("rmse"))


_REGRESSION = """SELECT '(intercept)' AS term, round(regr_intercept({y}, p_partkey), 4) AS weight FROM part
    UNION ALL SELECT 'p_partkey', round(regr_slope({y}, p_partkey), {digits}) FROM part"""


def _fitted(t, df, label, digits):
    model = M.linear_pipeline([], ["p_partkey"], label, reg_param=0.0).fit(df)
    table = M.coefficients(model, ["p_partkey"], t.spark)
    rounded = F.when(F.col("term") == "(intercept)", F.round("weight", 4)).otherwise(F.round("weight", digits))
    return table.select("term", rounded.alias("weight"))


@query("ml_linreg", _REGRESSION.format(y="p_retailprice", digits=8))
def ml_linreg(t):
    return _fitted(t, parts(t), LABEL, 8)


@query("ml_log_linreg", _REGRESSION.format(y="ln(p_retailprice)", digits=10))
def ml_log_linreg(t):
    return _fitted(t, M.with_log_label(parts(t), LABEL, "log_price"), "log_price", 10)


_HELD_OUT = f"SELECT count(*) AS test_rows, true AS beats_mean FROM part WHERE {_SPLIT} >= 80"


def _held_out(model, train, test, log_label=False):
    """Rows of the test part, and whether the model's RMSE there is below that of the training mean.

    Predictions of a log label are raised to prices first.
    """
    scored = model.transform(test)
    if log_label:
        scored = scored.withColumn("prediction", F.exp("prediction"))
    mean = M.mean_baseline(train, test, LABEL).select("rmse").scalar()
    error = M.rmse(F.col(LABEL), F.col("prediction"))
    return scored.agg(F.count(F.lit(1)).alias("test_rows"), (error < mean).alias("beats_mean"))


def _log_parts(t):
    return tuple(M.with_log_label(df, LABEL, "log_price") for df in split_parts(t))


@query("ml_linreg_hot", _HELD_OUT)
def ml_linreg_hot(t):
    train, test = split_parts(t)
    return _held_out(M.linear_pipeline(TEXT, NUMERIC, LABEL).fit(train), train, test)


@query("ml_log_linreg_hot", _HELD_OUT)
def ml_log_linreg_hot(t):
    train, test = _log_parts(t)
    return _held_out(M.linear_pipeline(TEXT, NUMERIC, "log_price").fit(train), train, test, log_label=True)


@query("ml_tree", _HELD_OUT)
def ml_tree(t):
    train, test = split_parts(t)
    return _held_out(M.tree_pipeline(train, TEXT, NUMERIC, LABEL, "tree", maxDepth=5).fit(train), train, test)


@query(
    "ml_importances",
    """SELECT 'p_brand,p_partkey,p_size,p_type' AS features, CAST(1 AS DOUBLE) AS total, true AS in_range""",
)
def ml_importances(t):
    train, _ = split_parts(t)
    model = M.tree_pipeline(train, TEXT, NUMERIC, LABEL, "tree", maxDepth=5).fit(train)
    table = M.importances(model, [*TEXT, *NUMERIC], t.spark)
    return table.agg(
        F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.every(F.col("importance").between(0, 1)).alias("in_range"),
    )


# Searched parameters, fixed values.
FOREST_GRID = {"maxDepth": [2, 4, 6], "numTrees": [10, 100]}
BOOSTED_GRID = {"maxDepth": [4, 6, 8], "maxIter": [10, 30, 60], "stepSize": [0.3, 0.6]}
FOLDS = 3


@query("ml_rf_cv", _HELD_OUT)
def ml_rf_cv(t):
    train, test = spread_parts(t)
    pipeline = M.tree_pipeline(train, TEXT, NUMERIC, LABEL, "forest")
    with reuse(train) as kept:
        model = M.cross_validate(pipeline, kept, LABEL, FOREST_GRID, FOLDS, whole_pipeline=False)
    return _held_out(model, train, test)


def _grid_sql(grid):
    """The texts of all grid points, each with a finite positive error, as VALUES."""
    names = sorted(grid)
    points = [", ".join(f"{n}={v}" for n, v in zip(names, p)) for p in itertools.product(*(grid[n] for n in names))]
    return f"SELECT params, true AS has_error FROM (VALUES {', '.join(f"('{p}')" for p in points)}) v(params)"


def _searched(model, spark):
    table = M.cv_table(model, spark)
    sound = (F.col("avg_rmse") > 0) & (F.col("avg_rmse") < float("inf"))
    return table.select("params", sound.alias("has_error"))


@query("ml_cv_metrics", _grid_sql(FOREST_GRID))
def ml_cv_metrics(t):
    train, _ = spread_parts(t)
    pipeline = M.tree_pipeline(train, TEXT, NUMERIC, LABEL, "forest")
    with reuse(train) as kept:
        model = M.cross_validate(pipeline, kept, LABEL, FOREST_GRID, FOLDS)
    return _searched(model, t.spark)


@query("ml_gbt", _HELD_OUT)
def ml_gbt(t):
    train, test = _log_parts(t)
    pipeline = M.tree_pipeline(train, TEXT, NUMERIC, "log_price", "boosted", maxIter=10, stepSize=0.3, maxDepth=6)
    return _held_out(pipeline.fit(train), train, test, log_label=True)


@query("ml_gbt_cv", _grid_sql(BOOSTED_GRID))
def ml_gbt_cv(t):
    train = M.with_log_label(spread_parts(t)[0], LABEL, "log_price")
    pipeline = M.tree_pipeline(train, TEXT, NUMERIC, "log_price", "boosted")
    with reuse(train) as kept:
        model = M.cross_validate(pipeline, kept, "log_price", BOOSTED_GRID, FOLDS, parallelism=8)
    return _searched(model, t.spark)


@query(
    "ml_metrics",
    """SELECT round(sqrt(avg((p_retailprice - p) * (p_retailprice - p))), 4) AS rmse,
        round(1 - sum((p_retailprice - p) * (p_retailprice - p)) / sum((p_retailprice - m) * (p_retailprice - m)), 4) AS r2
    FROM (SELECT p_retailprice, 900 + p_size AS p, (SELECT avg(p_retailprice) FROM part) AS m FROM part)""",
)
def ml_metrics(t):
    predicted = parts(t).withColumn("prediction", (F.lit(900) + F.col("p_size")).cast("double"))
    out = M.r_squared(predicted, LABEL, "prediction")
    return out.select(F.round("rmse", 4).alias("rmse"), F.round("r2", 4).alias("r2"))


def saved_model(t):
    """A linear model fitted on all parts, saved and loaded again."""
    path = scratch(t.spark, "model")
    M.save(M.linear_pipeline([], ["p_partkey"], LABEL, reg_param=0.0).fit(parts(t)), path)
    return M.load(path)


_FIT = "(SELECT regr_slope(p_retailprice, p_partkey) AS a, regr_intercept(p_retailprice, p_partkey) AS b FROM part)"
_SCORES = f"SELECT p_partkey, round(a * p_partkey + b, 4) AS prediction FROM part, {_FIT}"


@query("ml_save_load", _SCORES)
def ml_save_load(t):
    return saved_model(t).transform(parts(t)).select("p_partkey", F.round("prediction", 4).alias("prediction"))


@query("ml_stream_score", _SCORES)
def ml_stream_score(t):
    scored = saved_model(t).transform(table_stream(t.spark, t.path("part")))
    return run(scored.select("p_partkey", F.round("prediction", 4).alias("prediction"))).rows()


@query(
    "ml_map_in_pandas_score",
    "SELECT p_partkey, round(0.5 * p_size + 0.25 * p_retailprice + 3, 6) AS prediction FROM part",
)
def ml_map_in_pandas_score(t):
    inputs = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    scored = score_linear(inputs, ["p_size", "p_retailprice"], [0.5, 0.25], 3.0, "prediction")
    return scored.select("p_partkey", F.round("prediction", 6).alias("prediction"))


@query("ml_foreign_trees", "SELECT p_partkey, true AS equal FROM part")
def ml_foreign_trees(t):
    """Boosted trees as plain arrays, scored without MLlib: whether each prediction equals the library's own."""
    train, _ = _log_parts(t)
    pipeline = M.tree_pipeline(train, TEXT, NUMERIC, "log_price", "boosted", maxIter=5, maxDepth=5)
    *prepared, model = pipeline.fit(train).stages
    saved, file = scratch(t.spark, "boosted"), scratch(t.spark, "arrays")
    model.write().save(saved)
    export_trees(t.spark, saved, file)
    rows = parts(t)
    for stage in prepared:
        rows = stage.transform(rows)
    inputs = [*[f"{c}_index" for c in TEXT], *NUMERIC]
    theirs = model.transform(rows).select(*dict.fromkeys(["p_partkey", *inputs]), F.col("prediction").alias("known"))
    scored = score_trees(theirs, file, inputs)
    return scored.select("p_partkey", (F.abs(F.col("prediction") - F.col("known")) < 1e-9).alias("equal"))
