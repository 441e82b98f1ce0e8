"""Tree ensembles as plain arrays: exported from a saved model, kept in a file, applied to Arrow batches."""

from __future__ import annotations

import io
import json
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest exported model, in bytes, that is sent to every executor.
MOST_BYTES = 256 << 20


def export_trees(spark: SparkSession, model_path: str, path: str) -> None:
    """Write a saved MLlib tree, forest or boosted regression as arrays, to a file that needs no MLlib to be read.

    Nodes of all trees lie in common arrays: feature (-1 for a leaf), threshold, children, value, and for
    categorical splits a range of ``categories`` that go left. Trees are weighted as the model weights them.
    """
    told = json.loads(spark.read.text(f"{model_path}/metadata").first()[0])
    nodes = spark.read.parquet(f"{model_path}/data")
    if "treeID" in nodes.columns:
        nodes = nodes.select("treeID", "nodeData.*")
        found = spark.read.parquet(f"{model_path}/treesMetadata").collect()
        weights = np.array([r[2] for r in sorted(found, key=lambda r: r[0])])
    else:
        nodes, weights = nodes.withColumn("treeID", F.lit(0)), np.ones(1)
    if "RandomForest" in told["class"]:
        weights = weights / len(weights)
    rows = nodes.select("treeID", "id", "prediction", "leftChild", "rightChild", "split").orderBy("treeID", "id").collect()
    first = np.searchsorted([r.treeID for r in rows], np.arange(len(weights)))
    splits = [r.split for r in rows]
    listed = [s.leftCategoriesOrThreshold if s.numCategories >= 0 else [] for s in splits]
    arrays = {
        "roots": first,
        "weights": weights,
        "feature": np.array([s.featureIndex for s in splits]),
        "threshold": np.array([s.leftCategoriesOrThreshold[0] if s.featureIndex >= 0 and s.numCategories < 0 else 0.0 for s in splits]),
        "left": np.array([first[r.treeID] + r.leftChild for r in rows]),
        "right": np.array([first[r.treeID] + r.rightChild for r in rows]),
        "value": np.array([r.prediction for r in rows]),
        "categorical": np.array([s.numCategories >= 0 for s in splits]),
        "bounds": np.concatenate([[0], np.cumsum([len(x) for x in listed])]),
        "categories": np.array([c for x in listed for c in sorted(x)]),
    }
    file = io.BytesIO()
    np.savez_compressed(file, **arrays)
    spark.createDataFrame([(bytearray(file.getvalue()),)], "model binary").coalesce(1).write.parquet(path)


class Trees:
    """An ensemble read from the bytes of its file."""

    def __init__(self, file: bytes):
        for name, values in np.load(io.BytesIO(file)).items():
            setattr(self, name, values)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Weighted sum over trees; all rows walk down a tree together, level by level."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for root, weight in zip(self.roots, self.weights):
            at = np.full(len(rows), root)
            todo = every[self.feature[at] >= 0]
            while len(todo):
                node = at[todo]
                x = rows[todo, self.feature[node]]
                goes_left = x <= self.threshold[node]
                for split in np.unique(node[self.categorical[node]]):
                    here = node == split
                    goes_left[here] = np.isin(x[here], self.categories[self.bounds[split] : self.bounds[split + 1]])
                at[todo] = np.where(goes_left, self.left[node], self.right[node])
                todo = todo[self.feature[at[todo]] >= 0]
            total += weight * self.value[at]
        return total


def score_trees(df: DataFrame, path: str, features: Sequence[str], into: str = "prediction") -> DataFrame:
    """``df`` with the prediction of an exported ensemble; its file is loaded once per task.

    ``features`` are numeric columns in the order of training; a row with a null among them gets null.
    """
    spark = df.sparkSession
    file = bytes(spark.read.parquet(path).first().model)
    if len(file) > MOST_BYTES:
        raise ValueError(f"the model has {len(file)} bytes, more than {MOST_BYTES}")
    sent = spark.sparkContext.broadcast(file)
    names = [f"__f{k}" for k in range(len(features))]
    given = df.select("*", *[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)])
    kept = df.columns

    def task(batches):
        trees = Trees(sent.value)
        for batch in batches:
            columns = [batch.column(len(kept) + k) for k in range(len(names))]
            known = np.ones(batch.num_rows, dtype=bool)
            for c in columns:
                known &= c.is_valid().to_numpy(zero_copy_only=False)
            rows = np.stack([c.fill_null(0.0).to_numpy() for c in columns], axis=1)
            found = pa.array(trees.predict(rows), mask=~known)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], found], names=[*kept, into])

    return given.mapInArrow(task, T.StructType([*df.schema.fields, T.StructField(into, T.DoubleType())]))
