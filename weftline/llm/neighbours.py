"""Approximate nearest neighbours with a forest of random-projection trees."""

from __future__ import annotations

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import settle

# The forest: trees, vectors that it is fitted on at most, and vectors of these per leaf.
TREES, SAMPLE, LEAF = 32, 50_000, 32
# Leaves that a query visits, over all trees.
VISITS = 900
SEED = 7


class Tree:
    """A random-projection tree: each node splits at the median along the line between two vectors.

    ``left`` and ``right`` hold nodes, or leaves as negative numbers; ``root`` likewise.
    """

    def __init__(self, vectors: np.ndarray, leaf: int, seed: int):
        self.rng, self.leaf, self.leaves = np.random.default_rng(seed), leaf, 0
        self.normals, self.cuts, self.left, self.right = [], [], [], []
        self.root = self._grow(vectors, np.arange(len(vectors)))

    def _grow(self, vectors: np.ndarray, rows: np.ndarray) -> int:
        if len(rows) > self.leaf:
            for _ in range(4):
                a, b = vectors[self.rng.choice(rows, 2, replace=False)]
                norm = float(np.linalg.norm(a - b))
                side = (a - b) / norm if norm else a
                along = vectors[rows] @ side
                cut = float(np.median(along))
                low = along <= cut
                if norm == 0 or low.all():
                    continue
                node = len(self.cuts)
                for column, value in ((self.normals, side), (self.cuts, cut), (self.left, 0), (self.right, 0)):
                    column.append(value)
                self.left[node] = self._grow(vectors, rows[low])
                self.right[node] = self._grow(vectors, rows[~low])
                return node
        self.leaves += 1
        return -self.leaves

    def parts(self) -> tuple:
        """Root, number of leaves, normals, cuts, left and right, as plain values."""
        normals, cuts = np.array(self.normals, dtype=np.float32), np.array(self.cuts, dtype=np.float32)
        return self.root, self.leaves, normals, cuts, np.array(self.left, np.int64), np.array(self.right, np.int64)


class Forest:
    """Trees, given by their parts, in common arrays; leaves are numbered over all trees."""

    def __init__(self, trees: list[tuple], dims: int):
        nodes = np.cumsum([0, *(len(t[3]) for t in trees)])
        leaves = np.cumsum([0, *(t[1] for t in trees)])

        def moved(values, k):
            values = np.array(values, dtype=np.int64)
            return np.where(values >= 0, values + nodes[k], values - leaves[k])

        self.roots = [int(moved([t[0]], k)[0]) for k, t in enumerate(trees)]
        self.normals = np.concatenate([t[2].reshape(-1, dims) for t in trees])
        self.cuts = np.concatenate([t[3] for t in trees])
        self.left = np.concatenate([moved(t[4], k) for k, t in enumerate(trees)])
        self.right = np.concatenate([moved(t[5], k) for k, t in enumerate(trees)])

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, as positive numbers."""
        out = np.empty((len(vectors), len(self.roots)), dtype=np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(vectors), root)
            todo = np.flatnonzero(node >= 0)
            while len(todo):
                at = node[todo]
                along = np.einsum("ij,ij->i", vectors[todo], self.normals[at])
                node[todo] = np.where(along <= self.cuts[at], self.left[at], self.right[at])
                todo = todo[node[todo] >= 0]
            out[:, t] = -node
        return out

    def visit(self, vector: np.ndarray, visits: int) -> list[int]:
        """Leaves in the order of one queue over all trees: the smallest distance to any plane crossed."""
        along = self.normals @ vector - self.cuts
        queue = [(0.0, k, root) for k, root in enumerate(self.roots)]
        heapq.heapify(queue)
        found, k = [], len(queue)
        while queue and len(found) < visits:
            far, _, node = heapq.heappop(queue)
            while node >= 0:
                margin = float(along[node])
                near, other = (self.left, self.right) if margin <= 0 else (self.right, self.left)
                k += 1
                heapq.heappush(queue, (max(far, abs(margin)), k, int(other[node])))
                node = int(near[node])
            found.append(-node)
        return found


def _clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors of doubles that are neither null nor zero and hold only finite numbers."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy()
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    visits: int = VISITS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest candidates by Euclidean distance.

    The forest is fitted on at most ``sample`` vectors, chosen by a hash of their ids; every vector is
    placed in a leaf of every tree. A query walks all trees with one shared queue and visits ``visits``
    leaves; the vectors there are measured exactly on the original numbers. For larger tables raise
    ``sample`` in proportion, so that leaves stay small.

    Equal vectors are indexed once, with their k + 1 smallest ids: more cannot be among k nearest, as ties
    go to the smaller id, and no leaf grows with the number of copies. Queries and candidates with the
    same id are the same row and not compared. Null ids, and vectors that are null, zero, of another
    length than most, or hold null or non-finite numbers take no part. Repeated rows count once.
    """
    clean = _clean(vectors, id_col, vector_col).withColumn("code", F.xxhash64("v"))
    asked = _clean(queries, id_col, vector_col).distinct()
    widths = clean.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], schema)
    dims = widths["n"]
    clean, asked = clean.filter(F.size("v") == dims), asked.filter(F.size("v") == dims)

    # The smallest ids of equal vectors, first per slice of the ids, then over all.
    ids = F.slice(F.array_sort(F.collect_set("vec_id")), 1, k + 1)
    sliced = clean.select("code", "v", "vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(1024)).alias("slice"))
    few = sliced.groupBy("code", "v", "slice").agg(ids.alias("ids"))
    few = few.groupBy("code", "v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
    distinct = settle(few.select("v", "ids", F.xxhash64("v", F.lit(SEED)).alias("draw")), "vectors")
    total = distinct.count()
    drawn = distinct.filter(F.pmod("draw", F.lit(1 << 30)) < min(1.0, 1.2 * sample / max(total, 1)) * (1 << 30))
    picked = drawn.orderBy("draw").limit(sample).select("v").toArrow()
    fitted = spark.sparkContext.broadcast(np.concatenate([_matrix(c) for c in picked.column(0).chunks]).astype(np.float32))

    def grow(batches):
        for batch in batches:
            for seed in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Tree(fitted.value, leaf, SEED + seed).parts())])], names=["tree"])

    grown = spark.range(0, trees, 1, trees).mapInArrow(grow, "tree binary").collect()  # bounded by the sample
    shared = spark.sparkContext.broadcast([pickle.loads(r["tree"]) for r in grown])

    def place(batches):
        forest = Forest(shared.value, dims)
        for batch in batches:
            at = forest.place(_matrix(batch.column(0)).astype(np.float32))
            offsets = pa.array(np.arange(len(at) + 1) * at.shape[1], type=pa.int32())
            leaves = pa.ListArray.from_arrays(offsets, pa.array(at.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaves], names=["v", "ids", "leaves"])

    def walk(batches):
        forest = Forest(shared.value, dims)
        for batch in batches:
            found = [forest.visit(v, visits) for v in _matrix(batch.column(0)).astype(np.float32)]
            leaves = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaves], names=["v", "code", "leaves"])

    # Equal queries walk and search once. In each leaf the indexed vectors come first, then its queries.
    sought = asked.select("v", F.xxhash64("v").alias("code")).distinct()
    placed = distinct.select("v", "ids").mapInArrow(place, "v array<double>, ids array<long>, leaves array<long>")
    walked = sought.mapInArrow(walk, "v array<double>, code long, leaves array<long>")
    rows = placed.select(F.explode("leaves").alias("leaf"), F.lit(None).cast("long").alias("code"), "ids", "v").unionByName(
        walked.select(F.explode("leaves").alias("leaf"), "code", F.lit(None).cast("array<long>").alias("ids"), "v")
    )
    dealt = rows.repartition("leaf").sortWithinPartitions(F.col("leaf"), F.col("code").asc_nulls_first())
    near = dealt.mapInArrow(lambda batches: _measure(batches, k + 1), "code long, ids array<long>, score double")

    # The best per query, first per slice of the candidates; copies from several leaves are one.
    near = near.select("code", "score", F.explode("ids").alias("vec_id"))
    near = near.withColumn("slice", F.pmod(F.xxhash64("vec_id"), F.lit(16)))
    top = F.slice(F.array_sort(F.collect_set(F.struct("score", "vec_id"))), 1, k + 1)
    near = near.groupBy("code", "slice").agg(top.alias("top"))
    near = near.groupBy("code").agg(F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k + 1).alias("top"))
    answers = asked.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("code")).join(near, "code")
    others = F.filter("top", lambda x: x["vec_id"] != F.col("query_id"))
    ranked = answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "x"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), "x.vec_id", "x.score")


def _measure(batches, k: int):
    """The ``k`` nearest indexed vectors of each leaf to each of its queries, by exact distance.

    Rows come sorted by leaf, indexed vectors before queries, so one leaf's vectors are held at a time.
    """
    leaf, held, ids, matrix = None, [], [], None
    for batch in batches:
        leaves, vectors = batch.column(0).to_numpy(), _matrix(batch.column(3))
        is_query = ~np.array(batch.column(1).is_null())
        codes, names = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        cuts = np.flatnonzero((leaves[1:] != leaves[:-1]) | (is_query[1:] != is_query[:-1])) + 1
        out: list[tuple] = []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(leaves)], strict=True):
            if leaves[a] != leaf:
                leaf, held, ids, matrix = leaves[a], [], [], None
            if not is_query[a]:
                held.append(vectors[a:b])
                ids += names[a:b]
                matrix = None
                continue
            if not held:
                continue
            matrix = np.concatenate(held) if matrix is None else matrix
            for q in range(a, b):
                far = np.sqrt(((matrix - vectors[q]) ** 2).sum(axis=1))
                # Ties at the last place are all passed on: ids decide later.
                last = np.partition(far, k - 1)[k - 1] if len(far) > k else np.inf
                out += [(codes[q], ids[i], float(far[i])) for i in np.flatnonzero(far <= last)]
        cols = list(zip(*out, strict=True)) or [()] * 3
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(cols, kinds, strict=True)], names=["code", "ids", "score"]
        )
