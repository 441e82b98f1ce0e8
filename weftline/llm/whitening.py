"""Whitening of vectors by a Golub-Kahan-Lanczos bidiagonalisation of the centred rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import settle

COMPONENTS = 32
# Entries beyond this have no exact place on the grid of whole numbers.
_WIDEST = 2.0**52
# Relative size below which a vector counts as zero, and error at which a singular value has settled.
_TINY, _SETTLED = 1e-12, 1e-14
# Rows that are worked on at once in a task.
_ROWS = 4096


def on_grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): vectors as whole numbers, ``floor(64 c) + 1000000`` of each entry ``c``.

    Rows go whose vector is null or empty, holds a null or non-finite entry or one too large for an exact
    whole number (2^46 or more), or has another length than most vectors (of equally frequent lengths the larger
    counts). Rows with null or repeated ids stay, each a row of its own.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * 64) < _WIDEST))
    x = F.transform("v", lambda c: F.floor(c * 64) + F.lit(1_000_000).cast("long"))
    rows = settle(rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & good).select("vec_id", x.alias("x")), "grid")
    usual = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return rows.filter(F.size("x") == (usual.dims if usual else 0))


def _blocks_of(dims: int, whole: np.ndarray, rest: np.ndarray):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Row batches of bounded size, each with its centred matrix."""
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                x = part.column(part.schema.get_field_index("x")).flatten().to_numpy()
                yield part, (x.reshape(-1, dims) - whole) - rest

    return blocks


class Centred:
    """The rows of ``on_grid`` less their mean, as a matrix that only tasks hold, block by block.

    The mean is split into a whole number and a rest below one, so that centring loses no digits.
    """

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self.n = rows.count()
        sums = rows.select(F.posexplode("x").alias("j", "c")).groupBy("j").agg(F.sum("c").alias("s")).collect()
        self.sums = [r.s for r in sorted(sums, key=lambda r: r.j)]
        self.dims = len(self.sums)
        self.whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        self.rest = np.array([(s % self.n) / self.n for s in self.sums])
        self.blocks = _blocks_of(self.dims, self.whole, self.rest)

    def total(self, of_block, size: int) -> np.ndarray:
        """The sum over all blocks of a function of the block that has ``size`` values."""
        blocks = self.blocks

        def task(batches):
            held = np.zeros(size)
            for _, block in blocks(batches):
                held += of_block(block)
            yield pa.RecordBatch.from_pydict({"k": np.arange(size, dtype=np.int32), "v": held})

        parts = self.rows.select("x").mapInArrow(task, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
        out = np.zeros(size)
        for r in parts.collect():
            out[r.k] = r.v
        return out


def bidiagonalise(a: Centred, components: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of the centred rows, falling, and their right vectors as columns.

    Golub-Kahan-Lanczos: ``alpha u = X v - beta u'`` and ``beta v = X^T u - alpha v`` in turns, each new vector made
    orthogonal to all earlier ones of its side. A left vector has an entry per row and is never gathered: it is
    held as the ``p`` with ``u = X p``, and its entries are computed in the tasks. One pass over the rows gives
    ``X p``, its products with all earlier left vectors, and ``X^T X p``. Ends when all wanted values
    have settled, after as many steps as there are dimensions at most. A zero ``beta`` or ``alpha`` (equal or
    missing directions) restarts from a random vector orthogonal to all found.
    """
    d, rng = a.dims, np.random.default_rng(seed)
    right, left, pulled = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    alphas, betas, scale = [], [], 0.0

    def fresh() -> np.ndarray:
        v = rng.standard_normal(d)
        for _ in range(3):
            v -= right @ (right.T @ v)
            v /= np.linalg.norm(v)
        return v

    v, beta = fresh(), 0.0
    while True:
        right = np.column_stack([right, v])
        p = v - beta * left[:, -1] if beta else v
        for attempt in range(3):
            stack = np.column_stack([left, p])

            def products(block: np.ndarray) -> np.ndarray:
                along = block @ stack
                return np.concatenate([along.T @ along[:, -1], block.T @ along[:, -1]])

            got = a.total(products, stack.shape[1] + d)
            overlap, square, z = got[: stack.shape[1] - 1], got[stack.shape[1] - 1], got[stack.shape[1] :]
            share = float(np.linalg.norm(overlap)) / np.sqrt(square) if square > 0 else 0.0
            p, z = p - left @ overlap, z - pulled @ overlap
            square -= float(overlap @ overlap)
            if share < 1e-8:
                break
        alpha = float(np.sqrt(max(square, 0.0)))
        scale = max(scale, alpha)
        if alpha > _TINY * scale:
            alphas.append(alpha)
            left, pulled = np.column_stack([left, p / alpha]), np.column_stack([pulled, z / alpha])
            v = pulled[:, -1] - alpha * v
        else:
            alphas.append(0.0)
            left, pulled = np.column_stack([left, np.zeros(d)]), np.column_stack([pulled, np.zeros(d)])
            v = np.zeros(d)
        for _ in range(2):
            v = v - right @ (right.T @ v)
        beta = float(np.linalg.norm(v))
        lone = beta <= _TINY * scale
        steps = len(alphas)
        outer, values, inner = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        wanted = min(components, d)
        if steps == d or (
            not lone and steps >= wanted and (beta * np.abs(outer[-1, :wanted]) <= _SETTLED * values[0]).all()
        ):
            return values[:wanted], right @ inner.T[:, :wanted]
        betas.append(0.0 if lone else beta)
        v, beta = (fresh(), 0.0) if lone else (v / beta, beta)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Every vector on its principal components, each scaled to variance one.

    Returns (vec_id, n, deviation, whitened, explained, identity_error), a row per row of ``on_grid``: ``whitened``
    and ``explained`` are arrays by component, largest variance first; ``deviation`` is the exact sum over
    dimensions of ``(n x - S)^2``, null where it exceeds a long; ``identity_error`` is the largest absolute entry of
    the covariance of ``whitened`` less the identity, measured in a further pass. Components without variance
    are left out, as nothing scales them to one: equal vectors have empty arrays. No rows give no rows.
    """
    schema = (
        f"vec_id {vectors.schema[id_col].dataType.simpleString()}, n long, deviation long, "
        "whitened array<double>, explained array<double>, identity_error double"
    )
    rows = on_grid(vectors, id_col, vector_col)
    if rows.isEmpty():
        return vectors.sparkSession.createDataFrame([], schema)
    a = Centred(rows)
    n, dims, sums, blocks = a.n, a.dims, a.sums, a.blocks
    values, axes = bidiagonalise(a, components)
    there = values > _TINY * max(values[0], 1e-300) * 10
    values, axes = values[there], axes[:, there]
    k = len(values)
    trace, spread = a.total(lambda block: np.array([np.square(block).sum()]), 1)[0], np.sqrt(n) / values
    explained = np.square(values) / trace if k else np.zeros(0)

    def squares(block: np.ndarray) -> np.ndarray:
        scaled = (block @ axes) * spread
        return (scaled.T @ scaled).ravel()

    error = float(np.abs(a.total(squares, k * k).reshape(k, k) / n - np.eye(k)).max()) if k else 0.0

    def deviations(x: np.ndarray) -> list:
        far = x.astype(object) * n - np.array(sums, dtype=object)
        whole = [int(v) for v in (far * far).sum(axis=1)]
        return [v if v < 1 << 63 else None for v in whole]

    def exact(part: pa.RecordBatch) -> list | np.ndarray:
        x = part.column(part.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, dims)
        near = [int(np.abs(x[:, j] - sums[j] // n).max()) + 1 for j in range(dims)]
        if sum((m * n) ** 2 for m in near) < 1 << 62 and int(x.max()) * n < 1 << 62:
            return np.square(x * n - np.array(sums, dtype=np.int64)).sum(axis=1)
        return deviations(x)

    def task(batches):
        for part, block in blocks(batches):
            m = part.num_rows
            ends = pa.array(np.arange(m + 1, dtype=np.int32) * k)
            lists = [((block @ axes) * spread).ravel(), np.tile(explained, m)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index("vec_id")),
                    pa.array(np.full(m, n, dtype=np.int64)),
                    pa.array(exact(part), type=pa.int64()),
                    *(pa.ListArray.from_arrays(ends, pa.array(v, type=pa.float64())) for v in lists),
                    pa.array(np.full(m, error)),
                ],
                names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(task, schema)


def by_component(whitened: DataFrame) -> DataFrame:
    """A row per row and component of ``whiten``, components numbered from 1."""
    pairs: Column = F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "pair")
    return whitened.select("vec_id", "n", "deviation", "identity_error", pairs).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )
