import numpy as np
import pytest
from llm.odd import FOLDER

from weftline.llm import queries, whitening

KIND = "vec_id long, embedding array<double>, n string, x string, deviation string"


def table(spark, rows):
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], "n", "x", "d") for i, v in rows], KIND)


def plain(rows, k=whitening.COMPONENTS):
    """n, deviations, whitened rows up to sign, shares, by the definition in whole numbers and dense linear algebra."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    far = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    y = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return n, far, y @ axes / np.sqrt(values), values / np.square(y).mean(axis=0).sum()


def check(spark, rows, got, k=whitening.COMPONENTS):
    n, far, scaled, shares = plain(rows, k)
    by_id = {r.vec_id: r for r in got}
    assert len(by_id) == n
    for (i, _), want, deviation in zip(rows, scaled, far):
        r = by_id[i]
        assert (r.n, r.deviation) == (n, deviation)
        assert np.allclose(np.abs(r.whitened), np.abs(want), rtol=1e-6, atol=1e-6)
        assert np.allclose(r.explained, shares, rtol=1e-8)
        assert r.identity_error < 1e-9


def test_query_of_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    n, far, scaled, shares = plain(rows)
    got = queries.op13_whitening(spark, FOLDER)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = {(r.vec_id, r.component): r for r in got.collect()}
    assert set(found) == {(i, c) for i, _ in rows for c in range(1, 33)}
    signs = {}
    for (i, _), want, deviation in zip(rows, scaled, far):
        for c in range(1, 33):
            r = found[i, c]
            assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
            assert r.explained == pytest.approx(shares[c - 1], rel=1e-8)
            assert abs(r.whitened) == pytest.approx(abs(want[c - 1]), rel=1e-5, abs=1e-6)
            if abs(want[c - 1]) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(r.whitened * want[c - 1]))
    assert all(len(s) == 1 for s in signs.values())


def test_left_out_rows_and_ties(spark):
    rng = np.random.default_rng(2)
    good = [(i, (rng.standard_normal(5) * [9, 5, 3, 1, 0.4]).tolist()) for i in range(80)]
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5)]
    bad += [(105, [1.0, 2.0]), (106, [1e300] * 5)]
    check(spark, good, whitening.whiten(table(spark, good + bad).repartition(3)).collect())
    again = [(1, good[0][1])] * 30 + [(None, good[1][1]), (None, good[2][1])] + good
    assert whitening.whiten(table(spark, again)).count() == len(again)
    assert whitening.whiten(table(spark, bad[:3])).count() == 0
    assert whitening.by_component(whitening.whiten(table(spark, []))).count() == 0


def test_missing_and_equal_directions(spark):
    """Rank below the number of dimensions, equal eigenvalues, and no variance at all."""
    rows = [(0, [1.0, 0, 0, 0]), (1, [-1.0, 0, 0, 0]), (2, [0, 1.0, 0, 0]), (3, [0, -1.0, 0, 0])]
    got = whitening.whiten(table(spark, rows)).collect()
    for r in got:
        assert len(r.whitened) == 2 and r.explained == pytest.approx([0.5, 0.5]) and r.identity_error < 1e-12
        assert np.square(r.whitened).sum() == pytest.approx(2.0)
    flat = whitening.whiten(table(spark, [(i, [3.0, 4.0]) for i in range(6)]))
    assert [(r.deviation, r.whitened) for r in flat.collect()] == [(0, [])] * 6
    assert whitening.by_component(flat).count() == 0


def test_deviation_beyond_a_long(spark):
    rows = [(0, [2.0**44, 0.0]), (1, [0.0, 2.0**44]), (2, [1.0, 1.0])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(table(spark, rows)).collect()}
    assert got == {0: None, 1: None, 2: None}


def test_close_eigenvalues_settle(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(12) * np.linspace(3, 2.9, 12)).tolist()) for i in range(300)]
    check(spark, rows, whitening.whiten(table(spark, rows), 4).collect(), 4)
