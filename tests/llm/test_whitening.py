"""Whitened vectors against one eigendecomposition of the whole covariance."""

from __future__ import annotations

import numpy as np
import pytest

from quillspark.llm import whitening as W

SMALL = "/root/testdata/sf0.001"


def expected(vectors, k=W.COMPONENTS):
    """n, deviation, |whitened| and explained by row, for vectors of one length."""
    x = np.floor(256 * np.asarray(vectors, float)).astype("i8")
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviation, (x - sums / n) @ axes / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def check(rows, ids, vectors):
    n, deviation, whitened, explained = expected(vectors)
    by = {}
    for r in rows:
        assert r.n == n and r.identity_error < 1e-8
        by.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(by) == sorted(ids)
    got = np.array([[by[i][c].whitened for c in range(1, whitened.shape[1] + 1)] for i in ids])
    sign = np.sign((got * whitened).sum(0))
    np.testing.assert_allclose(got, whitened * sign, atol=1e-8)
    assert [by[i][1].deviation for i in ids] == deviation
    np.testing.assert_allclose([by[ids[0]][c + 1].explained for c in range(len(explained))], explained, rtol=1e-10)


def test_given_vectors(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    got = W.op12_whitened(spark, SMALL)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_many_summaries(spark):
    """A hundred tasks, three rounds of merging, copies of a third of all rows, and offsets far from zero."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 6)) * [9, 5, 3, 2, 1, 0.5] + 1000
    x[:300] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(100))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        check(got.collect(), list(range(900)), x)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_merging_loses_nothing():
    rng = np.random.default_rng(4)
    x = rng.integers(-500, 500, (257, 9)) + 10**6
    parts = [W.Summary.of(x[a:b]) for a, b in ((0, 1), (1, 3), (3, 100), (100, 101), (101, 257))]
    one, whole = W._merged(parts), W.Summary.of(x)
    assert one.n == 257 and (one.sums == whole.sums).all()
    np.testing.assert_allclose(one.spread, whole.spread, rtol=1e-12)
    np.testing.assert_allclose(np.abs((one.axes * whole.axes).sum(1)), 1)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a"), (2, None, "a"), (3, [1.0, None], "a"), (4, [nan, 1.0], "a"), (5, [inf, 1.0], "a"), (6, [], "a"), (None, [3.0, -1.0], "a"), (1, [1.0, 2.0], "a"), (2**53 + 1, [-0.0, 5.0], None), (8, [7.0], "b"), (9, [1e30] * 3, "c"), (10, [-1e30] * 3, "c")]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert {i: len(x) for i, x in by.items()} == {1: 4, None: 2, 2**53 + 1: 2, 8: 1, 9: 3, 10: 3}
    alone = by[8][0]
    assert (alone.n, alone.deviation, alone.whitened, alone.explained, alone.identity_error) == (1, 0, None, None, None)
    assert [r.whitened is None for r in sorted(by[9], key=lambda r: r.component)] == [False, True, True] and by[9][0].deviation is None
    assert all(r.n == 3 and r.identity_error < 1e-9 for r in by[1])
    _, deviation, _, _ = expected([[1.0, 2.0], [3.0, -1.0], [-0.0, 5.0]])
    assert [by[i][0].deviation for i in (1, None, 2**53 + 1)] == deviation
    assert W.whiten(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("n", [3, 2**40])
def test_deviations_are_exact(n):
    x, sums = np.array([[5, -7], [10**6, 3]]), np.array([11, -13])
    want = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    assert W.deviations(x, n, sums) == [v if v < 1 << 63 else None for v in want]
