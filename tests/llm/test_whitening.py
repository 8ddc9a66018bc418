import math

import numpy as np
import pytest

from courtline.llm import whitening
from courtline.llm.queries import registry

SCHEMA = "vec_id long, embedding array<float>, label int"
SMALL = "/root/testdata/sf0.001"


def frame(spark, vectors, ids=None, clash=True, schema=SCHEMA):
    rows = [(i, v, 0) for i, v in zip(ids or range(len(vectors)), vectors)]
    df = spark.createDataFrame(rows, schema)
    if clash:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit(c) for c in ("i", "j", "s", "w", "n", "d", "count", "at", "component", "whitened")})
    return df


def whole(v):
    return [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]


def check(rows, kept, components=8):
    """``rows`` against exact integers and numpy's eigenvectors over ``kept`` (id -> vector)."""
    x = np.array([whole(v) for v in kept.values()], dtype=object)
    n, d = x.shape
    s = x.sum(axis=0)
    off = n * x - s
    cov = np.array([[int((off[:, i] * off[:, j]).sum()) / n ** 3 for j in range(d)] for i in range(d)])
    values = np.linalg.eigvalsh(cov)[::-1]
    k = min(components, int((values > max(0, 1e-12 * values[0])).sum()))
    assert len(rows) == k * n
    by = {(r.vec_id, r.component): r for r in rows}
    assert set(by) == {(i, c) for i in kept for c in range(1, k + 1)}
    square = dict(zip(kept, (off * off).sum(axis=1)))
    for (i, c), r in by.items():
        assert r.n == n and r.deviation == (square[i] if square[i] < 2 ** 63 else None)
        assert abs(r.explained / (values[c - 1] / np.trace(cov)) - 1) < 1e-8
    centred = (x - s / n).astype(float)
    w = np.array([[by[i, c].whitened for c in range(1, k + 1)] for i in kept])
    error = np.abs((w - w.mean(axis=0)).T @ (w - w.mean(axis=0)) / n - np.eye(k)).max()
    assert error < 1e-6 and all(abs(r.identity_error - error) < 1e-9 for r in rows)
    for c in range(k):  # whitened is a multiple of the projection on an eigenvector of cov
        axis = np.linalg.lstsq(centred, w[:, c] * math.sqrt(values[c]), rcond=None)[0]
        assert np.abs(centred @ axis - w[:, c] * math.sqrt(values[c])).max() < 1e-6
        if k == d or d <= 64 and n > d:
            assert abs(np.linalg.norm(axis) - 1) < 1e-6
            assert np.abs(cov @ axis - values[c] * axis).max() < 1e-6 * values[0]


def random_vectors(n, d, seed=0):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d))
    return [[float(c) for c in v] for v in (rng.normal(size=(n, d)) @ mix * 0.3).astype(np.float32)]


def test_blocks_are_exact():
    rng = np.random.default_rng(1)
    for rows, d, low, high in ((1, 3, 0, 5), (64, 4, -9, 9), (130, 5, 99_000, 101_000), (70, 3, -2 ** 61, 2 ** 61),
                               (65, 2, 7, 8)):
        x = rng.integers(low, high, size=(rows, d))
        sums, products = whitening.scatter(x)
        big = x.astype(object)
        assert (sums == big.sum(axis=0)).all() and (products == big.T @ big).all()


@pytest.mark.parametrize("n,d", [(300, 6), (40, 20), (2, 3)])
def test_equals_numpy(spark, n, d):
    vectors = random_vectors(n, d)
    rows = whitening.whiten_embeddings(frame(spark, vectors).repartition(3)).collect()
    check(rows, dict(enumerate(vectors)))


def test_dropped_vectors(spark):
    good = random_vectors(50, 4)
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0],
           [3e38, 0.0, 0.0, 0.0], [1.0, 2.0], [1.0] * 5]
    rows = whitening.whiten_embeddings(frame(spark, good + bad + [[]] * 60)).collect()
    check(rows, dict(enumerate(good)))


def test_null_and_repeated_ids_and_repeated_vectors(spark):
    vectors = random_vectors(30, 3) * 2
    rows = whitening.whiten_embeddings(frame(spark, vectors, ids=[None, 7, 7] + list(range(100, 157)))).collect()
    assert len(rows) == 60 * 3
    assert sum(r.vec_id is None for r in rows) == 3 and sum(r.vec_id == 7 for r in rows) == 6
    assert {r.n for r in rows} == {60}


def test_tables_without_variance(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]]):
        out = whitening.whiten_embeddings(frame(spark, vectors))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened",
                                                    "explained", "identity_error"]
    flat = [[a, 1.0, a] for a, *_ in random_vectors(20, 2)]
    assert {r.component for r in whitening.whiten_embeddings(frame(spark, flat)).collect()} == {1}


def test_large_entries(spark):
    vectors = [[c * 2.0 ** 40 for c in v] for v in random_vectors(20, 3)]
    rows = whitening.whiten_embeddings(frame(spark, vectors)).collect()
    assert all(r.deviation is None for r in rows) and len(rows) == 60
    assert max(abs(r.identity_error) for r in rows) < 1e-9
    x = np.array([[1, -2], [2 ** 31, 5], [3_037_000_499, 0], [3_037_000_500, 0]], dtype=np.int64)
    _, square = whitening.deviations(x, 1, [0, 0])
    assert square.to_pylist() == [5, 2 ** 62 + 25, 3_037_000_499 ** 2, None]


def test_query_over_the_small_table(spark):
    rows = registry()["op13_whitening"](spark, SMALL).collect()
    data = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    check(rows, {r.vec_id: r.embedding for r in data})
