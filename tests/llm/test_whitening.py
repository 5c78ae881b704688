import numpy as np
import pytest

from tierline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, components=8):
    """By numpy's eigenvalues of the covariance of whole-number vectors."""
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:components]
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return n, deviation, y @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)


def collected(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    return found


@pytest.mark.parametrize("dimension, rows", [(12, 200), (3, 50), (40, 30)])
def test_against_numpy(spark, dimension, rows):
    rng = np.random.default_rng(dimension)
    vectors = (rng.normal(size=(rows, dimension)) * np.linspace(3, 0.2, dimension) + 5).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(5)
    n, deviation, whitened, explained = plain(vectors)
    found = collected(whitening.whiten(df))
    k = min(8, dimension)
    assert sorted(found) == list(range(rows)) and all(sorted(f) == list(range(1, k + 1)) for f in found.values())
    ours = np.array([[found[i][c].whitened for c in range(1, k + 1)] for i in range(rows)])
    signs = np.sign((ours * whitened[:, :k]).sum(axis=0))
    np.testing.assert_allclose(ours * signs, whitened[:, :k], rtol=1e-7, atol=1e-8)
    for i in range(rows):
        for c, r in found[i].items():
            assert r.n == n and r.deviation == deviation[i] and r.identity_error < 1e-9
            assert abs(r.explained / explained[c - 1] - 1) < 1e-9


def test_what_takes_no_part(spark):
    good = [[float(i), float(i * i % 7), 1.0] for i in range(20)]
    bad = [(90, None), (91, [1.0, None, 1.0]), (92, [float("nan"), 1.0, 1.0]), (93, [float("inf"), 1.0, 1.0]),
           (94, []), (95, [1.0, 2.0])]
    df = spark.createDataFrame([*enumerate(good), *bad], SCHEMA).selectExpr("*", "1 AS v", "2 AS x", "'' AS whitened", "0 AS n")
    found = collected(whitening.whiten(df))
    assert sorted(found) == list(range(20))
    # The third entry never varies: two components only.
    assert all(sorted(f) == [1, 2] and f[1].n == 20 for f in found.values())


def test_repeats_count_each_and_a_null_id_stays(spark):
    vectors = [[0.0, 1.0], [2.0, 1.5], [2.0, 1.5], [4.0, -3.0]]
    df = spark.createDataFrame(list(zip([1, 2, 2, None], vectors)), SCHEMA)
    rows = whitening.whiten(df).collect()
    assert len(rows) == 8 and {r.n for r in rows} == {4} and sum(r.vec_id is None for r in rows) == 2


def test_without_variance_and_without_rows(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], SCHEMA)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []


def test_large_entries_and_deviations_beyond_64_bits(spark):
    df = spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 0.0]), (3, [0.0, 1.0])], SCHEMA)
    rows = collected(whitening.whiten(df))
    assert rows[1][1].deviation is None and rows[1][1].identity_error < 1e-4


def test_long_vectors(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=300).tolist()) for i in range(12)], SCHEMA)
    rows = whitening.whiten(df).collect()
    assert len(rows) == 12 * 8 and rows[0].identity_error < 1e-9


def test_factor_and_rotation():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(30, 6)) * [1e4, 1e2, 1, 1, 1e-2, 1e-3]
    matrix = a.T @ a
    factor = whitening.pivoted_cholesky(matrix)
    np.testing.assert_allclose(factor @ factor.T, matrix, rtol=1e-12, atol=1e-9)
    values, directions = whitening.principal(matrix)
    np.testing.assert_allclose(values, np.linalg.svd(a)[1] ** 2, rtol=1e-5)
    np.testing.assert_allclose(directions.T @ directions, np.eye(6), atol=1e-12)
    assert whitening.pivoted_cholesky(np.ones((3, 3))).shape == (3, 1)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
