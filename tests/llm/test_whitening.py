import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from comanda.llm import queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int, n long, component string, whitened string"


def table(spark, vectors, kind="float"):
    rows = [(i, v, 1, 5, "x", "y") for i, v in vectors]
    return spark.createDataFrame(rows, VECTORS.replace("float", kind))


def brute(vectors, count=8):
    """x, exact deviations, eigenvalues and eigenvectors by the plain way."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors], object)
    n, sums = len(x), x.sum(0)
    deviation = ((n * x - sums) ** 2).sum(1)
    apart = (n * x - sums).astype(float) / n
    values, turn = np.linalg.eigh(apart.T @ apart / n)
    return deviation, apart, values[::-1][:count], turn[:, ::-1][:, :count]


def held_against(found, vectors, ids, count=8):
    deviation, apart, values, turn = brute(vectors, count)
    n, rows = len(vectors), {}
    for r in found.collect():
        rows.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(rows) == list(range(1, len(values) + 1))
    trace = (apart * apart).sum() / n
    for k, of in rows.items():
        assert sorted(of) == sorted(ids)
        got = np.array([of[i].whitened for i in ids])
        want = apart @ turn[:, k - 1] / np.sqrt(values[k - 1])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
        for i, d in zip(ids, deviation):
            assert of[i].deviation == d and of[i].n == n
            assert of[i].explained == pytest.approx(values[k - 1] / trace, rel=1e-9)
            assert of[i].identity_error < 1e-9
            assert of[i].distance == pytest.approx(d / n**2)


def made(rows, dims, seed=3):
    draw = np.random.default_rng(seed)
    return (draw.standard_normal((rows, dims)) @ draw.standard_normal((dims, dims)) / dims).astype(np.float32).tolist()


@pytest.mark.parametrize("rows, dims", [(300, 12), (40, 3), (2, 1), (500, 64)])
def test_whitened_vectors_equal_the_plain_way(spark, rows, dims):
    vectors = made(rows, dims)
    found = whitening.whiten(table(spark, list(enumerate(vectors))).repartition(5))
    held_against(found, vectors, list(range(rows)), min(8, dims))


def test_odd_vectors_are_left_out(spark):
    vectors, nan, inf = made(50, 4), float("nan"), float("inf")
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0]), (902, [nan] * 4), (903, [0.0, -inf, 0.0, 0.0]), (904, []), (905, [1.0] * 3)]
    found = whitening.whiten(table(spark, [*enumerate(vectors), *odd]))
    held_against(found, vectors, list(range(50)), 4)


def test_repeated_and_null_ids_have_rows_each(spark):
    vectors = made(9, 2)
    found = whitening.whiten(table(spark, [(None, vectors[0]), (3, vectors[1]), (3, vectors[1]), *[(3, v) for v in vectors[2:]]]))
    assert found.where("vec_id is null").count() == 2 and found.count() == 20


def test_what_has_no_variance_has_no_rows(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None)])).count() == 0
    assert whitening.whiten(table(spark, [(1, [0.5, 0.25])])).count() == 0
    assert whitening.whiten(table(spark, [(i, [0.5, 0.25]) for i in range(9)])).count() == 0
    line = whitening.whiten(table(spark, [(i, [0.5 * i, 0.25, float(i)]) for i in range(9)]))
    assert {r.component for r in line.collect()} == {1}


def test_large_entries_stay_exact(spark):
    draw = random.Random(4)
    vectors = [[float(draw.randrange(-(1 << 35), 1 << 35)), 0.5, float(draw.randrange(9))] for _ in range(20)]
    found = whitening.whiten(table(spark, list(enumerate(vectors)), "double"))
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for v in vectors], object)
    deviation = ((20 * x - x.sum(0)) ** 2).sum(1)
    for r in found.collect():
        assert r.deviation == (deviation[r.vec_id] if deviation[r.vec_id] < 1 << 63 else None)
    exact = whitening.covariance(whitening.usable(table(spark, list(enumerate(vectors)), "double")))
    assert exact[0] == 20 and exact[1] == x.sum(0).tolist()


@pytest.mark.parametrize("values", [[9, 9, 9, 4, 1], [5] * 12, [1e8, 1, 1e-2], [7, 0, 0], [3, 3 - 1e-9, 2, 2, 2, 2, 2, 2, 2, 2, 1]])
def test_components_of_near_equal_values(values):
    turn, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((len(values),) * 2))
    matrix = (turn * np.array(values, float)) @ turn.T
    found, vectors = whitening.leading_components((matrix + matrix.T) / 2, 8)
    want = sorted((v for v in values if v > 0), reverse=True)[:8]
    assert np.allclose(found, want, rtol=1e-6)
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-9
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * max(values)


def test_products_are_exact():
    rows = np.array([[1 << 50, -3], [-(1 << 51), 7], [5, 1 << 40]], np.int64)
    plain = rows.astype(object)
    assert (whitening.exact_products(rows) == plain.T @ plain).all()


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.QUERIES["op11_whitened_vectors"](spark, folder)
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").where(F.col("embedding").isNotNull()).collect()
    held_against(found, [r.embedding for r in rows], [r.vec_id for r in rows])
