"""The exact spectrum against numpy, rows against a plain computation with whole numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnflow.llm import exact_spectrum as S
from txnflow.llm import whitening as W
from txnflow.llm.queries import QUERIES


def scatter(y):
    n = len(y)
    s = y.sum(axis=0)
    return [[int(v) for v in row] for row in (n * (y.T @ y) - np.outer(s, s))]


def vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return np.floor(rng.normal(size=(n, d)) * np.linspace(1, 20, d)).astype(int)


def test_polynomial_is_exact(spark):
    for m in ([[2, 1], [1, 2]], [[0]], scatter(vectors(9, 5)), [[4, 0, 0], [0, 4, 0], [0, 0, 0]]):
        c = S.characteristic_polynomial(spark, m)
        for x in range(-3, 4):  # det(xI - A) by fractions
            from fractions import Fraction

            a = [[Fraction((x if i == j else 0) - m[i][j]) for j in range(len(m))] for i in range(len(m))]
            det = Fraction(1)
            for k in range(len(a)):
                p = next((i for i in range(k, len(a)) if a[i][k]), None)
                if p is None:
                    det = Fraction(0)
                    break
                if p != k:
                    a[k], a[p], det = a[p], a[k], -det
                det *= a[k][k]
                for i in range(k + 1, len(a)):
                    a[i] = [u - a[i][k] / a[k][k] * v for u, v in zip(a[i], a[k])]
            assert S._value(c, x) == det


def test_roots_and_null_vectors(spark):
    m = scatter(vectors(200, 12))
    roots = S.largest_roots(S.characteristic_polynomial(spark, m), 12)
    want = np.linalg.eigvalsh(np.array(m, float))[::-1]
    assert np.allclose([r / 2**S.ROOT_BITS for r, _ in roots], want, rtol=1e-12)
    found = S.components(spark, m, roots, 12)
    v = np.array([x for _, x in found])
    assert np.abs(v @ v.T - np.eye(12)).max() < 1e-14
    for (root, x) in found:
        assert np.abs(np.array(m, float) @ x - root / 2**S.ROOT_BITS * np.array(x)).max() < 1e-11 * want[0]


def test_multiple_and_zero_roots(spark):
    m = [[7 if i == j == 3 else 2 if i == j and i < 3 else 0 for j in range(5)] for i in range(5)]
    roots = S.largest_roots(S.characteristic_polynomial(spark, m), 32)
    assert [(r / 2**S.ROOT_BITS, k) for r, k in roots] == [(7.0, 1), (2.0, 3)]
    v = np.array([x for _, x in S.components(spark, m, roots, 3)])
    assert v.shape == (3, 5) and np.abs(v @ v.T - np.eye(3)).max() < 1e-14


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, `a-b` string, y string, id string")


def check(rows, got, most):
    """``got`` (id -> rows of whiten) against numpy on the whole numbers."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    centred = (x - s / n).astype(float)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    count = min(most, int((e > 1e-9 * e[0]).sum()))
    want = centred @ u[:, :count] / np.sqrt(e[:count])
    for k in range(count):
        mine = np.array([got[i][k][1] for i, _ in rows])
        assert min(np.abs(mine - want[:, k]).max(), np.abs(mine + want[:, k]).max()) < 1e-6
        assert math.isclose(got[rows[0][0]][k][2], e[k] / e.sum(), rel_tol=1e-9)
    for (i, _), dev in zip(rows, deviation):
        assert len(got[i]) == count and {r[0] for r in got[i]} == {dev}


def by_id(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["component"]):
        assert r["identity_error"] < 1e-9
        out.setdefault(r["id"], []).append((r["deviation"], r["whitened"], r["explained"]))
    return out


def test_rows_equal_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * [1, 2, 3, 4, 5, 6]).tolist()) for i in range(300)]
    bad = [(1000, None), (1001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1002, [float("nan")] * 6), (1003, [float("inf")] + [0.0] * 5), (1004, [1.0]), (1005, [])]
    df = frame(spark, [(i, v, 1, "a", "y", "id") for i, v in rows + bad])
    check(rows, by_id(W.whiten(df)), 32)
    check(rows, by_id(W.whiten(df, most=3)), 3)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.integers(-4, 4, size=3) * 1000.0 * 2**8).tolist()) for i in range(20)]
    check(rows, by_id(W.whiten(frame(spark, [(i, v, 1, "a", "y", "id") for i, v in rows]))), 32)


def test_repeats_constant_directions_and_empty_tables(spark):
    rows = [(1, [1.0, 5.0, 0.0]), (2, [2.0, 5.0, 1.0]), (3, [2.0, 5.0, 1.0]), (4, [4.0, 5.0, 0.5])]
    got = W.whiten(frame(spark, [(None if i == 3 else i, v, 1, "a", "y", "id") for i, v in rows]))
    assert got.where("id is null").count() == 2  # the constant direction has no component
    one = frame(spark, [(1, [1.0, 2.0], 1, "a", "y", "id")] * 3)
    assert W.whiten(one).count() == 0
    none = W.whiten(frame(spark, []))
    assert none.count() == 0 and none.dtypes == got.dtypes


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    got = QUERIES["op12_whitening"](spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    stats = got.agg(F.count("*"), F.count_distinct("component"), F.max("identity_error")).first()
    assert stats[0] == 32 * spark.read.parquet(f"{sf}/embeddings.parquet").count() and stats[1] == 32 and stats[2] < 1e-9
    check([(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()],
          by_id(got.withColumnRenamed("vec_id", "id")), 32)
