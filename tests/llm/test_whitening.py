"""Whitening against numpy, with hard rows and vectors without full rank."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import whitening


def expected(x, k=8):
    x = np.floor(1024 * np.array(x)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return ((n * x - s) ** 2).sum(axis=1), c @ vectors / np.sqrt(values), values / np.trace(c.T @ c / n)


@pytest.mark.parametrize("n,d,block", [(300, 12, 32), (40, 3, 1024)])
def test_against_numpy(spark, monkeypatch, n, d, block):
    monkeypatch.setattr(whitening, "ROWS", block)
    monkeypatch.setattr(whitening, "BUCKET", 50)
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    got = whitening.whitened(spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")).toPandas()
    deviation, white, share = expected(x)
    k = min(8, d)
    assert len(got) == n * k and set(got.n) == {n}
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    sign = np.sign((table * white).sum(axis=0))
    np.testing.assert_allclose(table * sign, white, atol=1e-9)
    assert got[got.component == 1].sort_values("vec_id").deviation.tolist() == deviation.tolist()
    np.testing.assert_allclose(got.groupby("component").explained.first(), share, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [1.0, -inf]), (5, []), (6, [1e300, 0.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0]), (None, [1.0, 3.0]), (8, [2.0, 4.5]), (9, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, KEY string").withColumnRenamed("KEY", "index")
    got = whitening.whitened(df).toPandas()
    two = got[got.n == 4]
    assert len(two) == 8 and two.vec_id.isna().sum() == 2 and (two.vec_id == 7).sum() == 4
    deviation, white, _ = expected([r[1] for r in rows[6:10]])
    first = two[two.component == 1]
    assert sorted(first.deviation.tolist()) == sorted(deviation.tolist())
    np.testing.assert_allclose(np.sort(np.abs(first.whitened)), np.sort(np.abs(white[:, 0])), atol=1e-9)
    one = got[got.n == 1]  # a single row has no variance
    assert len(one) == 3 and one.whitened.isna().all() and set(one.explained) == {0.0} and set(one.identity_error) == {0.0} and set(one.deviation) == {0}
    assert whitening.whitened(df.filter("false")).count() == 0
    flat = spark.range(30).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double"), 2.0 * F.col("id"), F.lit(1.0)).alias("embedding"))  # rank 1
    got = whitening.whitened(flat).toPandas()
    assert got[got.component > 1].whitened.isna().all() and abs(got[got.component == 1].whitened.var(ddof=0) - 1) < 1e-9


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [float(1 << 40), float(i)]) for i in range(3)] + [(9, [0.0, 0.0])]
    got = {r.vec_id: r.deviation for r in whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for (i, _), v in zip(rows, x, strict=True):
        want = sum((4 * a - s) ** 2 for a, s in zip(v, sums, strict=True))
        assert got[i] == (want if want < 1 << 63 else None)
