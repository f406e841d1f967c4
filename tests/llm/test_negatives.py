"""Hard negatives against brute force: ties, clusters, a hot label, repeated ids, hard rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import negatives

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, positives=5, negatives_=3):
    rows = [(i, label, tuple(int(np.floor(256 * x)) for x in v)) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, label, v in sorted(set(r for r in rows if r[0] % 50 == 0)):
        scored = [(-max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(v, w, strict=True)))), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            found = sorted(x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives_]
            out += [(i, j, n + 1, f[1], -s, -f[0]) for n, f in enumerate(found)]
    return sorted(out)


def mined(spark, rows, kind=KIND):
    return sorted(tuple(r) for r in negatives.hard_negatives(spark.createDataFrame(rows, kind), F.col("id") % 50 == 0).collect())


@pytest.mark.parametrize("seed", range(2))
def test_clusters_ties_and_a_hot_label(spark, monkeypatch, seed):
    for name, n in (("BLOCK", 8), ("CHUNK", 16), ("SPLIT", 100), ("STEP", 3)):
        monkeypatch.setattr(negatives, name, n)
    rng = np.random.default_rng(seed)
    mids = rng.normal(size=(9, 5))
    rows = [(int(i), np.round(mids[rng.integers(9)] + rng.normal(size=5) * 0.2, 1).tolist(), int(rng.integers(0, 4))) for i in rng.integers(0, 400, 400)]
    rows += [(400 + i % 130, [1.0, 1.0, 0.0, 0.0, 0.5], 1) for i in range(200)]  # one vector and label of a third of the rows
    assert mined(spark, rows) == brute(rows)


def test_bounds_hold_for_all_pairs():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(80, 6)) * 256 * rng.choice([0, 1e-2, 1, 1e3], size=(80, 1)))
    x[10:20] = x[:10] * 3  # parallel ones, where cosines round
    d = x[np.abs(x).sum(1) > 0][:12]
    d = d / np.sqrt((d * d).sum(1))[:, None]
    norm = np.sqrt((x * x).sum(1))
    angle = negatives._angles(x, norm, d)
    cell = angle.argmin(1)
    stored = np.vstack([angle[np.arange(len(x)), cell], angle[:, : negatives.SHARED].T])
    low, high = negatives._bounds(angle, norm, cell, stored, stored, norm, norm)
    assert (low <= x @ x.T).all() and (x @ x.T <= high).all()
    assert (high < (x @ x.T).max()).any()


def test_hard_rows(spark):
    bad = [(None, [1.0, 2.0], 1), (50, None, 1), (51, [1.0, None], 1), (52, [1.0, float("nan")], 0), (53, [float("inf"), 1.0], 0), (54, [1.0, 1.0], None), (55, [], 1), (0, [3.0, 1.0, 2.0], 1)]
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (0, [1.0, 0.5], 2), (1, [1.0, 0.9], 1), (1, [1.0, 0.9], 1), (2, [0.6, 0.6], 2), (3, [0.6, 0.6], 3), (4, [0.0, 0.0], 1), (100, [-1.0, -1.0], 1), (150, [0.0, 0.0], 3)]
    rows += [(7, [3e9, 1e9], 1), (8, [2e9, 1e9], 2), (200, [3e9, 2e9], 1)]  # products near the largest long
    df = spark.createDataFrame([(*r, "x") for r in bad + rows], KIND + ", Id string")
    got = negatives.hard_negatives(df.withColumnRenamed("Id", "block"), F.col("id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(bad + rows)
    assert mined(spark, bad) == [] and mined(spark, []) == []
