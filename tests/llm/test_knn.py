"""Exactness of the search where a query's id has many rows."""

import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulsegrid.llm import knn


def test_many_rows_of_a_query(spark):
    rng = np.random.default_rng(11)
    far = rng.normal(size=(40, 8)) * 0.2
    # ids that come first in the draw of pivots, so that their rows are cells of their own
    a, b = (r.id for r in spark.range(0, 100_000, 50).orderBy(F.xxhash64(F.lit(31), "id")).limit(2).collect())
    rows = [(a, [3.0] + [0.0] * 7)] * 12 + [(b, [0.0, 3.0] + [0.0] * 6)] * 12
    for i, x in enumerate(far):
        rows += [(100_001 + 100 * i + j, (x + rng.normal(size=8) * 0.02).tolist()) for j in range(25)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    rows = [(r.vec_id, [int(np.floor(256 * x)) for x in r.embedding]) for r in df.collect()]
    want = []
    for q in (a, b):
        own = next(v for i, v in rows if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in rows if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in knn.top_k(df, F.col("id").isin(a, b)).collect()) == sorted(want)


@pytest.mark.parametrize("seed", range(3))
def test_repeated_tied_and_clustered_rows(spark, monkeypatch, seed):
    """A third of all rows are one vector, ids have many rows, and scores tie; against brute force."""
    for name, n in (("BLOCK", 8), ("CHUNK", 16), ("SPLIT", 100)):
        monkeypatch.setattr(knn, name, n)
    rng = np.random.default_rng(seed)
    mids = rng.normal(size=(12, 4))
    rows = [(int(rng.integers(0, 150)), np.round(mids[int(rng.integers(12))] + rng.normal(size=4) * 0.1, 1).tolist()) for _ in range(500)]
    rows += [(50, [2.0, 0.0, 0.0, 0.0])] * 150 + [(200 + i % 7, [1.0, 1.0, 0.0, 0.0]) for i in range(150)]
    whole = [(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows]
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        scores = [(-sum(a * b for a, b in zip(u, v, strict=True)), i) for u in {v for i, v in whole if i == q} for i, v in whole if i != q]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in knn.top_k(df, F.col("id") % 50 == 0).collect()) == sorted(want)
