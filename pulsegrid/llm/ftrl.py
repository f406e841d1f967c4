"""Linear models over hashed sparse features, trained with follow-the-regularised-leader.

Each of a fixed number of shards runs FTRL-proximal over its own rows as a Spark task;
the shards' weights are then averaged (parameter mixing).  A model is one array of
2**bits x outputs numbers, whose size does not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.textops import encoded, small_batches


@dataclass(frozen=True)
class Ftrl:
    """bits: features are hashed to 2**bits places.  l1 and l2 are the elastic net.
    max_rows bounds the labelled rows that are used for fitting (in expectation, by a hash of the row)."""

    bits: int = 16
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    epochs: int = 4
    shards: int = 8
    max_rows: int = 16_000


SHARD_ROWS = 2000
WEIGHTS = 1 << 16  # numbers of a block of weights
FEATURES = "y int, shard int, idx binary, val binary"


def feature_rows(df: DataFrame, featurise: Callable[[bytes], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(y, shard, text) to (y, shard, idx, val): uint32 places and float32 values of the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 256):
            made = [featurise(raw) for raw in encoded(b["text"])]
            yield pa.RecordBatch.from_arrays(
                [b["y"].cast(pa.int32()), b["shard"].cast(pa.int32()), pa.array([i.astype(np.uint32).tobytes() for i, _ in made], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in made], pa.binary())],
                names=["y", "shard", "idx", "val"],
            )

    return df.select("y", "shard", "text").mapInArrow(run, FEATURES)


def probabilities(scores: np.ndarray) -> np.ndarray:
    """Softmax of several scores; of one score, the logistic function."""
    if scores.shape[-1] == 1:
        return 1 / (1 + np.exp(-np.clip(scores, -35, 35)))
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _fit_shard(rows: list[tuple[int, np.ndarray, np.ndarray]], outputs: int, cfg: Ftrl) -> np.ndarray:
    size = (1 << cfg.bits) + 1  # the last place is the intercept
    z, n = np.zeros((size, outputs)), np.zeros((size, outputs))

    def weights(idx: np.ndarray) -> np.ndarray:
        zi = z[idx]
        return np.where(np.abs(zi) <= cfg.l1, 0.0, -(zi - np.sign(zi) * cfg.l1) / ((cfg.beta + np.sqrt(n[idx])) / cfg.alpha + cfg.l2))

    order = np.arange(len(rows))
    for epoch in range(cfg.epochs):
        np.random.default_rng(epoch).shuffle(order)
        for r in order:
            y, idx, val = rows[r]
            idx, val = np.append(idx.astype(np.int64), size - 1), np.append(val.astype(float), 1.0)
            w = weights(idx)
            error = probabilities(val @ w)
            if outputs == 1:
                error = error - y
            else:
                error[y] -= 1
            g = val[:, None] * error[None, :]
            old = n[idx]
            new = old + g * g
            z[idx] += g - (np.sqrt(new) - np.sqrt(old)) / cfg.alpha * w
            n[idx] = new
    return weights(np.arange(size))


def fit(rows: DataFrame, outputs: int, cfg: Ftrl, featurise: Callable[[bytes], tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """Weights ((2**bits + 1) x outputs; the last row is the intercept) from the rows with shard >= 0: (y, shard, idx, val),
    or (y, shard, text) with featurise, so that only texts are shuffled.

    A shard holds about max_rows / shards rows in one task; shards without rows do not count.  The shards' weights are
    averaged by blocks of places, and the driver receives one model, whatever the corpus."""
    size, columns = ((1 << cfg.bits) + 1) * outputs, ("y", "shard", *(("text",) if featurise else ("idx", "val")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for b in batches:
            if featurise:
                made = ((np.asarray(i, np.uint32), np.asarray(v, np.float32)) for i, v in map(featurise, encoded(b["text"])))
            else:
                made = ((np.frombuffer(i, np.uint32), np.frombuffer(v, np.float32)) for i, v in zip(b["idx"].to_pylist(), b["val"].to_pylist(), strict=True))
            for y, s, (i, v) in zip(b["y"].to_pylist(), b["shard"].to_pylist(), made, strict=True):
                by.setdefault(s, []).append((y, i, v))
        for s in sorted(by):
            fitted = sorted(by[s], key=lambda r: (len(r[1]), r[0], r[1].tobytes(), r[2].tobytes()))  # shuffles arrive in any order
            w = _fit_shard(fitted, outputs, cfg).astype(np.float32).ravel()
            for start in range(0, size, WEIGHTS):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([len(fitted)], pa.int64()), pa.array([start], pa.int64()), pa.array([w[start : start + WEIGHTS].tobytes()], pa.binary())], names=["shard", "n", "start", "w"])

    def mean(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("shard")
        n = parts["n"].to_numpy()
        w = sum(k * np.frombuffer(x, np.float32).astype(float) for k, x in zip(n.tolist(), parts["w"].to_pylist(), strict=True)) / n.sum()
        return pa.table({"start": parts["start"].slice(0, 1), "w": pa.array([w.tobytes()], pa.binary())})

    made = rows.filter("shard >= 0").select(*columns).repartition(cfg.shards, "shard").mapInArrow(run, "shard int, n long, start long, w binary")
    blocks = made.groupBy("start").applyInArrow(mean, "start long, w binary").toArrow()  # one model
    total = np.zeros(size)
    for start, w in zip(blocks["start"].to_pylist(), blocks["w"].to_pylist(), strict=True):
        part = np.frombuffer(w, float)
        total[start : start + len(part)] = part
    return total.reshape(-1, outputs)


def sampled(df: DataFrame, cfg: Ftrl, key: str, salt: int, holdout: int = 0) -> DataFrame:
    """At most about cfg.max_rows rows, by a hash of key, each with its shard; one in `holdout` gets shard -1.
    Shards hold about SHARD_ROWS rows, so that few rows are one shard."""
    n = df.count()
    shards = max(1, min(cfg.shards, -(-min(n, cfg.max_rows) // SHARD_ROWS)))
    part = min(1.0, cfg.max_rows / max(n, 1))
    h = F.xxhash64(F.lit(salt), F.col(key))
    h2 = F.xxhash64(F.lit(salt + 1), F.col(key))
    shard = F.pmod(h2, F.lit(shards)).cast("int")
    if holdout:
        shard = F.when(F.pmod(F.xxhash64(F.lit(salt + 2), F.col(key)), F.lit(holdout)) == 0, F.lit(-1)).otherwise(shard)
    return df.filter(F.pmod(h, F.lit(1_000_000)) < round(part * 1_000_000)).withColumn("shard", shard)
