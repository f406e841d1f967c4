"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the different character n-grams (3 to 5 code points, lower case) of its words, a word having
one space before and one after it; no n-gram runs over two words.  Each is hashed to one of 2**bits places.  Of each
place, the documents of each label that hold it are counted; its ratio is

    r = log( (p + s P / N) / P  :  (q + s Q / N) / Q )

where p of P documents with label 1 and q of Q with label 0 hold it, N = P + Q, and s is SMOOTHING, so that a place seen
nowhere has the ratio 0.  A feature's value is its place's ratio, and weights are fitted by
follow-the-regularised-leader (ftrl.py) with an elastic net, which leaves most places out, so that a long text has
no more noise than a short one.

Bounds: at most about `Ftrl.max_rows` labelled rows fit the ratios and weights (a hash of the document draws them);
their keys are joined by broadcast, which that parameter bounds.  Every text is scored whole, long ones in pieces cut at
white space.  The model is one number a place.

Cases: a null or empty text gets the score of the intercept; labels that are null, or whose document is missing, are
not used; several labels of one document count by their mean; without any label every score is 0.5, and with labels of
one kind only the ratios are 0 and the intercept decides; repeated rows are each scored; null keys are scored, never
learnt from; other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.ftrl import Ftrl, fit, probabilities, sampled
from pulsegrid.llm.session import written
from pulsegrid.llm.textops import encoded, is_space, pieces, small_batches

CONFIG = Ftrl(bits=18, alpha=0.1, l1=5.0, l2=0.05, epochs=5, max_rows=16_000)
ORDERS = (3, 4, 5)
SMOOTHING = 10.0
THRESHOLD = 0.5


def _places(raw: bytes, bits: int) -> np.ndarray:
    """The hashed n-grams of a piece of text, with repeats."""
    c = np.frombuffer((" " + raw.decode("utf-8", "replace").lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    blank = is_space(c)
    c = np.where(blank, np.uint32(32), c)[~(blank & np.concatenate(([False], blank[:-1])))]  # runs of white space are one space
    spaces = np.concatenate(([0], np.cumsum(c == 32)))
    out = []
    for k in ORDERS:
        n = len(c) - k + 1
        if n <= 0:
            continue
        h = np.full(n, k * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for j in range(k):
            h = (h ^ c[j : j + n]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        h = (h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)
        inside = spaces[k - 1 : k - 1 + n] - spaces[1 : 1 + n]  # spaces between the first and the last sign
        out.append(h[inside == 0])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def featurise(raw: bytes, bits: int) -> np.ndarray:
    """The sorted different places of the n-grams of a whole text."""
    a = np.frombuffer(raw, np.uint8)
    if len(a) < 1 << 14:
        return np.unique(_places(raw, bits)).astype(np.int64)
    seen = np.zeros(1 << bits, bool)
    for i, j in pieces(a):
        seen[_places(raw[i:j], bits)] = True
    return np.flatnonzero(seen)


def log_ratios(rows: DataFrame, bits: int, smoothing: float = SMOOTHING) -> np.ndarray:
    """rows: y (0 or 1) and text.  The ratio of each place, from counts of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, (1 << bits) + 1), np.int64)  # the last place counts the documents
        for b in batches:
            for y, raw in zip(b["y"].to_pylist(), encoded(b["text"]), strict=True):
                n[y, featurise(raw, bits)] += 1
                n[y, -1] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[1, at]), pa.array(n[0, at])], names=["place", "p", "q"])

    found = rows.select("y", "text").mapInArrow(run, "place long, p long, q long").groupBy("place").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).toArrow()  # at most 2**bits + 1 rows
    p, q = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    at = found["place"].to_numpy()
    p[at], q[at] = found["p"].to_numpy(), found["q"].to_numpy()
    P, Q = p[-1], q[-1]
    if not P or not Q:
        return np.zeros(1 << bits, np.float32)
    s = smoothing / (P + Q)
    return (np.log(p[:-1] / P + s) - np.log(q[:-1] / Q + s)).astype(np.float32)


def train(labelled: DataFrame, docs: DataFrame, cfg: Ftrl = CONFIG) -> np.ndarray | None:
    """labelled: doc_id, label (0 or 1); docs: doc_id, text.  The weight of each place times its ratio, then the
    intercept; None without a usable label."""
    by_doc = labelled.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("y"))
    by_doc = by_doc.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = sampled(by_doc, cfg, "doc_id", 41)
    rows = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("y", "shard", "text"))
    if rows.isEmpty():
        return None
    bits, ratio = cfg.bits, log_ratios(rows, cfg.bits)
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        idx = featurise(raw, bits)
        idx = idx[shared.value[idx] != 0]
        return idx, shared.value[idx]

    weights = fit(rows, 1, cfg, features)[:, 0]
    return np.append(weights[:-1] * ratio, weights[-1]).astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray | None, keep: tuple[str, ...] = ("doc_id",), bits: int = CONFIG.bits, name: str = "score") -> DataFrame:
    """The kept columns (not the text, unless it is one) and the probability of label 1."""
    if weights is None:
        return docs.select(*keep, F.lit(0.5).alias(name))
    schema = docs.select(*keep).schema.add(name, "double")
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in small_batches(batches):
            z = [float(w[featurise(raw, bits)].sum(dtype=float)) + float(w[-1]) for raw in encoded(b["__text"])]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(probabilities(np.array(z, float)[:, None])[:, 0], pa.float64())], names=[*keep, name])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label")).withColumn("held_out", held).filter("NOT held_out")
    weights = train(labels, docs)
    return score(docs.withColumn("held_out", held), weights, keep=("doc_id", "held_out")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
