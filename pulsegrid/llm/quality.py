"""Quality classifier: logistic regression on hashed word n-grams.

Trained with follow-the-regularised-leader (ftrl.py), scored as one sparse dot product per
text.  Tokens are runs of letters and digits, and runs of other signs; each gives its own
hash, its shape (upper, title or lower case, digits, signs) and whether it repeats one of the
two tokens before it; n-grams are one and two tokens long.

Bounds: at most about `Ftrl.max_rows` labelled rows fit the weights; their keys are joined by
broadcast, which that parameter bounds.  Every text is scored whole.  The model is 2**bits numbers.

Cases: a null or empty text gets the score of the intercept; labels that are null, or whose
document is missing, are not used; several labels of one document count by their mean; without
any label every score is 0.5; a document with a null key is scored and never learnt from; repeated rows are each scored; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.ftrl import Ftrl, feature_rows, fit, probabilities, sampled
from pulsegrid.llm.session import written
from pulsegrid.llm.textops import U, _span_hashes, encoded, mix, pieces, small_batches

CONFIG = Ftrl(bits=18, alpha=4.0, l1=0.001, l2=0.0005, epochs=8, max_rows=16_000)
THRESHOLD = 0.3
_CLASS = np.zeros(256, np.uint8)  # 0 space, 1 letters and digits, 2 signs
_CLASS[33:128] = 2
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[0:9] = _CLASS[14:32] = 2


def _tokens(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape of each token."""
    kind = _CLASS[a]
    cut = np.flatnonzero(np.diff(kind)) + 1
    s, e = np.concatenate(([0], cut)), np.concatenate((cut, [len(a)]))
    k = kind[s]
    s, e, k = s[k > 0], e[k > 0], k[k > 0]
    if not len(s):
        return np.zeros(0, U), np.zeros(0, U)
    upper = np.concatenate(([0], np.cumsum((a >= 65) & (a <= 90))))
    lower = np.concatenate(([0], np.cumsum((a >= 97) & (a <= 122))))
    ups, lows = upper[e] - upper[s], lower[e] - lower[s]
    shape = np.where(k == 2, 0, np.where(ups == 0, np.where(lows > 0, 1, 2), np.where(lows > 0, 3, np.where(e - s == 1, 4, 5)))).astype(U)
    return _span_hashes(a, s, e), shape


def featurise(raw: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places and L2-normalised, damped counts of the hashed token n-grams of a whole text."""
    a, shift = np.frombuffer(raw, np.uint8), U(64 - bits)
    parts = [_tokens(a[i:j]) for i, j in pieces(a)]  # cut at white space, so that no token is
    if not sum(len(h) for h, _ in parts):
        return np.zeros(0, np.int64), np.zeros(0)
    h, shape = (np.concatenate(x) for x in zip(*parts, strict=True))
    pair, same = mix(h[:-1] * U(3) + h[1:] * U(5)), (h[1:] == h[:-1]).astype(U)
    shapes = mix(shape[:-1] * U(64) + shape[1:] * U(8) + same + U(1000))
    again = np.concatenate((same[same > 0] + U(200), (h[2:] == h[:-2])[h[2:] == h[:-2]].astype(U) + U(300)))
    place = [mix(h) >> shift, pair >> shift, mix(shape + U(100)) >> shift, shapes >> shift, mix(again) >> shift]
    idx, n = np.unique(np.concatenate(place).astype(np.int64), return_counts=True)
    val = 1 + np.log(n)
    return idx, val / np.sqrt((val * val).sum())


def train(labelled: DataFrame, docs: DataFrame, cfg: Ftrl = CONFIG) -> np.ndarray | None:
    """labelled: doc_id, label (0 or 1); docs: doc_id, text.  None without a usable label."""
    by_doc = labelled.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("y"))
    by_doc = by_doc.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = sampled(by_doc, cfg, "doc_id", 23)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    bits = cfg.bits
    features = written(feature_rows(rows, lambda raw: featurise(raw, bits)))
    if features.isEmpty():
        return None
    return fit(features, 1, cfg).astype(np.float32)[:, 0]


def score(docs: DataFrame, weights: np.ndarray | None, keep: tuple[str, ...] = ("doc_id",), bits: int = CONFIG.bits, name: str = "score") -> DataFrame:
    """The kept columns and the probability of label 1."""
    schema = docs.select(*keep).schema.add(name, "double")
    if weights is None:
        return docs.select(*keep, F.lit(0.5).alias(name))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    at = "text" if "text" in keep else "__text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for b in small_batches(batches):
            z = []
            for raw in encoded(b[at]):
                idx, val = featurise(raw, bits)
                z.append(float(val @ w[idx]) + float(w[-1]))
            p = probabilities(np.array(z, float)[:, None])[:, 0]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(p, pa.float64())], names=[*keep, name])

    return docs.select(*keep, *([] if at == "text" else [F.col("text").alias(at)])).mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is at least the threshold, with their columns.  labels: doc_id, label."""
    scored = score(docs, train(labels, docs.select("doc_id", "text")), keep=tuple(docs.columns), name="__score")
    return scored.filter(F.col("__score") >= threshold).select(*docs.columns)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label")).withColumn("held_out", held).filter("NOT held_out")
    weights = train(labels, docs)
    return score(docs.withColumn("held_out", held), weights, keep=("doc_id", "held_out")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
