"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

The weights come from follow-the-regularised-leader with an elastic net (ftrl.py); a
temperature, fitted on rows that the weights have not seen, calibrates the probabilities.
Only the text is an input of a prediction.

Bounds: at most about `Ftrl.max_rows` labelled rows fit the weights; document frequencies
count every training row; every text is scored whole.  The model is 2**bits x languages
numbers, at most about MODEL of them: the more languages, the fewer places the n-grams are hashed to.

Cases: a null text, an empty one or one without a letter is `und` with score 0; rows with a
null language or a null key train nothing; without any training row all is `und`; repeated
rows are each scored; of languages with equal probabilities the first by name is taken; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.ftrl import Ftrl, feature_rows, fit, probabilities, sampled
from pulsegrid.llm.session import written
from pulsegrid.llm.textops import encoded, small_batches

ORDERS = (1, 2, 3)
MODEL = 1 << 23
TEMPERATURES = [round(0.05 * 1.15**i, 4) for i in range(40)]
_PIECE = 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x85EBCA6B)
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(13))


def ngram_counts(raw: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the hashed character 1- to 3-grams of the lower-cased text."""
    c = np.frombuffer((" " + raw.decode("utf-8", "replace").lower() + " ").encode("utf-32-le", "replace"), np.uint32)
    shift, total, found = np.uint32(32 - bits), None, []
    for start in range(0, len(c), _PIECE):
        for k in ORDERS:
            part = c[start : start + _PIECE + k - 1]
            n = len(part) - k + 1
            if n <= 0:
                continue
            h = np.full(n, k * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for j in range(k):
                h = _mixed(h + part[j : j + n] * np.uint32(0x27D4EB2F))
            found.append(h >> shift)
        if len(c) > 3000:
            total = (0 if total is None else total) + np.bincount(np.concatenate(found), minlength=1 << bits)
            found = []
    if total is not None:
        idx = np.flatnonzero(total)
        return idx, total[idx]
    return np.unique(np.concatenate(found), return_counts=True)


def _tfidf(raw: bytes, bits: int, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    idx, n = ngram_counts(raw, bits)
    val = (1 + np.log(n)) * idf[idx]
    return idx, val / max(np.sqrt((val * val).sum()), 1e-12)


def document_frequencies(texts: DataFrame, bits: int) -> np.ndarray:
    """In how many of the texts each place occurs; every task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << bits, np.int64)
        for b in batches:
            for raw in encoded(b.column(0)):
                df[ngram_counts(raw, bits)[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["place", "n"])

    out = np.zeros(1 << bits, np.int64)
    for r in texts.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():  # at most 2**bits rows
        out[r.place] = r.n
    return out


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    bits: int
    temperature: float = 1.0


def train(labelled: DataFrame, cfg: Ftrl = Ftrl(), key: str = "doc_id") -> LanguageModel | None:
    """labelled: key, text, lang.  None if there is no usable row."""
    spark = labelled.sparkSession
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select(F.col(key).alias("key"), "text", "lang").filter("key IS NOT NULL")
    languages = sorted(r.lang for r in labelled.select("lang").distinct().collect())  # classes of the model, and so few
    if not languages:
        return None
    cfg = replace(cfg, bits=max(8, min(cfg.bits, (MODEL // len(languages)).bit_length() - 1)))
    df = document_frequencies(labelled, cfg.bits)
    idf = (np.log((1 + df.max()) / (1 + df)) + 1).astype(np.float32)
    y = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")).cast("int") - 1
    rows = sampled(labelled, cfg, "key", 11, holdout=6).withColumn("y", y)
    bits = cfg.bits
    features = written(feature_rows(rows, lambda raw: _tfidf(raw, bits, idf)))
    model = LanguageModel(languages, fit(features, len(languages), cfg).astype(np.float32), idf, bits)
    model.temperature = _temperature(spark, features.filter("shard < 0"), model)
    return model


def _temperature(spark: SparkSession, held: DataFrame, model: LanguageModel) -> float:
    """The temperature of the grid with the least log loss over the rows kept from training."""
    w = spark.sparkContext.broadcast(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(np.frombuffer(v, np.float32) @ w.value[np.frombuffer(i, np.uint32)] + w.value[-1]).astype(float).tolist() for i, v in zip(b["idx"].to_pylist(), b["val"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["y"], pa.array(out, pa.list_(pa.float64()))], names=["y", "z"])

    z = held.select("y", "idx", "val").mapInArrow(run, "y int, z array<double>").withColumn("t", F.explode(F.array(*map(F.lit, TEMPERATURES))))
    top = F.array_max("z")
    logsum = F.log(F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp((x - top) / F.col("t")))) + top / F.col("t")
    loss = z.groupBy("t").agg(F.avg(logsum - F.get("z", F.col("y")) / F.col("t")).alias("loss")).collect()
    return min(((r.loss, r.t) for r in loss if r.loss is not None), default=(0, 1.0))[1]


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score for each row."""
    out = docs.select(*keep, F.col(text).alias("__text"))
    if model is None:
        return out.drop("__text").withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.idf, model.bits, model.temperature))
    schema = out.drop("__text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, weights, idf, bits, temperature = shared.value
        for b in small_batches(batches):
            lang, score = [], []
            for raw, ok in zip(encoded(b["__text"]), b["__letters"].to_pylist(), strict=True):
                if not ok:
                    lang.append("und")
                    score.append(0.0)
                    continue
                idx, val = _tfidf(raw, bits, idf)
                p = probabilities((val @ weights[idx] + weights[-1]) / temperature)
                k = int(p.argmax())
                lang.append(languages[k])
                score.append(min(1.0, float(p[k])))
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*keep, "lang_pred", "score"])

    return out.withColumn("__letters", F.coalesce(F.col("__text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(run, schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = docs.withColumn("held_out", held)
    model = train(docs.filter("NOT held_out AND doc_id IS NOT NULL").select("doc_id", "text", "lang"))
    return predict(docs, model, keep=("doc_id", "held_out"))
