"""Toxicity against a version in plain Python: n-grams, ratios, scores; then planted texts and hard rows."""

import math
import zlib

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from pulsegrid.llm import ftrl, toxicity

DATA = "/root/testdata/sf0.001"
M = 0xFFFFFFFF


def plain_places(text, bits):
    out = set()
    words = "".join(" " if c in " \t\n\v\f\r" else c for c in (" " + text.lower() + " ")).split(" ")
    for word in (" " + w + " " for w in words if w):
        for k in toxicity.ORDERS:
            for i in range(len(word) - k + 1):
                h = k * 0x9E3779B1 & M
                for c in word[i : i + k]:
                    h = (h ^ ord(c)) * 0x85EBCA6B & M
                    h ^= h >> 15
                out.add((h * 0xC2B2AE35 & M) >> (32 - bits))
    return out


def test_ngrams_against_plain(monkeypatch):
    texts = ["", " ", "a", "You IDIOT,\n\tyou  ñandú \x0b x", "ß" * 9, "word " * 9000, "x" * 40_000 + " y"]
    for text in texts:
        assert set(toxicity.featurise(text.encode(), 12).tolist()) == plain_places(text, 12)


def test_query_against_plain(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{DATA}/documents.parquet").to_pylist()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{DATA}/labels.parquet").to_pylist() if not held[r["doc_id"]]}
    bits = toxicity.CONFIG.bits
    places = {i: sorted(plain_places(t, bits)) for i, t in docs.items()}
    p, q = {}, {}
    for i, y in labels.items():
        for x in places[i]:
            (p if y else q)[x] = (p if y else q).get(x, 0) + 1
    P, N = sum(labels.values()), len(labels)
    Q, s = N - P, toxicity.SMOOTHING / N
    ratio = {x: np.float32(math.log(p.get(x, 0) / P + s) - math.log(q.get(x, 0) / Q + s)) for x in {*p, *q}}
    rows = []
    for i, y in labels.items():
        idx = np.array([x for x in places[i] if ratio[x] != 0], np.uint32)
        rows.append((y, idx, np.array([ratio[x] for x in idx.tolist()], np.float32)))
    rows.sort(key=lambda r: (len(r[1]), r[0], r[1].tobytes(), r[2].tobytes()))
    w = ftrl._fit_shard(rows, 1, toxicity.CONFIG)[:, 0]
    got = {r.doc_id: r for r in toxicity.op13_toxicity(spark, DATA).collect()}
    assert got.keys() == docs.keys()
    for i, r in got.items():
        z = w[-1] + sum(w[x] * ratio.get(x, 0) for x in places[i])
        assert r.held_out == held[i] and r.predicted == (r.score >= 0.5)
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-4


def test_planted_texts_in_long_and_short_documents(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aeiounrtsl"), 5)) for _ in range(400)]
    bad = ["grubbleknave", "snotwick", "vilefroth"]

    def text(n, toxic):
        out = rng.choice(words, n).tolist()
        for _ in range(max(1, n // 60) if toxic else 0):
            out.insert(int(rng.integers(len(out) + 1)), bad[int(rng.integers(3))])
        return " ".join(out)

    rows = [(i, text(int(rng.choice([5, 60, 300, 4000], p=[0.3, 0.4, 0.29, 0.01])), i % 9 == 0), int(i % 9 == 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    learnt = df.filter("doc_id < 600")
    got = toxicity.score(df.filter("doc_id >= 600").select("doc_id", "text", "label"), toxicity.train(learnt, learnt), keep=("doc_id", "label")).collect()
    assert np.mean([(r.score >= 0.5) == r.label for r in got]) > 0.97


def test_hard_rows(spark):
    docs = spark.createDataFrame([(None, "x", 1), (1, None, 1), (2, "", 1), (3, "bad bad", 2), (3, "bad bad", 2), (4, "good", 3), (5, "w" * 300_000 + " bad", 4)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (None, 1), (1, None), (77, 1)], "doc_id long, label int")
    w = toxicity.train(labels, docs)
    got = toxicity.score(docs, w).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] and by[3] >= by[4]
    assert toxicity.train(labels.filter("false"), docs) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.5}
    ones = toxicity.train(labels.filter("label = 1"), docs)
    assert not ones[:-1].any() and ones[-1] >= 0
    assert toxicity.score(docs.filter("false"), w).count() == 0
    assert toxicity.score(docs, w, keep=("doc_id", "text"), name="toxic").columns == ["doc_id", "text", "toxic"]
