"""The queries of the two classifiers against versions in plain Python: features, weights by the same learner, scores; and
conversations of very many turns."""

import math
import re
import time
import zlib

import numpy as np
from conftest import DATA
from pyspark.sql import functions as F

from pulsegrid.llm import chat, ftrl, language_id, quality

M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def rows_of(spark, table, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(*columns).collect()]


def order(rows):
    return sorted(rows, key=lambda r: (len(r[1]), r[0], r[1].tobytes(), r[2].tobytes()))


def arrays(y, feats):
    idx = sorted(feats)
    return y, np.array(idx, np.uint32), np.array([feats[i] for i in idx], np.float32)


# language: character 1- to 3-grams, TF-IDF, temperature


def grams(text, bits):
    out, c = {}, " " + text.lower() + " "
    for k in (1, 2, 3):
        for i in range(len(c) - k + 1):
            h = k * 0x9E3779B1 & M32
            for x in c[i : i + k]:
                h = h + ord(x) * 0x27D4EB2F & M32
                h = h * 0x85EBCA6B & M32
                h ^= h >> 15
                h = h * 0xC2B2AE35 & M32
                h ^= h >> 13
            out[h >> (32 - bits)] = out.get(h >> (32 - bits), 0) + 1
    return out


def softmax(z, t=1.0):
    e = [math.exp((x - max(z)) / t) for x in z]
    return [x / sum(e) for x in e]


def test_language_query_against_plain(spark):
    cfg = ftrl.Ftrl()
    docs = rows_of(spark, "documents", "doc_id", "text", "lang")
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, *_ in docs}
    learn = [(i, t, lang) for i, t, lang in docs if not held[i] and t is not None and lang is not None]
    languages = sorted({lang for *_, lang in learn})
    counts = {i: grams(t, cfg.bits) for i, t, _ in docs if t}
    counts |= {i: grams("", cfg.bits) for i, t, _ in learn if not t}
    df = {}
    for i, *_ in learn:
        for g in counts[i]:
            df[g] = df.get(g, 0) + 1
    top = max(df.values())
    idf = lambda g: float(np.float32(math.log((1 + top) / (1 + df.get(g, 0))) + 1))

    def tfidf(c):
        v = {g: (1 + math.log(n)) * idf(g) for g, n in c.items()}
        size = max(math.sqrt(sum(x * x for x in v.values())), 1e-12)
        return {g: x / size for g, x in v.items()}

    keyed = spark.createDataFrame([(i,) for i, *_ in learn], "key long")
    shard = {r.key: r.shard for r in ftrl.sampled(keyed, cfg, "key", 11, holdout=6).collect()}  # who is left out is the sampler's choice
    assert set(shard.values()) == {-1, 0}
    y = {i: languages.index(lang) for i, _, lang in learn}
    w = ftrl._fit_shard(order([arrays(y[i], tfidf(counts[i])) for i in shard if shard[i] == 0]), len(languages), cfg).astype(np.float32)
    scores = lambda i: [float(w[-1][k]) + sum(x * float(w[g][k]) for g, x in tfidf(counts[i]).items()) for k in range(len(languages))]
    kept = [(y[i], scores(i)) for i in shard if shard[i] == -1]
    loss = {t: sum(-math.log(max(softmax(z, t)[k], 1e-300)) for k, z in kept) for t in language_id.TEMPERATURES}
    best = min(loss, key=lambda t: (loss[t], t))
    for r in language_id.op2_language_id(spark, DATA).collect():
        text = next(t for i, t, _ in docs if i == r.doc_id)
        if not re.search(r"[^\W\d_]", text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        p = softmax(scores(r.doc_id), best)
        assert r.held_out == held[r.doc_id] and r.lang_pred == languages[p.index(max(p))] and abs(r.score - max(p)) < 2e-3


def test_tie_of_languages(spark):
    df = spark.createDataFrame([(i, "same words here", x) for i, x in enumerate("ba" * 30)], "doc_id long, text string, lang string")
    got = language_id.predict(df.limit(3), language_id.LanguageModel(["a", "b"], np.zeros(((1 << 8) + 1, 2), np.float32), np.ones(1 << 8, np.float32), 8)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("a", 0.5)}  # the first by name


# quality: hashed word n-grams, shapes and repeats


def mix(x):
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ x >> 33) * m & M64
    return x ^ x >> 33


def word_hash(raw):
    h, p = 0, 1
    for c in raw:
        h, p = (h + (c + 1) * p) & M64, p * 0x9E3779B97F4A7C15 & M64
    return mix((h + len(raw)) & M64)


def shape(raw):
    if not re.match(rb"[0-9A-Za-z\x80-\xff]", raw):
        return 0
    up, low = len(re.findall(rb"[A-Z]", raw)), len(re.findall(rb"[a-z]", raw))
    if not up:
        return 1 if low else 2
    return 3 if low else 4 if len(raw) == 1 else 5


def quality_features(text, bits):
    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\x20\x09-\x0d0-9A-Za-z\x80-\xff]+", text.encode())
    h, s = [word_hash(t) for t in tokens], [shape(t) for t in tokens]
    out = [mix(x) for x in h] + [mix(a * 3 + b * 5 & M64) for a, b in zip(h, h[1:], strict=False)] + [mix(x + 100) for x in s]
    out += [mix(a * 64 + b * 8 + (x == y) + 1000) for a, b, x, y in zip(s, s[1:], h, h[1:], strict=False)]
    out += [mix(1 + 200) for x, y in zip(h, h[1:], strict=False) if x == y] + [mix(1 + 300) for x, y in zip(h, h[2:], strict=False) if x == y]
    n = {}
    for x in out:
        n[x >> (64 - bits)] = n.get(x >> (64 - bits), 0) + 1
    v = {k: 1 + math.log(c) for k, c in n.items()}
    size = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / size for k, x in v.items()}


def test_quality_query_against_plain(spark):
    cfg = quality.CONFIG
    docs = dict(rows_of(spark, "documents", "doc_id", "text"))
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    labels = {i: y for i, y in rows_of(spark, "labels", "doc_id", "quality") if not held[i]}
    feats = {i: quality_features(t or "", cfg.bits) for i, t in docs.items()}
    w = ftrl._fit_shard(order([arrays(y, feats[i]) for i, y in labels.items()]), 1, cfg)[:, 0].astype(np.float32)
    for r in quality.op4_quality(spark, DATA).collect():
        z = float(w[-1]) + sum(x * float(w[k]) for k, x in feats[r.doc_id].items())
        assert r.held_out == held[r.doc_id] and abs(r.score - 1 / (1 + math.exp(-z))) < 1e-4 and r.predicted == (r.score >= 0.3)


# chat


def test_very_many_turns(spark):
    n = 30_000
    m = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("### turn 😀 "), F.col("id").cast("string"), F.lit(" </turn> "), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int"))).alias("text"))
    began = time.time()
    done = chat.format_chats(m.withColumn("parts", chat.text_part(F.col("text"))))
    r = done.select(chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.size(chat.read_turns(F.col("formatted"))).alias("n")).first()
    assert r.n == n and r.loss == "".join(f"### turn 😀 {i} </turn> " + "x" * (i % 90) for i in range(1, n, 2))
    assert time.time() - began < 60
