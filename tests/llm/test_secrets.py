"""The Markov models on one text, trained on corpora of several sizes."""

import math
import re
import sys
import time
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from conftest import DATA
from test_llm import brute_spans, docs

from pulsegrid.llm import secrets

ORDINARY = ["order_2024_11_28_batch_0017", "customer_account_2024_0017", "image_20240117_123456_thumbnail", "ISBN-978-3-16-148410-0-a", "/blog/2023/05/17/release-notes-1042"]
RANDOM = ["9fX2kLmQ7vTz81NbWcR4q", "Zk3vQ9xTfB7mWq2LrY8dNs5H", "qP7/xW2+Lk9ZrT4vBn6YsD1m", "a8Xv0Qz5RtK3wYp7LcJ2"]


def test_ratios_do_not_grow_with_the_corpus(spark):
    probe = spark.createDataFrame([(x,) for x in ORDINARY + RANDOM], "x string")
    seen = []
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        table = secrets.train(secrets.samples(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")))
        seen.append({r.x: r.r for r in probe.select("x", secrets.ratio(F.col("x"), table).alias("r")).collect()})
        found = secrets.scan(docs(spark, " and ".join(ORDINARY + RANDOM)), table).first()
        text = found.text
        assert [text[s.start : s.end] for s in found.spans] == RANDOM, seen
    assert all(abs(seen[2][x] - seen[1][x]) < 0.5 for x in ORDINARY + RANDOM), seen


def brute_table(rows):
    """The models once more: counts of pairs, shares with back-off, log ratios."""
    k, at = len(secrets.ALPHABET) + 1, lambda c: secrets.ALPHABET.find(c) + 1
    logs = {}
    for kind in (True, False):
        n = Counter((at(t[i]), at(t[i + 1])) for t, random in rows if random == kind for i in range(len(t) - 1))
        share = lambda row, other: [(x / sum(row) + secrets.BACK_OFF * o) / (1 + secrets.BACK_OFF) if sum(row) else o for x, o in zip(row, other, strict=True)]
        single = share([sum(n[a, b] for a in range(k)) for b in range(k)], [1 / k] * k)
        logs[kind] = [[math.log(x) for x in share([n[a, b] for b in range(k)], single)] for a in range(k)]
    return [round(p - q, 6) for a in range(k) for p, q in zip(logs[True][a], logs[False][a], strict=True)]


def brute_markov(text, table):
    k, at = len(secrets.ALPHABET) + 1, lambda c: secrets.ALPHABET.find(c) + 1
    base, out = brute_spans(text), []
    for m in re.finditer(secrets.CANDIDATE, text):
        t = m[0]
        mean = sum(table[at(a) * k + at(b)] for a, b in zip(t, t[1:], strict=False)) / (len(t) - 1)
        held = any(a <= m.start() and m.end() <= e for _, a, e in base)
        if not held and mean * min(1, (len(t) - 1) / (secrets.SURE - 1)) >= secrets.RATIO:
            out.append(("markov", m.start(), m.end()))
    return sorted([*base, *out], key=lambda s: (s[1], [*(p[0] for p in secrets.PATTERNS), "markov"].index(s[0])))


def brute_redacted(text, spans):
    gone, at, out = [], 0, ""
    for _, a, e in spans:
        if gone and a < gone[-1][1]:
            gone[-1][1] = max(gone[-1][1], e)
        else:
            gone.append([a, e])
    for a, e in gone:
        out, at = out + text[at:a] + "[SECRET]", e
    return out + text[at:]


def test_markov_spans_against_brute_force(spark):
    raw = spark.read.parquet(f"{DATA}/documents.parquet")
    samples = secrets.samples(raw)
    table = secrets.train(samples)
    assert max(abs(a - b) for a, b in zip(table, brute_table([tuple(r) for r in samples.select("token", "is_random").collect()]), strict=True)) < 2e-6
    key = "9fX2kLmQ7vTz81NbWcR4q"
    more = [f"{key}={key} " * 3, f"é😀 {key}\n{'0123456789abcdef' * 2}{key}", f"token={key}", f"AKIA{'Z' * 16}{key}", "x" * 5000 + f" {key} " + "y" * 9000, "Zk3vQ9xTfB7mWq2L qzxvkwjqpfzxwvkq", ""]
    texts = [*(r.text or "" for r in raw.collect()), *more]
    got = secrets.scan(docs(spark, *texts), table).withColumn("clean", secrets.redacted(F.col("text"), F.col("spans"))).orderBy("doc_id").collect()
    for t, r in zip(texts, got, strict=True):
        want = brute_markov(t, table)
        assert [(s.kind, s.start, s.end) for s in r.spans] == want
        assert r.clean == brute_redacted(t, want)


def test_thousands_of_matches_and_clashing_columns(spark):
    text = "password=abcdefghijkl0 and 9fX2kLmQ7vTz81NbWcR4q\n" * 30_000
    table = secrets.train(secrets.samples(spark.read.parquet(f"{DATA}/documents.parquet")))
    df = docs(spark, text, None).withColumns({"spans": F.lit("mine"), "Base_Spans": F.lit(7), "n_chars": F.lit(-1).cast("long")})
    began = time.time()
    out = secrets.clean(df, table, length="n_chars")
    assert out.columns == df.columns
    one, none = out.orderBy("doc_id").collect()
    assert one.text == "[SECRET] and [SECRET]\n" * 30_000 and one.spans == "mine" and one["Base_Spans"] == 7 and one.n_chars == len(one.text)
    assert none.text is None and none.n_chars == -1
    assert time.time() - began < 120
    assert secrets.scan(df, table).columns == [*(c for c in df.columns if c.lower() not in ("spans", "base_spans")), "base_spans", "spans"]
