"""Near-duplicates of the pipeline against brute force over sets of shingles."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import corpus_pipeline
from pulsegrid.llm import jaccard, simhash


def brute(rows, least=0.8):
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    ids, root = sorted(sets), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a == b or len(a & b) >= least * len(a | b) > 0:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {find(i) for i in ids}


@pytest.mark.parametrize("crowd", [2000, 8])
def test_similarity_of_four_fifths(spark, monkeypatch, crowd):
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    rng, texts = np.random.default_rng(8), [None, " \n", "x", "X", "a b c d", "a b c e"]
    for _ in range(40):
        w = [f"w{i}" for i in rng.integers(0, 4000, int(rng.integers(30, 300)))]
        texts.append(" ".join(w))
        for _ in range(2):  # similarities around 0.8
            v, n = list(w), int(len(w) * rng.uniform(0.0, 0.04))
            for i in rng.integers(0, len(w), n).tolist():
                v[i] = "new" + str(int(rng.integers(1_000_000)))
            texts.append(" ".join(v).upper())
    base = [f"b{i}" for i in range(100)]
    texts += [" ".join([*base[:i], f"z{i}", *base[i + 1 :]]) for i in range(60)]  # a large group of near copies
    rows = list(enumerate(texts))
    df = spark.createDataFrame([*rows, rows[6], (None, "x")], "doc_id long, text string")
    got = corpus_pipeline.drop_near_duplicates(spark, df, "").collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(brute(rows)) and len(got) == len(brute(rows)) + 1
    assert jaccard.keep_one(df.limit(0)).count() == 0


def test_rows_of_one_key_are_documents_of_their_own(spark):
    texts = ["one text about ships and their harbours in the north", "another text about the growing of apples", "a third one on clocks and on the people who mend them"]
    rows = [(1, texts[0], "a"), (1, texts[1], "b"), (2, texts[2], "c"), (2, texts[2], "c"), (3, texts[0].upper(), "d"), (3, texts[0], "e"), (None, texts[0], "f"), (None, texts[0], "f"), (None, None, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash string").withColumnsRenamed({"hash": "fp"})
    for keep in (jaccard.keep_one, simhash.keep_one):
        got = keep(df)
        assert got.columns == df.columns
        assert sorted((r.doc_id or 0, r.fp) for r in got.collect()) == [(0, "f"), (0, "g"), (1, "a"), (1, "b"), (2, "c")]
        again = keep(df.orderBy("fp", ascending=False).repartition(3)).collect()
        assert sorted((r.doc_id or 0, r.fp) for r in again) == [(0, "f"), (0, "g"), (1, "a"), (1, "b"), (2, "c")]


@pytest.mark.parametrize("unit", [1, 20])
def test_large_sets_are_cut_into_blocks(spark, monkeypatch, unit):
    monkeypatch.setattr(jaccard, "UNIT", unit)
    monkeypatch.setattr(jaccard, "CROWD", 60)
    base = [f"b{i}" for i in range(200)]
    rows = list(enumerate([" ".join([*base[:i], f"z{i}", *base[i + 1 :]]) for i in range(0, 200, 5)] + ["something else altogether"]))
    got = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == sorted(brute(rows))
