"""Null keys, very long vectors, and threads, where no other test has them."""

import threading

import numpy as np
from pyspark.sql import functions as F

from pulsegrid.llm import knn, quality, session, simhash, substrings

KIND = "doc_id long, text string"


def test_null_keys_of_fingerprints(spark):
    texts = ["a b c d e f g", "A B C D E F G", None, "x y z"]
    df = spark.createDataFrame([(None, texts[0]), (7, texts[1]), (None, texts[3]), (None, texts[2])], KIND)
    got = {(r.doc_id, r.component_id) for r in simhash.classes(simhash.fingerprints(df)).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}  # a null key counts as larger than any other


def test_null_keys_of_texts_with_repeats(spark):
    run = " ".join(f"r{i}" for i in range(40))
    df = spark.createDataFrame([(None, f"a {run} b"), (None, f"c {run}"), (5, f"{run} d"), (None, None), (None, "short")], KIND)
    got = sorted((tuple(r) for r in substrings.remove_repeats(df).select("doc_id", "n_words", "n_removed", "kept").collect()), key=str)
    assert got == sorted([(None, 42, 40, "a b"), (None, 41, 40, "c"), (5, 41, 40, "d"), (None, 0, 0, ""), (None, 1, 0, "short")], key=str)


def test_null_keys_of_scored_texts(spark):
    docs = spark.createDataFrame([(None, "good words"), (1, "good words"), (2, "bad ### !!"), (None, None)], KIND)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, label int")
    got = quality.score(docs, quality.train(labels, docs)).collect()
    assert len(got) == 4 and len({r.score for r in got if r.doc_id is None}) == 2
    assert next(r.score for r in got if r.doc_id == 1) in {r.score for r in got if r.doc_id is None}


def test_very_long_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 6000)).round(2)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in knn.top_k(df, F.col("id") % 50 == 0).collect())
    n = np.floor(256 * x).astype(np.int64)
    want = []
    for q in (0, 50):
        best = sorted((-int(n[q] @ n[i]), i) for i in range(60) if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_scopes_of_threads_are_apart(spark):
    kept, go, done = {}, threading.Event(), threading.Event()

    def other():
        with session.passing(spark):
            kept["other"] = session.written(spark.range(5))
            go.set()
            done.wait(60)
            kept["n"] = kept["other"].count()

    t = threading.Thread(target=other)
    t.start()
    assert go.wait(120)
    with session.passing(spark):
        assert session.written(spark.range(3)).count() == 3
    done.set()
    t.join(120)
    assert kept["n"] == 5
