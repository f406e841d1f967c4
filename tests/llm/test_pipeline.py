"""The pipeline, stage by stage, against plain versions on its own inputs."""

import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from conftest import DATA
from test_jaccard import brute
from test_llm import DOC, brute_spans

import corpus_pipeline
from pulsegrid.llm import quality, session
from pulsegrid.llm.session import written


def plain(rows):
    return sorted(tuple(r) for r in rows)


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, DATA))
        seen[name] = ({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()})
        assert name == "mixing" or out.columns == columns
        assert len(seen[name][1]) == out.count()
        docs = out

    before, after = seen["quality"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    raw = spark.read.parquet(f"{DATA}/documents.parquet")
    scores = {r.doc_id: r.score for r in quality.score(raw, quality.train(labels, raw)).collect()}
    assert set(after) == {i for i in before if scores[i] >= 0.3} and all(after[i] == before[i] for i in after)

    before, after = seen["near_duplicates"]
    assert set(after) == brute([(i, r.text) for i, r in before.items()]) and all(after[i] == before[i] for i in after)

    before, after = seen["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert set(after) == {i for i, r in before.items() if not any(x in r.text for x in items)}

    before, after = seen["secrets"]
    assert set(after) == set(before)
    for i, r in after.items():
        spans = brute_spans(before[i].text)
        assert bool(spans) <= ("[SECRET]" in r.text)
        assert all(before[i].text[a:b] not in r.text for _, a, b in spans)
        assert r == before[i] if not spans and "[SECRET]" not in r.text else r.n_chars == len(r.text)

    before, after = seen["mixing"]
    total = sum(len((r.text or "").split()) for r in before.values())
    assert 0 < sum(r.taken for r in after.values()) <= total
    assert all(r.taken == r["size"] * r.copies and 1 <= r.copies <= 3 and r.text == before[i].text for i, r in after.items())


def test_run_and_empty(spark, tmp_path):
    folder = Path(session._tables(spark).removeprefix("file:"))
    before = {*folder.iterdir()} if folder.exists() else set()
    assert corpus_pipeline.run(spark, DATA).count() > 0
    assert len({*folder.iterdir()} - before) == len(corpus_pipeline.STAGES)  # only the stages' results stay
    spark.createDataFrame([], DOC).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_hard_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and more columns go through all stages."""
    rows = [(None, None, None, None, None), (1, None, "en", None, 0), (2, "", None, "s", None), (3, "w " * 150_000, "en", "s", 300_000), (4, "the same words here again", "en", "s", 25), (4, "the same words here again", "en", "s", 25), (None, "the same words here again", None, "s", 25)]
    more = {c: F.lit("clash") for c in ("size", "target", "taken", "copies", "spans", "base_spans", "score", "fp", "bands", "component_id", "__row", "__id")}
    spark.createDataFrame(rows, DOC).withColumns(more).write.parquet(str(tmp_path / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, str(tmp_path)))
        assert name == "mixing" or out.columns == docs.columns, name
        assert {r["__id"] for r in out.collect()} <= {"clash"} and out.count() > 0
        docs = out
