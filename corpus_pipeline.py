"""From raw documents to a training mix, in stages that each write a table.

1. quality: documents that the classifier rejects go.
2. near_duplicates: of each class of neighbours (sets of five-word shingles with a Jaccard similarity of 0.8
   or more, found by SimHash and a second signature) the document with the least doc_id stays.
3. decontamination: documents that hold a benchmark item go.
4. secrets: secrets in texts are replaced by a mark; no document goes.
5. mixing: documents by source, repeated at most three times, up to the sum of all words.

Every stage reads what the one before has written, and all of it; the stages are the operators of
pulsegrid.llm, which define what happens to nulls, empty texts, repeated rows and empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, jaccard, mixing, quality, secrets
from pulsegrid.llm.session import passing, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    return quality.keep_good(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.clean(docs, secrets.train(secrets.samples(docs)), length="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: A trained classifier and sets of shingles decide, which SQL cannot express; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        with passing(spark):
            docs = written(stage(spark, docs, sf_dir), lasting=True)
    return docs
