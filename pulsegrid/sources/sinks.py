"""Writing tables: upserts by file or key, first-writer-wins merges, snapshots and exports.

Folders are Parquet tables.  Whatever reads a table that it also replaces writes to a folder beside it first
and swaps.  While a swap lasts, the table before it stays beside the new one under the name `<table>.before`; a swap
that was cut short is undone when the table is next looked for or replaced, so that no table is lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """A rename that did not happen is an error."""
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise OSError(f"{source} could not be renamed to {target}")


def _recover(spark: SparkSession, path: str) -> None:
    """Brings back the table of a swap that was cut short, or clears up after one that was not.  For the table's writer, of
    which there is one at a time: during a swap a reader must leave both folders alone."""
    fs, target = _fs(spark, path)
    before = _fs(spark, f"{path}.before")[1]
    if fs.exists(before):
        if fs.exists(target):
            fs.delete(before, True)
        else:
            _rename(spark, f"{path}.before", path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write inside drops its shuffle files when it is over; they would stay on the executors' disks until the driver collects
    its garbage, and a run of many steps would hold those of all steps."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """df as written to a folder, which is there for as long as it is used: what several steps read is computed once."""
    spark = df.sparkSession
    df = df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "void"})
    with shuffles_dropped(spark):
        df.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def exists(spark: SparkSession, path: str, recover: bool = False) -> bool:
    """Whether there is a table.  Only the table's writer may recover a swap that was cut short; a reader finds the old
    table under `<table>.before` meanwhile (see current)."""
    if recover:
        _recover(spark, path)
    fs, p = _fs(spark, path)
    return fs.exists(p)


def current(spark: SparkSession, path: str) -> str:
    """Where a reader finds the table: in its place, or set aside while a swap lasts."""
    return path if exists(spark, path) or not exists(spark, f"{path}.before") else f"{path}.before"


def rebuild_with(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Replaces a table: `write` fills a folder beside it, the old one is set aside, the new one moved in, and the old one dropped.
    If the new one cannot be moved in, the old one comes back."""
    stage = f"{path}.{uuid.uuid4().hex}"
    write(stage)
    _recover(spark, path)
    fs, target = _fs(spark, path)
    if fs.exists(target):
        _rename(spark, path, f"{path}.before")
    try:
        if fs.exists(target):  # a rename would move the new folder into it
            raise OSError(f"another writer has made {path} meanwhile")
        _rename(spark, stage, path)
    except Exception:
        if not fs.exists(target):
            _recover(spark, path)
        raise
    fs.delete(_fs(spark, f"{path}.before")[1], True)


def rebuild(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replaces a table by a DataFrame, which may read it."""
    rebuild_with(df.sparkSession, path, lambda stage: df.write.partitionBy(*partition_by).parquet(stage))


def upsert_by_source_file(fact: DataFrame, path: str, files: tuple[str, ...] = ()) -> None:
    """Replaces the rows of each source file in `fact`; the other files' partitions stay as they are.

    files: the names of all files that were read; what is stored of one without rows by now goes."""
    spark = fact.sparkSession
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for name in files:
        fs, p = _fs(spark, f"{path}/source_file={escaped(name)}")
        fs.delete(p, True)
    fact.write.partitionBy("source_file").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def append_new_keys(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """existing plus rows of unseen keys, one for each; the first writer wins, and a null key is kept once."""
    unseen = incoming.join(existing.select(F.col(key).alias("__k")).distinct(), F.col(key).eqNullSafe(F.col("__k")), "left_anti")
    return existing.unionByName(unseen.dropDuplicates([key]))


def merge_upsert(target: DataFrame, updates: DataFrame, key: str | list[str]) -> DataFrame:
    """target with the rows of `updates` in place of, or besides, its own."""
    return target.join(updates, key, "left_anti").select(*target.columns).unionByName(updates)


def record_processed(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """The manifest (file_name, sha256, row_count, processed_at) with these files in place of older entries."""
    return merge_upsert(manifest, files, "file_name")


def snapshot_replace(df: DataFrame, path: str) -> None:
    """A daily snapshot: what is gone from the source goes."""
    rebuild(df, path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_star_schema(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        rebuild(df, f"{folder}/{name}", ("source_file",) if name == "fact_page_view" else ())


def weighted_sample(df: DataFrame, key: str, order: Column, cap: int = 200) -> DataFrame:
    """At most `cap` rows of each key, by a given order, with `weight`: the rows that each stands for."""
    n = df.groupBy(key).agg(F.count("*").alias("__n"))
    picked = df.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter(F.col("__r") <= cap)
    return picked.join(n, key).withColumn("weight", F.col("__n") / F.least(F.col("__n"), F.lit(cap))).drop("__r", "__n")


def dashboard_arrays(packs: DataFrame, mail: DataFrame, views: DataFrame, registrations: DataFrame) -> dict[str, DataFrame]:
    """The four datasets of a dashboard: packs, and counts by (pack, event or status, day) of each channel.  mail (pack_id,
    event, day), views (pack_id, day) and registrations (pack_id, status, day) are rows of facts."""
    count = lambda df, *by: df.groupBy("pack_id", *by, "day").agg(F.count("*").alias("n"))
    return {"packs": packs, "email_events": count(mail, "event"), "page_views": count(views), "event_regs": count(registrations, "status")}


def export_dashboard(arrays: dict[str, DataFrame], folder: str) -> None:
    for name, df in arrays.items():
        df.write.mode("overwrite").json(f"{folder}/{name}")


def write_profile(results: dict[str, DataFrame], folder: str) -> None:
    """Discovery results as JSON, without sample values."""
    for name, df in results.items():
        df.drop("samples").write.mode("overwrite").json(f"{folder}/{name}")
