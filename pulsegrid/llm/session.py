"""The shared folder for data that must outlive an executor."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only where none is set, as in tests, a new local one, which a cluster could not share."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def _tables(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


_within: dict[int, list[str]] = {}  # by thread, folders of the runs of `passing` that are open; tasks get this module by value, so that it is plain


def _drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_written(spark: SparkSession) -> None:
    """Deletes what `written` has left for this application; call it when its results are no longer needed."""
    _drop(spark, _tables(spark))


def _folder(spark: SparkSession) -> str:
    return "/".join([_tables(spark), *_within.get(get_ident(), [])])


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What `written` writes inside goes at the end; results that read it must be written, as lasting, before."""
    open_ = _within.setdefault(get_ident(), [])
    open_.append(uuid.uuid4().hex)
    try:
        yield
    finally:
        _drop(spark, _folder(spark))
        open_.pop()


def written(df: DataFrame, lasting: bool = False) -> DataFrame:
    """Writes df to the shared folder and reads it back: a cut of the lineage that any executor can read."""
    spark = df.sparkSession
    path = f"{_tables(spark) if lasting else _folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
