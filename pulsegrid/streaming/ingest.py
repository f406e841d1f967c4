"""Continuous counterparts of the batch loads, with Structured Streaming.

Page-view exports land as files; each micro-batch replaces the rows of the files it holds, as the batch
pipeline does, so that a repeated batch changes nothing.  Views can also be counted per window while they arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.plans import jobs
from pulsegrid.sources import sinks


def stream_exports(spark: SparkSession, source: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New CSV files under `source`, as a stream of strings with source_file."""
    options = {"header": True, "multiLine": True, "escape": '"', "maxFilesPerTrigger": files_per_batch}
    return spark.readStream.schema(schema).options(**options).csv(source).withColumn("source_file", F.col("_metadata.file_name"))


def ingest(views: DataFrame, target: str, checkpoint: str, hr: DataFrame | None = None, once: bool = True) -> StreamingQuery:
    """Keeps fact_page_view under `target` up to date."""

    def upsert(batch: DataFrame, _: int) -> None:
        sinks.upsert_by_source_file(jobs.build(batch, hr)[0], f"{target}/fact_page_view")

    writer = views.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def views_per_window(views: DataFrame, ts: str = "timestamp", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Views and (approximate) visitors by site and window; rows later than `late` are left out."""
    v = views.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return v.groupBy(F.window(ts, window).alias("w"), "site_id").agg(F.count("*").alias("views"), F.approx_count_distinct("user_id").alias("visitors")).select(F.col("w.start").alias("start"), "site_id", "views", "visitors")
