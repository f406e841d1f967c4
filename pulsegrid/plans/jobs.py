"""The batch pipeline: exports of page views to a star schema, by changed files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import flatten, star
from pulsegrid.sources import exports, sinks

FACT = (
    "view_id", "timestamp", "page_id", "user_id", "session_id", "load_ms", "ref_uri", "client_os", "client_browser", "client_country", "email", "gpn",
    "tracking_id", "pack_id", "cluster", "pack", "activity_date", "activity", "channel", "source_file",
)
PAGE = ("page_name", "page_url", "site_id", "site_name", "content_owner", "content_type", "theme", "topic", "target_region", "target_org", "page_status", "publishing_date")
MANIFEST = "file_name string, sha256 string, row_count long, processed_at timestamp"


def build(raw: DataFrame, hr: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Raw export rows (with source_file) to the fact, the pages and the dates that they hold."""
    flat = flatten.flatten_props(raw.withColumn("props", flatten.parse_custom_dimensions("customDimensions")).drop("customDimensions"), [f"cp_{p}" for p in flatten.PAGE_PROPERTIES])
    clean = flatten.clean_page_views(flat)
    clean = clean.withColumns({c: F.lit(None).cast("string") for c in FACT if c not in clean.columns})
    fact = star.fact_page_view(clean.select(*FACT), hr, ts="timestamp") if hr is None else star.join_hr_asof(star.time_on_page(clean.select(*FACT), ts="timestamp"), hr, ts="timestamp")
    return fact, star.dim_page(clean.filter("page_id IS NOT NULL"), PAGE, ts="timestamp"), star.dim_date(clean, "timestamp")


def run(spark: SparkSession, source: str, target: str, hr: DataFrame | None = None, full_refresh: bool = False) -> dict[str, DataFrame]:
    """Brings the tables under `target` up to date with the CSV files under `source` and returns them.

    source is a folder or one file.  A file is read when its content is new or changed, or always with full_refresh; its rows
    replace those of the same file name.  Pages and dates are only added to, earlier files first.  Sessions are
    rebuilt over all files.  The manifest comes last, so that a run that was cut short is done again as a whole."""
    at = lambda name: f"{target}/{name}"
    have = sinks.exists(spark, at("processed_files"), recover=True) and not full_refresh
    manifest = spark.read.parquet(at("processed_files")) if have else spark.createDataFrame([], MANIFEST)
    files = exports.classify_input_files(exports.file_hashes(spark, source), manifest)
    todo = {r.file_name: r for r in files.filter("status <> 'unchanged'").collect()}  # names of input files only
    if todo:
        fact, pages, dates = build(exports.read_page_view_export(spark, *(todo[name].path for name in sorted(todo)), splittable={r.path for r in todo.values() if r.splittable}), hr)
        if full_refresh:
            sinks.rebuild(fact, at("fact_page_view"), ("source_file",))
        else:
            sinks.upsert_by_source_file(fact, at("fact_page_view"), tuple(todo))
        for name, new, key in (("dim_page", pages, "page_id"), ("dim_date", dates, "date_key")):
            old = spark.read.parquet(at(name)) if sinks.exists(spark, at(name), recover=True) and not full_refresh else new.limit(0)
            sinks.rebuild(sinks.append_new_keys(old, new, key), at(name))
        stored = spark.read.parquet(at("fact_page_view"))
        counts = stored.groupBy(F.col("source_file").cast("string").alias("file_name")).agg(F.count("*").alias("row_count"))
        sinks.rebuild(star.agg_session(stored, ts="timestamp", first=("user_id", "gpn", "email", "client_country", "client_os", "client_browser")), at("agg_session"))
        done = files.filter("status <> 'unchanged'").join(counts, "file_name", "left").select("file_name", "sha256", F.coalesce("row_count", F.lit(0)).alias("row_count"), F.current_timestamp().alias("processed_at"))
        sinks.rebuild(sinks.record_processed(manifest, done), at("processed_files"))
    return {n: spark.read.parquet(at(n)) for n in ("fact_page_view", "dim_page", "dim_date", "agg_session", "processed_files")}
