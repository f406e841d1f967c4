"""Reading telemetry exports and modelled tables."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

EXPORT_COLUMNS = (
    "timestamp [UTC]", "id", "name", "url", "duration", "performanceBucket", "itemType", "customDimensions", "operation_Name", "operation_Id", "operation_ParentId", "session_Id", "user_Id",
    "client_Type", "client_Model", "client_OS", "client_City", "client_StateOrProvince", "client_CountryOrRegion", "client_Browser", "appId", "appName", "iKey", "sdkVersion", "itemCount",
)
# The organisation fields of a raw HR snapshot, and their names in the model.
HR_NAMES = {
    "gcrs_division_desc": "division", "gcrs_unit_desc": "unit", "gcrs_area_desc": "area", "gcrs_sector_desc": "sector", "gcrs_segment_desc": "segment", "work_location_country": "country",
    "work_location_region": "region", "job_title": "job_title", "management_level": "management_level",
}


def _header(spark: SparkSession, path: str) -> str:
    """The first line of a file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    opened = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(opened, "UTF-8")).readLine() or ""
    finally:
        opened.close()


def read_page_view_export(spark: SparkSession, *paths: str, splittable: Collection[str] = ()) -> DataFrame:
    """CSV exports (files) as strings, with source_file and source_time, the time of the file.  Columns may differ from file to
    file: files with the same first line are read together, one reader for each kind of header.

    splittable: those of the files without a line break inside a cell, as file_hashes finds them.  Many tasks read such a file;
    one with line breaks inside cells is read by one task, as a reader that begins within it could not tell them from ends of
    rows."""
    kinds: dict[tuple[str, bool], list[str]] = {}
    for p in paths:
        kinds.setdefault((_header(spark, p), p in splittable), []).append(p)
    named = {"source_file": F.col("_metadata.file_name"), "source_time": F.col("_metadata.file_modification_time")}
    read = [spark.read.options(header=True, multiLine=not split, escape='"').csv(same).withColumns(named) for (_, split), same in kinds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


def file_hashes(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """(file_name, path, sha256, splittable) of the files of a folder, or of one file.  A file is splittable if each of its lines has
    an even number of quotes, so that no cell runs over the end of a line.

    One way at every size: tasks read lines (split at line feeds only) and hash each; a split of a file gives the sums of its
    hashes and of hash times line number, so that exchanged lines differ; splits are shifted to their place by the numbers of
    lines before them, and a file's sums, size and number of lines are hashed.  So the hash does not depend on how a file
    was split, and no file has to fit a task.  A file without a byte is no export and is not listed.  A line's hash is 80 bits of its SHA-256, in two halves."""
    named = [F.col("_metadata.file_path").alias("file")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", *named)
    lines = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
    digest = F.sha2(F.col("value").cast("binary"), 256)
    halves = [F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 10).cast("decimal(38,0)") for i in (0, 1)]
    place = F.monotonically_increasing_id()  # lines of a split are consecutive
    each = lines.select(*named, F.col("_metadata.file_block_start").alias("start"), place.alias("place"), (F.regexp_count("value", F.lit('"')) % 2 == 1).alias("odd"), *(h.alias(f"h{i}") for i, h in enumerate(halves)))
    sums = [a for i in (0, 1) for a in (F.sum(f"h{i}").alias(f"s{i}"), F.sum(F.col(f"h{i}") * (F.col("place") % (1 << 33)).cast("decimal(11,0)")).alias(f"p{i}"))]
    splits = each.groupBy("file", "start").agg(F.count("*").alias("n"), F.count_if("odd").alias("odd"), (F.min("place") % (1 << 33)).cast("decimal(38,0)").alias("first"), *sums)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a split
    splits = splits.withColumn("shift", (before - F.col("first")).cast("decimal(38,0)"))
    moved = lambda i: F.sum((F.col(f"p{i}") + F.col("shift") * F.col(f"s{i}")).cast("decimal(38,0)"))
    whole = splits.groupBy("file").agg(F.sum("n").alias("lines"), F.sum("odd").alias("odd"), *(F.sum(f"s{i}").alias(f"s{i}") for i in (0, 1)), *(moved(i).alias(f"p{i}") for i in (0, 1)))
    parts = ["length", "lines", "s0", "s1", "p0", "p1"]
    sha = F.sha2(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in parts)), 256)
    return files.join(whole, "file", "left").select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path", sha.alias("sha256"), (F.coalesce("odd", F.lit(0)) == 0).alias("splittable"))


def classify_input_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """files (file_name, sha256, ..) plus status new, changed or unchanged, by name against the manifest."""
    known = manifest.select("file_name", F.col("sha256").alias("known"))
    status = F.when(F.col("known").isNull(), "new").when(F.col("known") != F.col("sha256"), "changed").otherwise("unchanged")
    return files.join(known, "file_name", "left").withColumn("status", status).drop("known")


def read_hr_history(spark: SparkSession, path: str) -> DataFrame:
    """Monthly snapshots: gpn, snapshot_year, snapshot_month and those organisation fields that are there, by their names
    in a raw snapshot or in the model."""
    df = spark.read.parquet(path)
    have = {n: raw if raw in df.columns else n for raw, n in HR_NAMES.items() if raw in df.columns or n in df.columns}
    return df.select("gpn", "snapshot_year", "snapshot_month", *(F.col(c).alias(n) for n, c in have.items()))


def load_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None, where: str | None = None, whole: bool = False) -> DataFrame:
    """A Parquet table, pruned to the columns and with the filter at the scan.  A filter on time or key is mandatory; only
    what is small by its kind, such as a dimension, may be asked for as a whole."""
    if not where and not whole:
        raise ValueError(f"{name} is read by a filter on time or key; whole=True is for dimensions")
    df = spark.read.parquet(f"{folder}/{name}")
    df = df.filter(where) if where else df
    return df.select(*columns) if columns else df


def export_raw_page_views(df: DataFrame, start: str, end: str, ts: str = "timestamp [UTC]") -> DataFrame:
    """The raw export columns that are there, inside an inclusive time window, oldest first."""
    have = [c for c in EXPORT_COLUMNS if c in df.columns]
    when = F.try_to_timestamp(F.col(f"`{ts}`").cast("string"))
    return df.filter(when.between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))).select(*(f"`{c}`" for c in have)).orderBy(f"`{ts}`", "id")
