"""Queries that read and write tables through the sources and sinks, with their SQL."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions import values as V
from pulsegrid.functions.tracking import pack_key
from pulsegrid.operators import mail, packs, quality, star
from pulsegrid.operators.incremental import MailStore
from pulsegrid.plans import jobs
from pulsegrid.plans.mail_queries import GOLD, FACT, P
from pulsegrid.plans.model import Tables
from pulsegrid.plans.raw import raw_page_views
from pulsegrid.plans.registry import query
from pulsegrid.sources import exports, sinks
from pulsegrid.sources.keyed import Keyed

T = "page_views page_inventory hr_history metrics mailings"
MAIL = T + " receivers engagement hr_employee hr_costcenter hr_user event_master registrations plan_packs plan_clusters plan_activities"


def scratch(spark: SparkSession) -> str:
    """A new path in the cluster's shared folder; only where none is set, as in tests, in a local one, which a cluster could not share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='spark-')}/io/{uuid.uuid4().hex}"


def _spark(t: Tables) -> SparkSession:
    return t["page_views"].sparkSession


def exported(t: Tables) -> DataFrame:
    path = scratch(_spark(t))
    raw_page_views(t).drop("source_file").write.options(header=True, escape='"').csv(path)
    files = {r.path: r.splittable for r in exports.file_hashes(_spark(t), path).collect()}
    return exports.read_page_view_export(_spark(t), *files, splittable={p for p, yes in files.items() if yes}).select("id", "url", "session_Id", F.col("duration").cast("double").alias("duration"), "customDimensions").select("id", "url", "session_Id", "duration", F.col("customDimensions").contains("CustomProps").alias("has_props"))


def hr_read(t: Tables) -> DataFrame:
    path = scratch(_spark(t))
    t["hr_history"].withColumnsRenamed({"division": "gcrs_division_desc", "country": "work_location_country"}).withColumn("other", F.lit(1)).write.parquet(path)
    return exports.read_hr_history(_spark(t), path)


def upserted(t: Tables) -> DataFrame:
    path = scratch(_spark(t))
    v = t["page_views"].select("view_id", "page_id", "source_file")
    sinks.upsert_by_source_file(v, path)
    sinks.upsert_by_source_file(v.filter("source_file = 'export_b.csv' AND page_id < 'p2'"), path)
    return _spark(t).read.parquet(path).select("view_id", "page_id", F.col("source_file").cast("string").alias("source_file"))


def classified(t: Tables) -> DataFrame:
    """Files of views by page, of which some are new, some changed and some as the manifest has them."""
    path, old = scratch(_spark(t)), scratch(_spark(t))
    v = t["page_views"].select("view_id", "page_id", F.regexp_replace("page_id", "p", "").cast("int").alias("n"))
    name = F.format_string("%02d", F.col("n"))
    for where, rows in ((old, v.filter("n % 5 <> 0").withColumn("view_id", F.when(F.col("n") % 5 == 1, F.concat("view_id", F.lit("x"))).otherwise(F.col("view_id")))), (path, v)):
        rows.repartition(1).sortWithinPartitions("n", "view_id").select("view_id", name.alias("page")).write.partitionBy("page").option("header", True).csv(where)
    by_page = lambda where: exports.file_hashes(_spark(t), f"{where}/page=*").withColumn("file_name", F.regexp_extract("path", "page=([0-9]+)/", 1))
    return exports.classify_input_files(by_page(path), by_page(old)).select("file_name", "status")


def job_tables(t: Tables) -> tuple[SparkSession, str]:
    """The batch job over exports of both months' halves, then again with the second one changed."""
    source, target = scratch(_spark(t)), scratch(_spark(t))
    spark, raw = _spark(t), raw_page_views(t)
    sinks.exists(spark, source)
    fs, _ = sinks._fs(spark, source)
    half = lambda df, name: _one_csv(df.filter(F.col("source_file") == name).drop("source_file"), source, name)
    half(raw, "export_a.csv")
    half(raw, "export_b.csv")
    jobs.run(spark, source, target, t["hr_history"])
    fs.delete(sinks._fs(spark, f"{source}/export_b.csv")[1], True)
    half(raw.filter(F.col("id") < "v5"), "export_b.csv")
    jobs.run(spark, source, target, t["hr_history"])
    return spark, target


def _one_csv(df: DataFrame, folder: str, name: str) -> None:
    """An export is one file, so that one task writes it."""
    spark, stage = df.sparkSession, f"{folder}.{uuid.uuid4().hex}"
    df.repartition(1).write.options(header=True, escape='"').csv(stage)
    fs, target = sinks._fs(spark, f"{folder}/{name}")
    fs.mkdirs(target.getParent())
    part = next(f.getPath() for f in fs.listStatus(sinks._fs(spark, stage)[1]) if f.getPath().getName().endswith(".csv"))
    fs.rename(part, target)


def job_fact(t: Tables) -> DataFrame:
    spark, target = job_tables(t)
    return spark.read.parquet(f"{target}/fact_page_view").select("view_id", F.col("source_file").cast("string").alias("source_file"), "page_id", "hr_division", F.round("time_on_page_s", 6).alias("time_on_page_s"))


def job_manifest(t: Tables) -> DataFrame:
    spark, target = job_tables(t)
    n = spark.read.parquet(f"{target}/agg_session").agg(F.lit("agg_session").alias("file_name"), F.count("*").alias("row_count"))
    return spark.read.parquet(f"{target}/processed_files").select("file_name", "row_count").unionByName(n)


def profile_written(t: Tables) -> DataFrame:
    """The profile of two tables as JSON, without samples, read back."""
    path = scratch(_spark(t))
    sinks.write_profile({n: quality.profile_columns(t[n]).withColumn("samples", F.lit("private")) for n in ("mailings", "page_inventory")}, path)
    return _spark(t).read.json(f"{path}/mailings").unionByName(_spark(t).read.json(f"{path}/page_inventory"), allowMissingColumns=True)


def dashboard(t: Tables) -> DataFrame:
    """All four arrays from the facts, written as JSON and read back as one table."""
    path = scratch(_spark(t))
    day = lambda c: F.to_date(c).alias("day")
    m = mail.fact_email(t).select(pack_key("tracking_id").alias("pack_id"), "event", day("event_at"))
    v = t["page_views"].select(pack_key("tracking_id").alias("pack_id"), day("ts"))
    e = t["registrations"].join(t["event_master"].select("event_id", "tracking_id"), "event_id").select(pack_key("tracking_id").alias("pack_id"), "status", day("registered_on"))
    sinks.export_dashboard(sinks.dashboard_arrays(packs.pack_dim(t).select("pack_id", "pack_name"), m, v, e), path)
    read = lambda name, kind, n="n": _spark(t).read.json(f"{path}/{name}").select(F.lit(name).alias("name"), "pack_id", (F.col(kind) if kind else F.lit(None).cast("string")).alias("kind"), (F.col("day") if n == "n" else F.lit(None)).cast("string").alias("day"), (F.col("n") if n == "n" else F.lit(1)).cast("long").alias("n"))
    return read("packs", "pack_name", "1").unionByName(read("email_events", "event")).unionByName(read("page_views", None)).unionByName(read("event_regs", "status"))


def star_written(t: Tables) -> DataFrame:
    path = scratch(_spark(t))
    fact = star.time_on_page(t["page_views"])
    tables = {"fact_page_view": fact, "agg_session": star.agg_session(fact), "dim_page": star.dim_page(fact), "dim_date": star.dim_date(fact)}
    sinks.write_star_schema(tables, path)
    rows = [_spark(t).read.parquet(f"{path}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in tables]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


def snapshots(t: Tables) -> DataFrame:
    path = scratch(_spark(t))
    p = t["page_inventory"].select("page_id", "site_id")
    sinks.snapshot_replace(p, path)
    sinks.snapshot_replace(p.filter("site_id <> 's1'"), path)
    sinks.append(p.filter("site_id = 's2'"), path)
    return _spark(t).read.parquet(path)


def gold(t: Tables) -> DataFrame:
    path = scratch(_spark(t))
    for least in (0, 2):
        sinks.rebuild(t["metrics"].filter(F.col("views") >= least).groupBy("page_id").agg(F.sum("views").alias("views")), path)
    return _spark(t).read.parquet(path)


def _number(c: str) -> F.Column:
    """The number of an id that is a letter and a number."""
    return F.substring(c, 2, 20).cast("long")


def merged_receivers(t: Tables) -> DataFrame:
    """Receivers as they stood before a run, merged with the run's changes: newer rows, repeated updates, and removals."""
    table, r = Keyed(scratch(_spark(t)), ("mailing_id",), 16), t["receivers"].select("mailing_id", "receiver_id", "log_status", "sent_at")
    turn = F.split_part("receiver_id", F.lit("-"), F.lit(2)).cast("long") % 5
    table.create(r.filter(turn != 0).withColumn("log_status", F.when(turn == 1, "Queued").otherwise(F.col("log_status"))))
    new = r.filter(turn < 2).withColumn("seq", F.lit(2))
    stale = r.filter(turn == 1).withColumns({"log_status": F.lit("Stale"), "seq": F.lit(1)})
    gone = r.filter((turn == 3) & (F.col("log_status") == "Bounce")).withColumn("seq", F.lit(3))
    table.merge(new.unionByName(stale).unionByName(gone), ("mailing_id", "receiver_id"), order=F.col("seq"), deleted=F.col("seq") == 3)
    return table.read(_spark(t))


def merged_engagement(t: Tables) -> DataFrame:
    """Engagement with one link's rows merged in late and another's soft deletes taken back; few partitions are touched."""
    table, e = Keyed(scratch(_spark(t)), ("mailing_id",), 16), t["engagement"].select("mailing_id", "id", "link_no", "is_active", "event_at")
    few = _number("mailing_id") % 50 == 0
    table.create(e.filter(~(few & (F.col("link_no") == 3))).withColumn("is_active", F.when(few & (F.col("link_no") == 1), 0).otherwise(F.col("is_active"))))
    table.merge(e.filter(few & F.col("link_no").isin(1, 3)), ("mailing_id", "id"))
    return table.read(_spark(t))


def gold_by_change(t: Tables) -> DataFrame:
    """Gold kept up to date by changes: late events, soft deletes, removed receivers; equal to a full rebuild."""
    store, r, e = MailStore(scratch(_spark(t)), 16), t["receivers"], t["engagement"]
    odd = _number("mailing_id") % 4 == 0
    before = e.filter(~(odd & (F.col("link_no") == 3))).withColumn("is_active", F.when(odd & (F.col("link_no") == 1), 1 - F.col("is_active")).otherwise(F.col("is_active")))
    store.load({**{n: t[n] for n in ("mailings", "hr_employee", "hr_costcenter", "hr_user")}, "receivers": r.withColumn("log_status", F.when(odd, "Queued").otherwise(F.col("log_status"))), "engagement": before})
    store.apply(t, {"engagement": e.filter(odd & F.col("link_no").isin(1, 3)), "receivers": r.filter(odd)})
    removed = r.filter(_number("mailing_id") % 4 == 1).filter("log_status = 'Bounce'")
    store.apply(t, {"receivers": removed}, deleted=F.lit(True))
    return store.gold(_spark(t))


def manifest(t: Tables) -> DataFrame:
    files = t["page_views"].groupBy(F.col("source_file").alias("file_name")).agg(F.count("*").alias("row_count"), F.sha2(F.max("view_id"), 256).alias("sha256"))
    old = files.withColumns({"row_count": F.lit(0).cast("long"), "file_name": F.replace("file_name", F.lit("_b"), F.lit("_c"))})
    return sinks.record_processed(old, files)


query("src01_read_page_view_export", exported, T, 'SELECT view_id AS id, url, session_id AS "session_Id", load_ms AS duration, true AS has_props FROM page_views')
NUMBER = "CAST(replace(page_id, 'p', '') AS INTEGER)"
query("src02_classify_input_files", classified, T, f"SELECT DISTINCT printf('%02d', {NUMBER}) AS file_name, CASE {NUMBER} % 5 WHEN 0 THEN 'new' WHEN 1 THEN 'changed' ELSE 'unchanged' END AS status FROM page_views")
JOB = """, pv AS (SELECT * FROM page_views WHERE source_file = 'export_a.csv' OR view_id < 'v5'),
n AS (SELECT *, ts + INTERVAL 1 HOUR AS at, lead(ts) OVER (PARTITION BY source_file, session_id, CASE WHEN session_id IS NULL THEN view_id END ORDER BY ts, view_id) AS next_ts FROM pv),
h AS (SELECT lpad(gpn, 8, '0') AS g, snapshot_year * 12 + snapshot_month AS ym, division FROM hr_history)"""
query("snk04_job_fact", job_fact, T, JOB + """ SELECT view_id, source_file, page_id, coalesce(b.division, a.division) AS hr_division, round(CASE WHEN date_diff('microsecond', ts, next_ts) <= 1800000000 THEN date_diff('microsecond', ts, next_ts) / 1000000 END, 6) AS time_on_page_s FROM n
  LEFT JOIN LATERAL (SELECT division FROM h WHERE h.g = n.gpn AND h.ym <= year(n.at) * 12 + month(n.at) ORDER BY ym DESC LIMIT 1) b ON true
  LEFT JOIN LATERAL (SELECT division FROM h WHERE h.g = n.gpn AND h.ym > year(n.at) * 12 + month(n.at) ORDER BY ym LIMIT 1) a ON true""")
query("snk04_job_manifest", job_manifest, T, JOB + " SELECT f AS file_name, count(view_id) AS row_count FROM (VALUES ('export_a.csv'), ('export_b.csv')) x(f) LEFT JOIN pv ON source_file = f GROUP BY 1 UNION ALL SELECT 'agg_session', count(DISTINCT session_id) FROM pv")
_DAYS = "SELECT {0} AS name, {1} AS pack_id, {2} AS kind, CAST(CAST({3} AS DATE) AS VARCHAR) AS day, count(*) AS n FROM {4} GROUP BY ALL"
query("snk09_dashboard_arrays", dashboard, MAIL, FACT + " " + " UNION ALL ".join((
    "SELECT 'packs' AS name, pack_id, min(pack_name) AS kind, NULL AS day, 1 AS n FROM plan_activities JOIN plan_packs USING (pack_id) GROUP BY pack_id",
    _DAYS.format("'email_events'", P, "event", "event_at", "e"), _DAYS.format("'page_views'", P, "NULL", "ts", "page_views"),
    _DAYS.format("'event_regs'", P, "status", "registered_on", "registrations JOIN event_master USING (event_id)"),
)))
query("snk11_write_profile", profile_written, T, ", c AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS t, '{c}' AS \"column\", '{kind}' AS type, CAST({c} AS VARCHAR) AS v FROM {t}"
    for t, cols in (("mailings", {"mailing_id": "string", "tracking_id": "string", "title": "string", "created_by": "string", "created_at": "date", "event_id": "string"}), ("page_inventory", {"page_id": "string", "tracking_id": "string", "article_date": "date", "url": "string", "title": "string", "site_id": "string", "page_type": "string"}))
    for c, kind in cols.items()
) + ') SELECT "column", type, count(*) AS n, count(*) - count(v) AS nulls, count(DISTINCT v) AS "distinct" FROM c GROUP BY t, "column", type')
query("src03_read_hr_history", hr_read, T, "SELECT gpn, snapshot_year, snapshot_month, division, country FROM hr_history")
query("src04_load_table", lambda t: exports.load_table(*t._from, "orders.parquet", ["o_orderkey", "o_totalprice"], "o_orderdate >= DATE '1998-01-01'"), T, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '1998-01-01'")
query("snk01_upsert_by_source_file", upserted, T, "SELECT view_id, page_id, source_file FROM page_views WHERE source_file = 'export_a.csv' OR page_id < 'p2'")
query("snk03_record_processed", manifest, T, ", f AS (SELECT source_file AS file_name, count(*) AS row_count, sha256(max(view_id)) AS sha256 FROM page_views GROUP BY 1) SELECT * FROM f UNION ALL SELECT replace(file_name, '_b', '_c'), 0, sha256 FROM f WHERE replace(file_name, '_b', '_c') NOT IN (SELECT file_name FROM f)")
query("snk05_write_star_schema", star_written, T, "SELECT 'fact_page_view' AS name, count(*) AS n FROM page_views UNION ALL SELECT 'agg_session', count(DISTINCT session_id) FROM page_views UNION ALL SELECT 'dim_page', count(DISTINCT page_id) FROM page_views UNION ALL SELECT 'dim_date', count(DISTINCT CAST(ts AS DATE)) FROM page_views")
query("snk06_merge_receivers", merged_receivers, MAIL, "SELECT mailing_id, receiver_id, log_status, sent_at FROM receivers WHERE NOT (CAST(split_part(receiver_id, '-', 2) AS BIGINT) % 5 = 3 AND log_status = 'Bounce')")
query("snk06_merge_engagement", merged_engagement, MAIL, "SELECT mailing_id, id, link_no, is_active, event_at FROM engagement")
query("snk08_gold_by_change", gold_by_change, MAIL, GOLD.replace("FROM receivers", "FROM (SELECT * FROM receivers WHERE NOT (CAST(substr(mailing_id, 2) AS BIGINT) % 4 = 1 AND log_status = 'Bounce'))") + " SELECT * FROM g")
query("snk07_snapshot_and_append", snapshots, T, "SELECT page_id, site_id FROM page_inventory WHERE site_id <> 's1' UNION ALL SELECT page_id, site_id FROM page_inventory WHERE site_id = 's2'")
query("snk08_rebuild_gold", gold, T, "SELECT page_id, CAST(sum(views) AS BIGINT) AS views FROM metrics WHERE views >= 2 GROUP BY 1")
query("prj07_lenient_ts", lambda t: t["page_views"].select("view_id", V.lenient_ts(F.when(F.col("page_id") == "p1", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))).alias("at")), T, "SELECT view_id, CASE WHEN page_id <> 'p1' THEN date_trunc('second', ts) END AS at FROM page_views")
query("prj19_zero_if_null", lambda t: t["mailings"].select("mailing_id", V.zero_if_null(F.length("tracking_id")).alias("n")), T, "SELECT mailing_id, CAST(coalesce(length(tracking_id), 0) AS INTEGER) AS n FROM mailings")
query("prj24_parse_date_key", lambda t: t["metrics"].select("day_key", V.parse_date_key("day_key").alias("day")).distinct(), T, "SELECT DISTINCT day_key, CAST(strptime(day_key, '%Y%m%d') AS DATE) AS day FROM metrics")
