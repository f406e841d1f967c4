"""Queries over as-of lags, causes of missing regions, overlaps of columns, sketches, nested events and clustered facts, with their SQL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.operators import coverage as C
from pulsegrid.operators import flatten as L
from pulsegrid.operators import mail as M
from pulsegrid.operators import measures as S
from pulsegrid.operators import packs as K
from pulsegrid.operators import quality as D
from pulsegrid.operators import sketches as H
from pulsegrid.operators import variants as X
from pulsegrid.plans.io_queries import scratch
from pulsegrid.plans.mail_queries import ACT, P, SPAN
from pulsegrid.plans.model import Tables
from pulsegrid.plans.raw import raw_custom_events
from pulsegrid.plans.registry import query
from pulsegrid.plans.star_queries import TOP
from pulsegrid.sources.layout import Clustered

ALL = "mailings receivers engagement hr_employee hr_costcenter hr_user hr_names event_master registrations page_views page_inventory sites custom_events plan_activities"
SENT = "CAST(split_part(receiver_id, '-', 2) AS BIGINT) * 7919 % 1728000"


def lags(t: Tables) -> DataFrame:
    """Send times of the days that have views, so that lags can be measured."""
    at = F.expr(f"timestampadd(SECOND, CAST({SENT} AS INT), TIMESTAMP_NTZ'2024-01-01')")
    return K.send_lags({**{n: t[n] for n in ("mailings", "page_views")}, "receivers": t["receivers"].withColumn("sent_at", at)}, since="2024-01-02")


query("joi24_send_lags", lags, ALL, f""", m AS (SELECT mailing_id, {P} AS pack_id FROM mailings WHERE tracking_id IS NOT NULL),
r AS (SELECT mailing_id, pack_id, TIMESTAMP '2024-01-01' + to_seconds(CAST({SENT} AS INTEGER)) AS moment FROM receivers JOIN m USING (mailing_id)),
s AS (SELECT * FROM r WHERE moment >= TIMESTAMP '2024-01-02'),
big AS (SELECT mailing_id, count(*) AS k FROM s GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20),
v AS (SELECT DISTINCT {P} AS pack_id, ts FROM page_views WHERE tracking_id IS NOT NULL),
l AS (SELECT s.mailing_id, date_diff('second', s.moment, (SELECT min(ts) FROM v WHERE v.pack_id = s.pack_id AND v.ts >= s.moment)) AS lag FROM s JOIN big USING (mailing_id)),
h AS (SELECT mailing_id, CASE WHEN lag <= 2592000 THEN CAST(lag AS DOUBLE) / 3600 END AS h FROM l)
SELECT mailing_id, count(*) AS receivers, count(h) AS with_view, {", ".join(f"round(quantile_cont(h, {q}), 4) AS p{int(q * 100)}_hours" for q in (0.5, 0.9, 0.99))} FROM h GROUP BY GROUPING SETS ((mailing_id), ())""")


def interactions(t: Tables) -> DataFrame:
    """Views with their application, and whether the event of the same number is a comment."""
    n = F.substring("view_id", 2, 20)
    c = t["custom_events"].select(F.substring("event_id", 2, 20).alias("n"), (F.col("name") == "SEARCH_RESULT_CLICK").alias("is_comment"))
    v = t["page_views"].select(n.alias("n"), "page_id", "ts", F.col("user_id").alias("contact_id"), (n.cast("long") % 2 + 1).alias("app"), F.col("load_ms").alias("duration"))
    return C.interactions_fact(v.join(c, "n").drop("n"))


query("agg26_interactions_fact", interactions, ALL, """, v AS (SELECT page_id, ts, user_id AS contact_id, CAST(substr(view_id, 2) AS BIGINT) % 2 + 1 AS app, CAST(load_ms AS DECIMAL(18, 2)) AS d, c.name = 'SEARCH_RESULT_CLICK' AS is_comment
  FROM (SELECT * EXCLUDE (site_name) FROM page_views) p JOIN (SELECT event_id, name FROM custom_events) c ON substr(c.event_id, 2) = substr(p.view_id, 2)),
w AS (SELECT *, lag(ts) OVER (PARTITION BY page_id, contact_id, app ORDER BY ts) AS before FROM v)
SELECT page_id, strftime(ts, '%Y%m%d') AS day_key, contact_id, app, count(*) AS views, count(CASE WHEN before IS NULL OR ts >= before + INTERVAL 30 MINUTE THEN 1 END) AS visits,
CAST(sum(d) AS DOUBLE) AS duration_sum, CAST(sum(d) AS DOUBLE) / count(d) AS duration_avg, count(CASE WHEN is_comment THEN 1 END) AS comments FROM w GROUP BY 1, 2, 3, 4""")

query("agg17_timespan_rollups", M.timespan_rollups, ALL, SPAN + " " + " UNION ALL ".join(
    f"SELECT '{'_'.join(s)}' AS by, timespan, link_type, " + ", ".join(f"{d} AS {d}" if d in s else f"NULL AS {d}" for d in ("event_date", "event_hour", "division", "area", "region", "country")) + f", count(*) AS n, count(DISTINCT receiver_id) AS receivers FROM y GROUP BY timespan, link_type, {', '.join(s)}"
    for s in M.DIMENSIONS
))

CAUSE = """, c AS (SELECT r.mailing_id, r.person_key, h.org_unit, o.region, CASE WHEN o.region IS NOT NULL THEN 'region' WHEN r.person_key IS NULL THEN 'no_person' WHEN h.person_key IS NULL THEN 'no_employee' WHEN h.org_unit IS NULL THEN 'no_org_unit' ELSE 'no_costcenter' END AS cause
  FROM receivers r LEFT JOIN hr_employee h ON h.person_key = r.person_key LEFT JOIN hr_costcenter o ON o.org_unit = h.org_unit)"""
KINDS = "count(*) AS n, count(CASE WHEN region IS NULL THEN 1 END) AS no_region, " + ", ".join(f"count(CASE WHEN cause = '{k}' THEN 1 END) AS {k}" for k in ("no_person", "no_employee", "no_org_unit", "no_costcenter"))
BY_MAILING = CAUSE + f", g AS (SELECT mailing_id, {KINDS} FROM c GROUP BY 1), x AS (SELECT g.*, CAST(year(created_at) AS INTEGER) AS created_year, round(no_region / n, 4) AS share, round(no_region / sum(no_region) OVER (), 4) AS share_of_all FROM g LEFT JOIN mailings USING (mailing_id))"
query("dq14_null_region_by_mailing", M.null_region_by_mailing, ALL, BY_MAILING + " SELECT * FROM x")
query("dq14_null_region_by_creation", M.null_region_by_creation, ALL, BY_MAILING + " SELECT created_year, count(*) AS mailings, " + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in ("n", "no_region", "no_person", "no_employee", "no_org_unit", "no_costcenter")) + " FROM x GROUP BY 1")
query("dq14_null_region_persons", M.null_region_persons, ALL, CAUSE + " SELECT DISTINCT person_key, cause <> 'no_employee' AS in_hr, org_unit, CASE WHEN org_unit IS NOT NULL THEN false END AS in_costcenter FROM c WHERE region IS NULL AND person_key IS NOT NULL ORDER BY person_key LIMIT 100")

WITHIN = "CAST(sent_at AS DATE) <= DATE '1998-06-30' AND CAST(sent_at AS DATE) > DATE '1998-06-30' - 90"
query("dq16_pack_end_to_end", lambda t: K.pack_end_to_end(t, "1998-06-30"), ALL, TOP + ACT + f""", m AS (SELECT mailing_id, {P} AS pack_id, created_at, created_by FROM mailings WHERE tracking_id IS NOT NULL),
r AS (SELECT receivers.*, pack_id FROM receivers JOIN m USING (mailing_id) WHERE {WITHIN}),
b AS (SELECT pack_id, count(DISTINCT person_key) AS recipients FROM r GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1),
q AS (SELECT a.* FROM a JOIN m USING (mailing_id) JOIN b USING (pack_id) WHERE EXISTS (SELECT 1 FROM r WHERE r.mailing_id = a.mailing_id AND r.receiver_id = a.receiver_id)),
w AS (SELECT f.* FROM f JOIN b ON {P} = b.pack_id WHERE tracking_id IS NOT NULL)
SELECT pack_id, split_part(pack_id, '-', 1) AS cluster_id, (SELECT min(publish_date) FROM plan_activities p WHERE upper(trim(p.pack_id)) = b.pack_id) AS publish_date, recipients,
(SELECT count(DISTINCT person_key) FROM r WHERE r.pack_id = b.pack_id AND log_status <> 'Bounce') AS sent,
(SELECT count(DISTINCT person_key) FROM q WHERE link_type = 'OPEN') AS opened, (SELECT count(DISTINCT person_key) FROM q WHERE link_type = 'CLICK') AS clicked,
(SELECT count(*) FROM w) AS page_views, (SELECT count(DISTINCT user_id) FROM w) AS readers,
(SELECT round(CAST(sum(CAST(round(time_on_page_s * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 / nullif(count(time_on_page_s), 0), 4) FROM w) AS avg_time_on_page_s,
(SELECT full_name FROM m LEFT JOIN hr_names ON person_key = created_by WHERE m.pack_id = b.pack_id ORDER BY created_at, mailing_id LIMIT 1) AS creator_name FROM b""")

OVERLAP = ("mailings", "receivers", "engagement", "event_master", "registrations", "page_inventory", "sites")
SHARED = {"mailing_id": ("engagement", "mailings", "receivers"), "tracking_id": ("event_master", "mailings", "page_inventory"), "title": ("event_master", "mailings", "page_inventory"), "created_by": ("event_master", "mailings"), "event_id": ("event_master", "mailings", "registrations"), "receiver_id": ("engagement", "receivers"), "person_key": ("engagement", "receivers", "registrations"), "language": ("engagement", "receivers"), "is_active": ("engagement", "receivers"), "site_id": ("page_inventory", "sites")}
PAIRS = ", d AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS c, '{x}' AS t, CAST({c} AS VARCHAR) AS v FROM {x} WHERE {c} IS NOT NULL" for c, ts in SHARED.items() for x in ts) + """), z AS (SELECT c, t, count(*) AS n FROM d GROUP BY ALL),
p AS (SELECT x.c, x.t AS a, y.t AS b, count(*) AS overlap FROM d x JOIN d y ON x.c = y.c AND x.v = y.v AND x.t < y.t GROUP BY ALL),
o AS (SELECT p.c AS "column", a AS table_1, b AS table_2, za.n AS distinct_1, zb.n AS distinct_2, overlap, round(overlap * 100.0 / za.n, 1) AS pct_1_in_2, round(overlap * 100.0 / zb.n, 1) AS pct_2_in_1 FROM p JOIN z za ON za.c = p.c AND za.t = a JOIN z zb ON zb.c = p.c AND zb.t = b)
SELECT *, CASE WHEN pct_1_in_2 > 90 AND pct_2_in_1 < 50 THEN table_1 || ' N:1 ' || table_2 WHEN pct_2_in_1 > 90 AND pct_1_in_2 < 50 THEN table_2 || ' N:1 ' || table_1 WHEN pct_1_in_2 > 90 AND pct_2_in_1 > 90 THEN '1:1' ELSE 'M:N or partial' END AS relationship FROM o"""
query("dq03_column_overlaps", lambda t: D.column_overlaps({n: t[n] for n in OVERLAP}), ALL, PAIRS)
WITHINS = {"receivers": ["mailing_id", "person_key"], "mailings": ["mailing_id", "created_by", "event_id"], "hr_employee": ["person_key"], "registrations": ["person_key", "event_id"], "event_master": ["event_id"]}
NAMES = [(f"{t}.{c}", t, c) for t, cs in WITHINS.items() for c in cs]
query("dq03_inclusions", lambda t: D.inclusions({n: t[n] for n in WITHINS}, WITHINS), ALL, ", d AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{n}' AS t, CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL" for n, t, c in NAMES) + "), z AS (SELECT t, count(*) AS n FROM d GROUP BY 1) SELECT x.t AS name, y.t AS within, any_value(n) AS n FROM d x JOIN d y ON x.v = y.v AND x.t <> y.t JOIN z ON z.t = x.t GROUP BY x.t, y.t HAVING count(*) = any_value(n)")


def close_breakout(t: Tables) -> DataFrame:
    """By url from stored daily sketches, next to the exact numbers: whether the estimates are within the stated error."""
    v = C.url_contains(t["page_views"], "/P1")
    e = H.united(H.daily(v, ["url"], "ts", users="user_id", sessions="session_id"), ["url"], ["users", "sessions"])
    x = C.url_breakout(t["page_views"], "/P1", exact=True).select("url", "views", F.col("users").alias("u"), F.col("sessions").alias("s"))
    return x.join(e, "url").select("url", F.col("rows").alias("views"), H.close("users", "u").alias("users_close"), H.close("sessions", "s").alias("sessions_close"))


query("cov17_url_breakout_approximate", close_breakout, ALL, "SELECT url, count(*) AS views, true AS users_close, true AS sessions_close FROM page_views WHERE contains(lower(url), '/p1') GROUP BY 1")


def close_rolling(t: Tables) -> DataFrame:
    """Rolling distinct users from stored daily sketches, next to the exact numbers of every key and day."""
    keys = ["site_id", "content_type"]
    e = H.rolling(H.daily(t["page_views"], keys, "ts", users="user_id"), keys, "users")
    x = S.rolling_unique(t["page_views"].withColumn("day", F.to_date("ts")), keys, "user_id")
    exact = x.select(*keys, "day", *(F.col(f"users_{s}d").alias(f"x{s}") for s in S.SPANS))
    return exact.join(e, [*keys, "day"]).select(*keys, "day", *(H.close(f"users_{s}d", f"x{s}").alias(f"close_{s}d") for s in S.SPANS))


query("win04_rolling_sketches", close_rolling, ALL, "SELECT DISTINCT site_id, content_type, CAST(ts AS DATE) AS day, " + ", ".join(f"true AS close_{s}d" for s in S.SPANS) + " FROM page_views")


def close_keys(t: Tables) -> DataFrame:
    """Keys of event properties with rows and distinct values from stored daily sketches, next to the exact inventory."""
    e = raw_custom_events(t).select("timestamp", F.explode(L.parse_custom_dimensions("customDimensions")).alias("key", "value"))
    est = H.united(H.daily(e, ["key"], "timestamp", values="value"), ["key"], ["values"])
    x = e.groupBy("key").agg(F.count_distinct("value").alias("x"))
    return x.join(est, "key").select("key", F.col("rows").alias("n"), H.close("values", "x").alias("values_close"))


query("cov21_key_inventory_sketches", close_keys, ALL, " UNION ALL ".join(f"SELECT '{k}' AS key, count({c}) AS n, true AS values_close FROM custom_events" for k, c in (("cp_GPN", "gpn"), ("cp_Email", "email"), ("cp_PageId", "page_id"), ("cp_Link_Type", "link_type"), ("cp_ComponentName", "component"), ("env", "'prod'"))))


def nested_events(t: Tables) -> DataFrame:
    """Search events with properties on four levels, encoded as a string inside the cell."""
    c = F.col
    query_ = F.struct(c("component").alias("text"), F.array(F.struct(c("link_type").alias("t")), F.struct(c("page_id").alias("t"))).alias("terms"))
    props = F.to_json(F.struct(c("gpn").alias("GPN"), F.struct(query_.alias("query"), F.length("page_id").alias("rank")).alias("search")))
    flat = F.to_json(F.struct(c("gpn").alias("GPN"), c("component").alias("search")))
    inner = F.when(c("name") == "click_event", flat).otherwise(props)
    return t["custom_events"].select(F.to_json(F.struct(inner.alias("CustomProps"))).alias("customDimensions"))


def path_sql(path: str, value: str, where: str = "name <> 'click_event'", kinds: str = "string") -> str:
    return f"SELECT '{path}' AS path, count({value}) AS n, '{kinds}' AS kinds, count(DISTINCT {value}) AS n_values, min({value}) AS sample FROM custom_events WHERE {where}"


query("cov21_path_inventory", lambda t: X.path_inventory(nested_events(t), "customDimensions"), ALL, " UNION ALL ".join((
    path_sql("$.CustomProps.GPN", "gpn", "true"), path_sql("$.CustomProps.search", "component", "name = 'click_event'"), path_sql("$.CustomProps.search.query.text", "component"),
    path_sql("$.CustomProps.search.rank", "CAST(length(page_id) AS VARCHAR)", kinds="number"),
    "SELECT '$.CustomProps.search.query.terms[].t', count(*), 'string', count(DISTINCT x), min(x) FROM (SELECT link_type AS x FROM custom_events WHERE name <> 'click_event' UNION ALL SELECT page_id FROM custom_events WHERE name <> 'click_event')",
)))


def clustered(t: Tables) -> DataFrame:
    """Views in a clustered table, read by days and a range of users."""
    spark = t["page_views"].sparkSession
    table = Clustered(scratch(spark), "ts", ("user_id", "page_id"), 500)
    table.write(t["page_views"].select("view_id", "ts", "user_id", "page_id"))
    return table.read(spark, ("2024-01-03", "2024-01-20"), user_id=("u1", "u3"))


query("snk05_clustered_fact", clustered, ALL, "SELECT view_id, ts, user_id, page_id FROM page_views WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AND user_id BETWEEN 'u1' AND 'u3'")
