"""Queries over tracking coverage and page metrics, with their SQL."""

from pyspark.sql import functions as F

from pulsegrid.operators import coverage as C
from pulsegrid.operators import star
from pulsegrid.operators.packs import FLOOR, SITE
from pulsegrid.plans.mail_queries import P
from pulsegrid.plans.registry import query

T = "mailings page_inventory sites metrics page_views custom_events hr_employee"
AS_OF = "2026-05-01"
PCT = "round(CAST({0} AS DOUBLE) * 100 / nullif({1}, 0), 2)"
TID = PCT.format("count(tracking_id)", "count(*)")
SUM = "CAST(coalesce(sum({0}), 0) AS BIGINT) AS {0}"

query("cov01_coverage_overall", lambda t: C.coverage_overall(t["page_inventory"]), T, f"SELECT count(*) AS pages, count(tracking_id) AS with_tid, count(article_date) AS with_date, count(CASE WHEN tracking_id IS NOT NULL AND article_date IS NOT NULL THEN 1 END) AS with_both, {TID} AS pct_tid, {PCT.format('count(article_date)', 'count(*)')} AS pct_date FROM page_inventory")
query("cov02_coverage_by_site", C.coverage_by_site, T, f"SELECT site_id, site_name, site_url, count(*) AS pages, count(tracking_id) AS with_tid, count(article_date) AS dated, {TID} AS pct_tid, count(DISTINCT {P}) AS packs FROM page_inventory LEFT JOIN sites USING (site_id) GROUP BY ALL HAVING count(*) > 10 ORDER BY with_tid DESC, pct_tid DESC, site_id LIMIT 100")
query("cov03_top_article_sites", C.top_article_sites, T, f"SELECT site_id, site_name, count(*) AS pages, min(article_date) AS earliest, max(article_date) AS latest, count(DISTINCT {P}) AS packs, count(DISTINCT right(tracking_id, 3)) AS n_suffixes, string_agg(DISTINCT right(tracking_id, 3), ',' ORDER BY right(tracking_id, 3)) AS suffixes FROM page_inventory LEFT JOIN sites USING (site_id) WHERE tracking_id IS NOT NULL GROUP BY ALL ORDER BY pages DESC, site_id LIMIT 50")
TREND = f"SELECT CAST(date_trunc('month', article_date) AS DATE) AS month, count(*) AS articles, count(tracking_id) AS with_tid, {TID} AS pct_tid, count(tracking_id) * 100 >= {{0}} * count(*) AS ready FROM page_inventory WHERE article_date >= DATE '{AS_OF}' - INTERVAL 36 MONTH GROUP BY 1"
query("cov04_coverage_trend", lambda t: C.coverage_trend(t["page_inventory"], AS_OF), T, TREND.format(80))
query("cov04_first_ready_month", lambda t: C.first_ready_month(t["page_inventory"], AS_OF, 20), T, f"SELECT min(month) AS first_ready FROM ({TREND.format(20)}) WHERE ready")
query("cov05_coverage_by_month", C.coverage_by_month, T, f"SELECT CAST(date_trunc('month', article_date) AS DATE) AS month, count(*) AS articles, count(tracking_id) AS tracked, {TID} AS pct FROM page_inventory JOIN sites USING (site_id) WHERE site_name = '{SITE}' AND article_date >= DATE '{FLOOR}' GROUP BY 1")
query("cov06_coverage_by_type", lambda t: C.coverage_by_type(t["page_inventory"]), T, f"SELECT coalesce(page_type, '(null)') AS page_type, count(*) AS pages, count(tracking_id) AS with_tid, {TID} AS pct_tid FROM page_inventory GROUP BY 1 ORDER BY pages DESC, 1 LIMIT 50")
query("cov07_coverage_by_traffic", C.coverage_by_traffic, T, f""", m AS (SELECT page_id, count(*) AS rows, sum(views) AS views, sum(visits) AS visits FROM metrics GROUP BY 1),
g AS (SELECT CASE WHEN tracking_id IS NOT NULL THEN 'tracked' WHEN article_date IS NOT NULL THEN 'article_no_tid' ELSE 'non_article' END AS page_class, count(DISTINCT page_id) AS pages, {SUM.format('rows')}, {SUM.format('views')}, {SUM.format('visits')} FROM page_inventory LEFT JOIN m USING (page_id) GROUP BY 1)
SELECT *, round(views * 100.0 / nullif(sum(views) OVER (), 0), 2) AS pct_views FROM g""")
query("cov08_pack_intersection", C.pack_intersection, T, f""", m AS (SELECT DISTINCT {P} AS pack_id FROM mailings WHERE right(tracking_id, 3) = 'EMI' AND created_at >= DATE '{FLOOR}'), p AS (SELECT DISTINCT {P} AS pack_id FROM page_inventory JOIN sites USING (site_id) WHERE tracking_id IS NOT NULL AND site_name = '{SITE}' AND article_date >= DATE '{FLOOR}')
SELECT (SELECT count(*) FROM m) AS mail_packs, (SELECT count(*) FROM p) AS page_packs, (SELECT count(*) FROM m JOIN p USING (pack_id)) AS in_both, {PCT.format('(SELECT count(*) FROM m JOIN p USING (pack_id))', '(SELECT count(*) FROM m)')} AS pct""")
PROBE = "SELECT '{0}' AS system, count(*) AS n, round(avg(length(tracking_id)), 2) AS mean_length, count(CASE WHEN length(tracking_id) = 32 THEN 1 END) AS n_32, count(CASE WHEN tracking_id = upper(tracking_id) THEN 1 END) AS n_upper, count(CASE WHEN tracking_id <> trim(tracking_id) THEN 1 END) AS n_blank, count(CASE WHEN len(string_split(tracking_id, '-')) = 5 THEN 1 END) AS n_5_parts FROM {1} WHERE tracking_id IS NOT NULL"
query("cov09_tracking_format_probe", C.tracking_format_probe, T, PROBE.format("mail", "mailings") + " UNION ALL " + PROBE.format("pages", "page_inventory"))
query("cov10_id_overlap", lambda t: C.id_overlap(t["page_views"], t["page_inventory"]), T, ", a AS (SELECT DISTINCT tracking_id AS x FROM page_views WHERE tracking_id IS NOT NULL), b AS (SELECT DISTINCT tracking_id AS y FROM page_inventory WHERE tracking_id IS NOT NULL), j AS (SELECT * FROM a FULL JOIN b ON x = y) SELECT count(CASE WHEN x = y THEN 1 END) AS both, count(CASE WHEN y IS NULL THEN 1 END) AS only_left, count(CASE WHEN x IS NULL THEN 1 END) AS only_right, round(count(CASE WHEN x = y THEN 1 END) / count(*), 6) AS jaccard FROM j")
query("cov11_suffix_volume", C.suffix_volume, T, ", s AS (SELECT right(tracking_id, 3) AS suffix, 'm' AS k FROM mailings WHERE tracking_id IS NOT NULL UNION ALL SELECT right(tracking_id, 3), 'p' FROM page_inventory WHERE tracking_id IS NOT NULL) SELECT suffix, count(CASE WHEN k = 'm' THEN 1 END) AS mail, count(CASE WHEN k = 'p' THEN 1 END) AS pages FROM s GROUP BY 1")
query("cov12_adoption_by_year", C.adoption_by_year, T, f"SELECT CAST(year(created_at) AS INTEGER) AS year, count(*) AS mailings, count(tracking_id) AS tracked, count(DISTINCT tracking_id) AS ids, count(DISTINCT CASE WHEN right(tracking_id, 3) = 'EMI' THEN {P} END) AS packs FROM mailings GROUP BY 1")
query("cov13_url_id_cardinality", lambda t: C.url_id_cardinality(t["page_inventory"]), T, f", g AS (SELECT url, count(*) AS n, count(DISTINCT tracking_id) AS ids FROM page_inventory WHERE url IS NOT NULL GROUP BY 1) SELECT CAST(sum(n) AS BIGINT) AS pages, count(*) AS urls, {PCT.format('count(*)', 'sum(n)')} AS pct_urls, count(CASE WHEN ids > 1 THEN 1 END) AS urls_with_several_ids FROM g")
query("cov14_pv_coverage_by_site", lambda t: C.pv_coverage_by_site(t["page_views"]), T, f"SELECT site_name, count(*) AS views, count(tracking_id) AS with_tid, {TID} AS pct, count(DISTINCT tracking_id) AS ids, coalesce(string_agg(DISTINCT right(tracking_id, 3), ',' ORDER BY right(tracking_id, 3)), '') AS channels FROM page_views GROUP BY 1")
query("cov15_pv_coverage", lambda t: C.pv_coverage(t["page_views"]), T, f"SELECT count(*) AS views, count(tracking_id) AS with_tid, {TID} AS pct, count(DISTINCT {P}) AS packs FROM page_views")
query("cov15_views_by_channel", lambda t: C.views_by_channel(t["page_views"]), T, "SELECT coalesce(right(tracking_id, 3), '(untracked)') AS channel, count(*) AS views FROM page_views GROUP BY 1")
for name, tracked, null in (("tracked", True, "NOT NULL"), ("untracked", False, "NULL")):
    query(f"cov16_top_pages_{name}", lambda t, tracked=tracked: C.top_pages(t["page_views"], star.dim_page(t["page_views"]), tracked), T, f"SELECT page_id, count(*) AS views, count(DISTINCT user_id) AS users, count(DISTINCT tracking_id) AS ids, any_value(page_name) AS page_name, any_value(site_name) AS site_name FROM page_views WHERE tracking_id IS {null} GROUP BY 1 ORDER BY views DESC, page_id LIMIT 15")
SEEN = "count(*) AS views, count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions, min(ts) AS first_seen, max(ts) AS last_seen FROM page_views WHERE contains(lower(url), '/p1')"
query("cov17_url_summary", lambda t: C.url_summary(t["page_views"], "/P1", exact=True), T, "SELECT " + SEEN)
query("cov17_url_breakout", lambda t: C.url_breakout(t["page_views"], "/P1", exact=True), T, "SELECT url, " + SEEN + " GROUP BY 1")
query("cov18_site_summary", lambda t: C.site_summary(t["page_views"], site_id="S1", start="2024-01-03"), T, f"SELECT site_id, site_name, count(*) AS views, count(DISTINCT user_id) AS users, count(DISTINCT page_id) AS pages, {TID} AS pct_tracked FROM page_views WHERE site_id = 's1' AND ts >= TIMESTAMP '2024-01-03' GROUP BY ALL")
query("cov19_views_by_tracking", lambda t: C.views_by_tracking(t["page_views"], cluster="clu01", channel="int"), T, "SELECT view_id, ts, tracking_id, split_part(tracking_id, '-', 1) AS cluster, split_part(tracking_id, '-', 2) AS pack, split_part(tracking_id, '-', 3) AS activity_date, split_part(tracking_id, '-', 4) AS activity, split_part(tracking_id, '-', 5) AS channel, split_part(tracking_id, '-', 1) || '-' || split_part(tracking_id, '-', 2) AS pack_id FROM page_views WHERE lower(split_part(tracking_id, '-', 1)) = 'clu01' AND lower(split_part(tracking_id, '-', 5)) = 'int'")
query("cov20_event_inventory", lambda t: C.event_inventory(t["custom_events"]), T, "SELECT name, count(*) AS n, count(DISTINCT user_id) AS users FROM custom_events GROUP BY 1")
query("cov20_link_type_distribution", lambda t: C.link_type_distribution(t["custom_events"]), T, "SELECT link_type, count(*) AS n, count(DISTINCT user_id) AS users FROM custom_events WHERE name = 'click_event' GROUP BY 1")
query("cov23_row_counts", lambda t: C.row_counts({n: t[n] for n in ("mailings", "page_inventory", "page_views")}), T, " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n FROM {n}" for n in ("mailings", "page_inventory", "page_views")))
query("cov24_top_pages_by_visitors", lambda t: t["page_views"].groupBy("page_id").agg(F.count_distinct("user_id").alias("visitors"), F.count("*").alias("views")).orderBy(F.desc("visitors"), "page_id").limit(20), T, "SELECT page_id, count(DISTINCT user_id) AS visitors, count(*) AS views FROM page_views GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
query("cov24_weekly_trend", lambda t: t["page_views"].groupBy(F.trunc("ts", "week").alias("week")).agg(F.count("*").alias("views"), F.count_distinct("user_id").alias("visitors")), T, "SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS views, count(DISTINCT user_id) AS visitors FROM page_views GROUP BY 1")
query("dq18_suffix_by_month", lambda t: C.suffix_by_month(t["page_views"], "INT"), T, "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n FROM page_views WHERE suffix(tracking_id, 'INT') GROUP BY 1")
DUR = "CAST(sum(CAST(duration_sum AS DECIMAL(18, 2))) AS DOUBLE)"
query("joi12_metrics_by_page_day", lambda t: C.metrics_by_page_day(t, "20240103"), T, f"SELECT tracking_id, article_date, page_id, site_name, day_key, {SUM.format('views')}, {SUM.format('visits')}, {DUR} AS duration_s, {DUR} / sum(visits) AS avg_s, {SUM.format('comments')}, count(DISTINCT contact_id) AS contacts, count(DISTINCT app) AS apps FROM metrics JOIN page_inventory USING (page_id) LEFT JOIN sites USING (site_id) WHERE tracking_id IS NOT NULL AND day_key >= '20240103' GROUP BY tracking_id, article_date, page_id, site_name, day_key")
query("joi13_views_tracked_untracked", C.views_tracked_untracked, T, f"SELECT coalesce(tracking_id, '(untracked)') AS tracking_id, {SUM.format('views')} FROM metrics LEFT JOIN page_inventory USING (page_id) GROUP BY 1")
query("joi14_views_with_tracking", C.views_with_tracking, T, "SELECT view_id, v.page_id, p.tracking_id AS page_tracking_id, title FROM page_views v JOIN page_inventory p ON v.page_id = p.page_id WHERE p.tracking_id IS NOT NULL")
query("joi15_clicks_with_tracking", C.clicks_with_tracking, T, "SELECT event_id, page_id, link_type, tracking_id FROM custom_events JOIN page_inventory USING (page_id) WHERE name = 'click_event'")
query("joi15_clicks_with_person", C.clicks_with_person, T, "SELECT event_id, gpn, component, person_key FROM custom_events JOIN hr_employee USING (gpn) WHERE name = 'click_event'")
query("agg24_views_by_day", C.views_by_day, T, f"SELECT tracking_id, day_key, {SUM.format('views')} FROM metrics JOIN page_inventory USING (page_id) WHERE tracking_id IS NOT NULL GROUP BY ALL")
query("agg24_cta_clicks", C.cta_clicks, T, "SELECT coalesce(tracking_id, '(untracked)') AS tracking_id, component, count(*) AS clicks FROM custom_events JOIN page_inventory USING (page_id) WHERE name = 'click_event' GROUP BY 1, 2")
query("agg25_page_date_rollup", C.page_date_rollup, T, f"SELECT page_id, day_key, {SUM.format('views')}, {SUM.format('visits')}, {SUM.format('comments')} FROM metrics GROUP BY ALL")
query("agg26_interactions_metrics", lambda t: C.interactions_metrics(t["page_views"]), T, "SELECT page_id, strftime(ts, '%Y%m%d') AS day_key, user_id AS contact_id, count(*) AS views, count(DISTINCT date_trunc('hour', ts)) AS visits, CAST(sum(CAST(load_ms AS DECIMAL(18, 2))) AS DOUBLE) AS duration_sum FROM page_views GROUP BY 1, 2, 3")
query("agg27_interactions_90d", lambda t: C.interactions_window(t["metrics"], "2024-01-20"), T, f"SELECT page_id, {SUM.format('views')}, {SUM.format('visits')}, count(DISTINCT contact_id) AS contacts FROM metrics WHERE strptime(day_key, '%Y%m%d') <= DATE '2024-01-20' AND strptime(day_key, '%Y%m%d') > DATE '2024-01-20' - 90 GROUP BY 1")
