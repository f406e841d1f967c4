"""Queries over campaign packs, with their SQL."""

from pyspark.sql import functions as F


from pulsegrid.operators import packs as K
from pulsegrid.plans.mail_queries import ACT, ALL, FACT, WHO, P
from pulsegrid.plans.registry import query

T = ALL + " page_inventory sites metrics plan_packs plan_clusters plan_activities"
REGION = f"""{ACT}{WHO}, n AS (SELECT mailing_id, region, country, count(*) AS n FROM receivers LEFT JOIN w USING (person_key) GROUP BY ALL),
u AS (SELECT mailing_id, region, country, count(DISTINCT CASE WHEN link_type = 'OPEN' THEN person_key END) AS o, count(DISTINCT CASE WHEN link_type = 'CLICK' THEN person_key END) AS k FROM a LEFT JOIN w USING (person_key) GROUP BY ALL),
r AS (SELECT n.*, o, k FROM n LEFT JOIN u ON n.mailing_id = u.mailing_id AND n.region IS NOT DISTINCT FROM u.region AND n.country IS NOT DISTINCT FROM u.country)"""


def mails(floor: str) -> str:
    return f"SELECT mailing_id, {P} AS pack_id FROM mailings WHERE right(tracking_id, 3) = 'EMI' AND created_at >= DATE '{floor}'"


def email(floor: str = K.FLOOR) -> str:
    return f"SELECT pack_id, count(DISTINCT i.mailing_id) AS mailings, CAST(sum(coalesce(n, 0)) AS BIGINT) AS recipients, CAST(sum(coalesce(o, 0)) AS BIGINT) AS unique_opens, CAST(sum(coalesce(k, 0)) AS BIGINT) AS unique_clicks FROM ({mails(floor)}) i LEFT JOIN r ON r.mailing_id = i.mailing_id GROUP BY 1"


PAGES = f", pg AS (SELECT page_id, {P} AS pack_id FROM page_inventory JOIN sites USING (site_id) WHERE site_name = '{K.SITE}' AND article_date >= DATE '{K.FLOOR}' AND right(tracking_id, 3) IN ('IAN', 'ITS', 'OPN', 'ANC'))"
EXACT = "CAST(sum(CAST(duration_sum AS DECIMAL(18, 2))) AS DOUBLE)"
INTRANET = f"SELECT pack_id, count(DISTINCT page_id) AS pages, CAST(sum(views) AS BIGINT) AS page_views, CAST(sum(visits) AS BIGINT) AS page_visits, {EXACT} AS duration_s, count(DISTINCT contact_id) AS readers FROM pg JOIN metrics USING (page_id) GROUP BY 1"
PLAN = f", pl AS (SELECT upper(trim(tracking_id)) AS tracking_id, {P} AS pack_id, pack_name, theme, target_region, cluster_name, publish_date FROM plan_activities LEFT JOIN (SELECT pack_id, pack_name, theme, target_region, cluster_name FROM plan_packs LEFT JOIN plan_clusters USING (cluster_id)) USING (pack_id))"
DIM = "SELECT pack_id, min(pack_name) AS pack_name, min(theme) AS theme, min(target_region) AS target_region, min(cluster_name) AS cluster_name, min(publish_date) AS publish_date FROM pl GROUP BY 1"
THREE = f"{REGION}{PAGES}{PLAN}, d AS ({DIM}), e AS ({email()}), i AS ({INTRANET})"
PCT = "round(CAST({0} AS DOUBLE) / nullif({1}, 0) * 100, 2)"
CROSS = f"""SELECT pack_id, d.* EXCLUDE (pack_id), e.* EXCLUDE (pack_id), i.* EXCLUDE (pack_id), {PCT.format("unique_opens", "recipients")} AS open_rate_pct, {PCT.format("unique_clicks", "recipients")} AS click_rate_pct,
round(duration_s / nullif(page_visits, 0), 1) AS avg_duration_s, {PCT.format("page_views", "unique_clicks")} AS click_to_view_pct, {PCT.format("readers", "recipients")} AS reach_pct FROM d FULL JOIN e USING (pack_id) FULL JOIN i USING (pack_id) WHERE pack_id IS NOT NULL"""

query("agg05_email_pack", K.email_pack, T, REGION + " " + email())
query("agg06_intranet_pack", K.intranet_pack, T, PAGES + " " + INTRANET)
query("agg07_pack_dim", K.pack_dim, T, PLAN + " " + DIM)
query("joi20_plan_dim", K.plan_dim, T, PLAN + " SELECT * FROM pl")
query("agg08_cross_channel_fact", K.cross_channel_fact, T, THREE + " " + CROSS)
query("agg09_email_region_pack", K.email_region_pack, T, REGION + f" SELECT pack_id, region, country, CAST(sum(n) AS BIGINT) AS recipients, CAST(sum(coalesce(o, 0)) AS BIGINT) AS unique_opens, CAST(sum(coalesce(k, 0)) AS BIGINT) AS unique_clicks FROM ({mails(K.FLOOR)}) i JOIN r USING (mailing_id) GROUP BY ALL HAVING sum(n) > 0")
query("joi23_pack_overview", K.pack_overview, T, THREE + " SELECT pack_id, d.* EXCLUDE (pack_id), e.* EXCLUDE (pack_id), i.* EXCLUDE (pack_id) FROM d LEFT JOIN e USING (pack_id) LEFT JOIN i USING (pack_id)")
query("agg12_intranet_pack_from_metrics", lambda t: K.intranet_pack_from_metrics(t, "20240105"), T, f"SELECT pack_id, CAST(sum(views) AS BIGINT) AS views, CAST(sum(visits) AS BIGINT) AS visits, {EXACT} AS duration_s, count(DISTINCT contact_id) AS viewers FROM metrics JOIN (SELECT page_id, {P} AS pack_id FROM page_inventory WHERE tracking_id IS NOT NULL) USING (page_id) WHERE day_key >= '20240105' GROUP BY 1")
COUNT = ", ".join(f"count(CASE WHEN event = '{e}' THEN 1 END) AS {e}" for e in ("sent", "bounced", "opened", "clicked"))
FACTS = FACT + f""", m AS (SELECT {P} AS pack_id, {COUNT} FROM e WHERE tracking_id IS NOT NULL GROUP BY 1),
v AS (SELECT {P} AS pack_id, count(*) AS views, count(DISTINCT user_id) AS viewers FROM page_views WHERE tracking_id IS NOT NULL GROUP BY 1),
x AS (SELECT {P} AS pack_id, count(*) AS registered, count(CASE WHEN status = 'attended' THEN 1 END) AS attended, count(CASE WHEN status = 'no_show' THEN 1 END) AS no_show FROM registrations JOIN event_master USING (event_id) WHERE event_date < DATE '2100-01-01' GROUP BY 1),
pf AS (SELECT * FROM m FULL JOIN v USING (pack_id) FULL JOIN x USING (pack_id))"""
query("agg13_pack_from_facts", K.pack_from_facts, T, FACTS + " SELECT * FROM pf")
PACKS = f", m AS (SELECT DISTINCT {P} AS pack_id FROM mailings WHERE tracking_id IS NOT NULL), p AS (SELECT DISTINCT {P} AS pack_id FROM page_inventory WHERE tracking_id IS NOT NULL)"
query("joi22_coverage_status", K.coverage_status, T, PACKS + " SELECT coalesce(m.pack_id, p.pack_id) AS pack_id, CASE WHEN m.pack_id IS NULL THEN 'sp_only' WHEN p.pack_id IS NULL THEN 'email_only' ELSE 'both' END AS coverage_status FROM m FULL JOIN p ON m.pack_id = p.pack_id")
query("joi22_coverage_both", lambda t: K.coverage_status(t, True), T, PACKS + " SELECT pack_id, 'both' AS coverage_status FROM m JOIN p USING (pack_id)")
query("joi19_pair_ids_by_pack", K.pair_ids_by_pack, T, f"SELECT pack_id, mail_id, page_tracking_id FROM (SELECT DISTINCT {P} AS pack_id, tracking_id AS mail_id FROM mailings WHERE tracking_id IS NOT NULL) JOIN (SELECT DISTINCT {P} AS pack_id, tracking_id AS page_tracking_id FROM page_inventory WHERE tracking_id IS NOT NULL) USING (pack_id)")
query("agg28_with_untracked", K.with_untracked, T, f"SELECT coalesce({P}, 'UNATTRIBUTED') AS pack_id, count(*) AS views, count(DISTINCT user_id) AS viewers FROM page_views GROUP BY 1")
query("agg29_pack_dim_from_masters", K.pack_dim_from_masters, T, f""", x AS (SELECT {P} AS pack_id, created_at AS day, right(tracking_id, 3) AS channel, 'm' AS kind FROM mailings WHERE tracking_id IS NOT NULL UNION ALL SELECT {P}, event_date, right(tracking_id, 3), 'e' FROM event_master),
g AS (SELECT pack_id, min(day) AS first_day, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels, count(CASE WHEN kind = 'm' THEN 1 END) AS mailings, count(CASE WHEN kind = 'e' THEN 1 END) AS events FROM x GROUP BY 1),
w AS (SELECT {P} AS pack_id, count(DISTINCT person_key) AS audience FROM receivers JOIN mailings USING (mailing_id) WHERE tracking_id IS NOT NULL GROUP BY 1) SELECT * FROM g LEFT JOIN w USING (pack_id)""")
query("agg30_pack_created", K.pack_created, T, f"SELECT {P} AS pack_id, min(created_at) AS created, count(*) AS mailings FROM mailings WHERE tracking_id IS NOT NULL GROUP BY 1")
for grain, n in K.GRAINS.items():
    query(f"agg32_rollup_{grain}", lambda t, grain=grain: K.rollup_grain(t, grain), T, FACT + f" SELECT array_to_string(string_split(tracking_id, '-')[1:{n}], '-') AS {grain}, event, count(*) AS n FROM e WHERE tracking_id IS NOT NULL GROUP BY ALL")
query("agg32_rollup_all", K.rollup_all, T, FACT + " SELECT split_part(tracking_id, '-', 1) AS cluster, split_part(tracking_id, '-', 2) AS pack, split_part(tracking_id, '-', 4) AS activity, count(*) AS n FROM e WHERE tracking_id IS NOT NULL GROUP BY ROLLUP (1, 2, 3)")
query("joi21_full_outer_packs", lambda t: K.full_outer_packs(K.pack_created(t), K.with_untracked(t)), T, f"SELECT * FROM (SELECT {P} AS pack_id, min(created_at) AS created, count(*) AS mailings FROM mailings WHERE tracking_id IS NOT NULL GROUP BY 1) FULL JOIN (SELECT coalesce({P}, 'UNATTRIBUTED') AS pack_id, count(*) AS views, count(DISTINCT user_id) AS viewers FROM page_views GROUP BY 1) USING (pack_id)")
query("joi24_attribution_lag", lambda t: K.attribution_lag(t, sent_on=F.add_months("created_at", -10)), T, f""", m AS (SELECT mailing_id, {P} AS pack_id, CAST(created_at - INTERVAL 10 MONTH AS DATE) AS start FROM mailings WHERE tracking_id IS NOT NULL),
l AS (SELECT m.pack_id, mailing_id, date_diff('second', CAST(start AS TIMESTAMP), min(ts)) / 3600.0 AS h FROM m JOIN (SELECT {P} AS pack_id, ts FROM page_views WHERE tracking_id IS NOT NULL) v ON v.pack_id = m.pack_id AND ts >= start AND ts < start + 31 GROUP BY m.pack_id, mailing_id, start)
SELECT pack_id, count(*) AS mailings, round(quantile_cont(CAST(h AS DOUBLE), 0.5), 4) AS p50_hours, round(quantile_cont(CAST(h AS DOUBLE), 0.9), 4) AS p90_hours, round(quantile_cont(CAST(h AS DOUBLE), 0.99), 4) AS p99_hours FROM l GROUP BY 1""")
query("joi25_fk_match_rate", lambda t: K.fk_match_rate(t["mailings"], t["event_master"], "event_id"), T, "SELECT count(*) AS n, count(CASE WHEN e.event_id IS NOT NULL THEN 1 END) AS matched, round(count(CASE WHEN e.event_id IS NOT NULL THEN 1 END) / count(*), 4) AS share FROM mailings m LEFT JOIN event_master e USING (event_id)")
query("joi25_same_pack_share", K.same_pack_share, T, f"SELECT count(*) AS n, count(CASE WHEN {P.replace('tracking_id', 'm.tracking_id')} = {P.replace('tracking_id', 'e.tracking_id')} THEN 1 END) AS same_pack FROM mailings m JOIN event_master e USING (event_id) WHERE m.tracking_id IS NOT NULL")
query("joi26_tracking_consistency", K.tracking_consistency, T, "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n, count(CASE WHEN v.tracking_id = p.tracking_id THEN 1 END) AS same, count(CASE WHEN v.tracking_id <> p.tracking_id THEN 1 END) AS differs, count(CASE WHEN v.tracking_id IS NOT NULL AND p.tracking_id IS NULL THEN 1 END) AS view_only, count(CASE WHEN v.tracking_id IS NULL AND p.tracking_id IS NOT NULL THEN 1 END) AS page_only FROM page_views v LEFT JOIN page_inventory p USING (page_id) GROUP BY 1")
query("joi08_bridge_gpn", K.bridge_gpn, T, "SELECT view_id, gpn, person_key FROM page_views LEFT JOIN hr_employee USING (gpn)")
query("joi10_employee_activity", lambda t: K.employee_activity(t, "1998-01-01"), T, f"{ACT}{WHO}, v AS (SELECT gpn, count(*) AS views FROM page_views WHERE ts >= TIMESTAMP '1998-01-01' AND gpn IS NOT NULL GROUP BY 1), o AS (SELECT person_key, count(*) AS opens FROM a WHERE link_type = 'OPEN' AND event_at >= TIMESTAMP '1998-01-01' GROUP BY 1) SELECT h.person_key, h.gpn, coalesce(views, 0) AS views, coalesce(opens, 0) AS opens, w.region, w.division FROM hr_employee h LEFT JOIN v USING (gpn) LEFT JOIN o USING (person_key) LEFT JOIN w USING (person_key) WHERE coalesce(views, 0) + coalesce(opens, 0) > 0")
query("joi11_person_cross_channel", K.person_cross_channel, T, f"""{ACT}, c AS (SELECT DISTINCT person_key, {P} AS pack_id FROM a JOIN mailings USING (mailing_id) WHERE link_type = 'CLICK' AND tracking_id IS NOT NULL),
v AS (SELECT DISTINCT person_key, {P} AS pack_id FROM page_views JOIN hr_employee USING (gpn) WHERE tracking_id IS NOT NULL)
SELECT coalesce(c.pack_id, v.pack_id) AS pack_id, count(c.person_key) AS clicked, count(v.person_key) AS viewed, count(CASE WHEN c.person_key IS NOT NULL AND v.person_key IS NOT NULL THEN 1 END) AS both FROM c FULL JOIN v ON c.person_key = v.person_key AND c.pack_id = v.pack_id GROUP BY 1""")
query("dq15_reconcile_packs", K.reconcile_packs, T, FACTS + " SELECT pack_id, coalesce(sent, 0) AS sent, coalesce(clicked, 0) AS clicked, coalesce(views, 0) AS views, CASE WHEN coalesce(views, 0) > 2 * coalesce(clicked, 0) THEN 'views_over_clicks' WHEN coalesce(sent, 0) > 0 AND coalesce(views, 0) = 0 THEN 'sent_without_views' ELSE 'ok' END AS finding FROM pf")
query("dq16_pack_spotlight", K.pack_spotlight, T, REGION + f", s AS ({email('2000-01-01')} ORDER BY recipients DESC, pack_id LIMIT 1) SELECT s.*, (SELECT created_by FROM mailings WHERE right(tracking_id, 3) = 'EMI' AND {P} = s.pack_id ORDER BY created_at, mailing_id LIMIT 1) AS creator, v.views FROM s LEFT JOIN (SELECT {P} AS pack_id, count(*) AS views FROM page_views GROUP BY 1) v USING (pack_id)")
query("win02_share_of_total", lambda t: K.share_of_total(K.with_untracked(t).drop("viewers"), "views"), T, f"SELECT coalesce({P}, 'UNATTRIBUTED') AS pack_id, count(*) AS views, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct FROM page_views GROUP BY 1")
SUMS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in ("sent", "opened", "clicked", "views", "registered", "attended"))
query("mea15_dash_overview", K.dash_overview, T, FACTS + f" SELECT count(*) AS packs, {SUMS} FROM pf")
query("mea15_dash_packs", lambda t: K.dash_packs(t, theme="THEME1"), T, THREE + f" SELECT * FROM ({CROSS}) WHERE theme = 'theme1'")
query("mea15_dash_funnel", K.dash_funnel, T, FACTS + f", o AS (SELECT {SUMS} FROM pf), q AS (SELECT unnest([0, 1, 2, 3, 4]) AS place, unnest(['sent', 'opened', 'clicked', 'views', 'registered']) AS step, unnest([sent, opened, clicked, views, registered]) AS n FROM o) SELECT place, step, n, round(CAST(n AS DOUBLE) / nullif(lag(n) OVER (ORDER BY place), 0), 4) AS step_rate FROM q")
query("mea15_dash_weekly", K.dash_weekly, T, FACT + ", q AS (SELECT event_at AS moment, event AS series FROM e UNION ALL SELECT ts, 'view' FROM page_views UNION ALL SELECT registered_on, 'registration' FROM registrations) SELECT CAST(date_trunc('week', moment) AS DATE) AS week, series, count(*) AS n FROM q GROUP BY ALL")
