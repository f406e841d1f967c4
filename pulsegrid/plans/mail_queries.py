"""Queries over e-mail facts, with their SQL."""

from pyspark.sql import functions as F

from pulsegrid.operators import mail as M
from pulsegrid.plans.registry import query

ALL = "mailings receivers engagement hr_employee hr_costcenter hr_user template_links element_values elements components event_master registrations page_views"
PACK = "array_to_string(string_split(upper(trim({0})), '-')[1:2], '-')"
P = PACK.format("tracking_id")
ACT = ", a AS (SELECT * FROM engagement WHERE is_active = 1)"
WHO = ", w AS (SELECT person_key, region, country, division, area FROM hr_employee LEFT JOIN hr_costcenter USING (org_unit))"
FACT = f""", a AS (SELECT * FROM engagement WHERE is_active = 1){WHO}, f AS (
  SELECT mailing_id, receiver_id, person_key, CASE WHEN log_status = 'Bounce' THEN 'bounced' ELSE 'sent' END AS event, sent_at AS event_at, NULL AS agent FROM receivers
  UNION ALL SELECT mailing_id, receiver_id, person_key, CASE link_type WHEN 'OPEN' THEN 'opened' ELSE 'clicked' END, event_at, agent FROM a),
e AS (SELECT f.mailing_id, f.receiver_id, f.person_key, event, event_at, agent, tracking_id, w.region, w.division, town FROM f LEFT JOIN mailings USING (mailing_id) LEFT JOIN w ON w.person_key = f.person_key LEFT JOIN hr_user ON lower(user_key) = lower(f.person_key))"""
GOLD = FACT + ", g AS (SELECT mailing_id, tracking_id, person_key, event, date_trunc('hour', event_at) AS hour, region, division, count(*) AS n FROM e GROUP BY ALL)"


def kinds(key: str, of: str) -> str:
    return f"SELECT {key}, count(DISTINCT CASE WHEN link_type = 'OPEN' THEN {of} END) AS unique_opens, count(DISTINCT CASE WHEN link_type = 'CLICK' THEN {of} END) AS unique_clicks, count(CASE WHEN link_type = 'CLICK' THEN 1 END) AS total_clicks FROM a GROUP BY {key}"


query("joi02_email_event_chain", M.email_event_chain, ALL, f"""{ACT}{WHO}
SELECT m.mailing_id, tracking_id, title, r.receiver_id, r.person_key, sent_at, log_status, a.id AS event_row, a.link_type, a.agent, a.event_at, w.region, w.division
FROM mailings m JOIN receivers r ON m.mailing_id = r.mailing_id LEFT JOIN a ON a.mailing_id = r.mailing_id AND a.receiver_id = r.receiver_id LEFT JOIN w ON w.person_key = r.person_key""")
query("joi03_email_sends", M.email_sends, ALL, "SELECT mailing_id, tracking_id, title, receiver_id, person_key, sent_at, log_status FROM receivers JOIN mailings USING (mailing_id)")
query("joi04_email_engagement", lambda t: M.email_engagement(t, "1997-01-01"), ALL, "SELECT mailing_id, tracking_id, receiver_id, person_key, link_type, agent, event_at FROM engagement JOIN mailings USING (mailing_id) WHERE is_active = 1 AND event_at >= TIMESTAMP '1997-01-01'")
query("joi05_send_to_event", M.send_to_event, ALL, "SELECT e.id, e.mailing_id, e.receiver_id, link_type, CAST(date_diff('second', sent_at, event_at) AS BIGINT) AS seconds FROM engagement e JOIN receivers r ON e.mailing_id = r.mailing_id AND e.receiver_id = r.receiver_id WHERE e.is_active = 1")
query("joi06_fact_email", M.fact_email, ALL, FACT + " SELECT * FROM e")
query("joi07_enrich_hr", lambda t: M.enrich_hr(t["engagement"].select("id", "person_key"), t), ALL, WHO + " SELECT e.id, e.person_key, region, country, division, area FROM engagement e LEFT JOIN w ON w.person_key = e.person_key")
query("joi09_join_ci", lambda t: M.join_ci(t["hr_employee"].select("person_key"), t["hr_user"], "person_key", "user_key"), ALL, "SELECT person_key, user_key, town FROM hr_employee LEFT JOIN hr_user ON lower(person_key) = lower(user_key)")
query("joi16_event_registrations", M.event_registrations, ALL, "SELECT event_id, person_key, status, registered_on, tracking_id, title, event_date FROM registrations JOIN event_master USING (event_id) WHERE event_date < DATE '2100-01-01'")
query("joi16_event_counts", lambda t: M.event_registrations(t).groupBy("event_id", "title").agg(F.count("*").alias("n")), ALL, "SELECT event_id, title, count(*) AS n FROM registrations JOIN event_master USING (event_id) WHERE event_date < DATE '2100-01-01' GROUP BY ALL")
query("joi17_template_links", M.template_links, ALL, "SELECT link_id, mailing_id, title, url, label FROM template_links JOIN mailings USING (mailing_id)")
CLICKS = ACT + ", c AS (SELECT mailing_id, link_no, count(*) AS clicks, count(DISTINCT person_key) AS clickers FROM a WHERE link_type = 'CLICK' GROUP BY ALL)"
query("joi17_clicks_per_url", M.clicks_per_url, ALL, CLICKS + " SELECT url, CAST(coalesce(sum(clicks), 0) AS BIGINT) AS clicks FROM template_links LEFT JOIN c USING (mailing_id, link_no) GROUP BY url")
query("joi18_template_components", M.template_components, ALL, "SELECT link_id, mailing_id, url, key_name, element_order, component_name FROM template_links LEFT JOIN element_values USING (value_id) LEFT JOIN elements USING (element_id) LEFT JOIN components USING (component_id)")
query("agg10_email_pack_from_events", M.email_pack_from_events, ALL, f"""{ACT}, i AS (SELECT mailing_id, {P} AS pack_id FROM mailings WHERE tracking_id IS NOT NULL),
s AS (SELECT pack_id, count(*) AS sends FROM receivers JOIN i USING (mailing_id) GROUP BY 1),
u AS (SELECT pack_id, count(DISTINCT CASE WHEN link_type = 'OPEN' THEN person_key END) AS o, count(DISTINCT CASE WHEN link_type = 'CLICK' THEN person_key END) AS c FROM a JOIN i USING (mailing_id) GROUP BY 1)
SELECT pack_id, sends, coalesce(o, 0) AS unique_opens, coalesce(c, 0) AS unique_clicks FROM s LEFT JOIN u USING (pack_id)""")
query("agg11_pack_funnel", M.pack_funnel, ALL, f"""{ACT}, i AS (SELECT mailing_id, {P} AS pack_id FROM mailings WHERE tracking_id IS NOT NULL),
s AS (SELECT pack_id, count(DISTINCT receiver_id) AS sent FROM receivers JOIN i USING (mailing_id) GROUP BY 1),
u AS (SELECT pack_id, count(DISTINCT CASE WHEN link_type = 'OPEN' THEN id END) AS opened, count(DISTINCT CASE WHEN link_type = 'CLICK' THEN id END) AS clicked FROM a JOIN i USING (mailing_id) GROUP BY 1),
v AS (SELECT {P} AS pack_id, count(*) AS views FROM page_views WHERE tracking_id IS NOT NULL GROUP BY 1)
SELECT pack_id, sent, coalesce(opened, 0) AS opened, coalesce(clicked, 0) AS clicked, coalesce(views, 0) AS views FROM s LEFT JOIN u USING (pack_id) LEFT JOIN v USING (pack_id)""")
query("agg14_gold_email_fact", M.gold_email_fact, ALL, GOLD + " SELECT * FROM g")
query("agg15_gold_email_by_dim", M.gold_email_by_dim, ALL, GOLD + " SELECT tracking_id, region, division, event, CAST(sum(n) AS BIGINT) AS n FROM g GROUP BY ALL")
query("agg15_gold_email_by_pack", M.gold_email_by_pack, ALL, GOLD + f" SELECT {P} AS pack_id, " + ", ".join(f"count(DISTINCT CASE WHEN event = '{e}' THEN person_key END) AS {e}" for e in ("sent", "opened", "clicked")) + " FROM g WHERE tracking_id IS NOT NULL GROUP BY 1")
MULTI = ACT + ", d AS (SELECT mailing_id, person_key, string_agg(DISTINCT agent, ' & ' ORDER BY agent) AS agents, count(DISTINCT agent) AS n FROM a WHERE link_type = 'CLICK' GROUP BY ALL)"
query("agg16_multi_device", M.multi_device, ALL, MULTI + " SELECT mailing_id, person_key, agents FROM d WHERE n > 1")
query("agg16_multi_device_any_mailing", lambda t: M.multi_device(t, per_mailing=False), ALL, ACT + " SELECT person_key, string_agg(DISTINCT agent, ' & ' ORDER BY agent) AS agents FROM a WHERE link_type = 'CLICK' GROUP BY 1 HAVING count(DISTINCT agent) > 1")
query("prj15_device_labels", M.device_labels, ALL, MULTI + " SELECT CASE WHEN n > 1 THEN 'desktop & mobile' WHEN regexp_matches(lower(agent), 'mobile|iphone|android|ipad') THEN 'mobile Only' ELSE 'desktop Only' END AS device, count(*) AS clicks FROM a JOIN d USING (mailing_id, person_key) WHERE link_type = 'CLICK' GROUP BY 1")
SPAN = ACT + WHO + ", x AS (SELECT a.*, r.sent_at, CAST(floor(date_diff('second', r.sent_at, a.event_at) / 3600) AS INTEGER) AS hours FROM a JOIN receivers r ON a.mailing_id = r.mailing_id AND a.receiver_id = r.receiver_id), y AS (SELECT x.*, w.region, w.country, w.division, w.area, CAST(event_at AS DATE) AS event_date, CAST(hour(event_at) AS INTEGER) AS event_hour, CASE WHEN hours < 24 THEN '24h' WHEN hours < 72 THEN '72h' WHEN hours < 168 THEN '1w' WHEN hours < 2520 THEN '15w' ELSE '15m+' END AS timespan FROM x LEFT JOIN w ON w.person_key = x.person_key)"
for dims in (("event_date",), ("event_date", "event_hour"), ("division", "area"), ("region", "country")):
    query(f"agg17_timespan_by_{'_'.join(dims)}", lambda t, dims=dims: M.timespan_rollup(t, *dims), ALL, SPAN + f" SELECT timespan, {', '.join(dims)}, link_type, count(*) AS n, count(DISTINCT receiver_id) AS receivers FROM y GROUP BY ALL")
for dims in (("region", "country"), ("division",)):
    c = ", ".join(dims)
    on = " AND ".join(f"n.{d} IS NOT DISTINCT FROM u.{d}" for d in dims)
    query(f"agg18_mailing_by_{dims[0]}", lambda t, dims=dims: M.mailing_by_dim(t, *dims), ALL, f"""{ACT}{WHO}, n AS (SELECT mailing_id, {c}, count(*) AS n FROM receivers LEFT JOIN w USING (person_key) GROUP BY ALL),
u AS (SELECT mailing_id, {c}, count(DISTINCT CASE WHEN link_type = 'OPEN' THEN person_key END) AS o, count(DISTINCT CASE WHEN link_type = 'CLICK' THEN person_key END) AS k FROM a LEFT JOIN w USING (person_key) GROUP BY ALL)
SELECT n.*, nullif(o, 0) AS unique_opens, nullif(k, 0) AS unique_clicks FROM n LEFT JOIN u ON n.mailing_id = u.mailing_id AND {on}""")
KPI = ACT + """, k AS (SELECT r.mailing_id, r.language, sent, coalesce(opened, 0) AS opened, coalesce(clicked, 0) AS clicked FROM (SELECT mailing_id, language, count(CASE WHEN log_status <> 'Bounce' THEN 1 END) AS sent FROM receivers GROUP BY ALL) r
LEFT JOIN (SELECT mailing_id, language, count(DISTINCT CASE WHEN link_type = 'OPEN' THEN person_key END) AS opened, count(DISTINCT CASE WHEN link_type = 'CLICK' THEN person_key END) AS clicked FROM a GROUP BY ALL) e ON r.mailing_id = e.mailing_id AND r.language = e.language)"""
query("agg19_mailing_kpi", M.mailing_kpi, ALL, KPI + " SELECT mailing_id, language, unnest(['sent', 'opened', 'clicked']) AS measure, unnest([sent, opened, clicked]) AS value FROM k")
query("agg20_pivot_kpi", lambda t: M.pivot_kpi(M.mailing_kpi(t)), ALL, KPI + " SELECT mailing_id, CAST(sum(sent) AS BIGINT) AS sent, CAST(sum(opened) AS BIGINT) AS opened, CAST(sum(clicked) AS BIGINT) AS clicked FROM k GROUP BY 1")
LINKS = CLICKS + ", l AS (SELECT mailing_id, link_id, component_name, coalesce(clicks, 0) AS clicks, coalesce(clickers, 0) AS clickers FROM template_links LEFT JOIN element_values USING (value_id) LEFT JOIN elements USING (element_id) LEFT JOIN components USING (component_id) LEFT JOIN c USING (mailing_id, link_no))"
query("agg21_link_engagement", M.link_engagement, ALL, LINKS + " SELECT * FROM l")
query("agg22_mailing_funnel", M.mailing_funnel, ALL, ACT + " " + kinds("mailing_id", "receiver_id"))
query("agg23_agent_breakdown", M.agent_breakdown, ALL, ACT + " SELECT agent, link_type, count(*) AS n, count(DISTINCT receiver_id) AS receivers FROM a GROUP BY ALL")
query("agg31_event_pack", M.event_pack, ALL, f"SELECT {P} AS pack_id, count(*) AS registered, count(CASE WHEN status = 'attended' THEN 1 END) AS attended, count(CASE WHEN status = 'no_show' THEN 1 END) AS no_show FROM registrations JOIN event_master USING (event_id) WHERE event_date < DATE '2100-01-01' GROUP BY 1")
query("dq08_audience_size", M.audience_size, ALL, f"""{ACT}, m AS (SELECT mailing_id, created_at FROM mailings ORDER BY created_at DESC, mailing_id LIMIT 20), u AS ({kinds("mailing_id", "person_key")})
SELECT mailing_id, created_at, coalesce(n, 0) AS recipients, coalesce(unique_opens, 0) AS unique_opens, coalesce(unique_clicks, 0) AS unique_clicks FROM m LEFT JOIN (SELECT mailing_id, count(*) AS n FROM receivers GROUP BY 1) r USING (mailing_id) LEFT JOIN u USING (mailing_id)""")
query("dq11_top_creators", M.top_creators, ALL, WHO + " SELECT person_key, mailings, tracked, region, division FROM (SELECT created_by AS person_key, count(*) AS mailings, count(tracking_id) AS tracked FROM mailings GROUP BY 1) LEFT JOIN w USING (person_key) ORDER BY mailings DESC, person_key LIMIT 10")
query("dq12_multi_device_share", M.multi_device_share, ALL, MULTI + ", s AS (SELECT mailing_id, count(*) AS receivers FROM receivers GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20) SELECT mailing_id, receivers, count(person_key) AS clickers, count(CASE WHEN n > 1 THEN 1 END) AS multi, round(count(CASE WHEN n > 1 THEN 1 END) / nullif(count(person_key), 0), 4) AS share FROM s LEFT JOIN d USING (mailing_id) GROUP BY ALL")
query("dq13_dead_links", M.dead_links, ALL, LINKS + " SELECT mailing_id, count(*) AS links, count(CASE WHEN clicks = 0 THEN 1 END) AS dead, round(count(CASE WHEN clicks = 0 THEN 1 END) / count(*), 4) AS share FROM l GROUP BY 1")
query("dq14_null_region", M.null_region, ALL, "SELECT CAST(year(sent_at) AS INTEGER) AS year, count(*) AS n, count(CASE WHEN region IS NULL THEN 1 END) AS no_region, count(CASE WHEN person_key IS NULL THEN 1 END) AS no_person, count(CASE WHEN org_unit IS NULL AND person_key IS NOT NULL THEN 1 END) AS no_employee, 0 AS no_org_unit, count(CASE WHEN org_unit IS NOT NULL AND region IS NULL THEN 1 END) AS no_costcenter FROM receivers LEFT JOIN hr_employee USING (person_key) LEFT JOIN hr_costcenter USING (org_unit) GROUP BY 1")
