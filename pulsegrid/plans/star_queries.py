"""Queries over telemetry, the star schema, measures, windows and data quality, with their SQL."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions import tracking as I
from pulsegrid.functions import values as V
from pulsegrid.operators import coverage as C
from pulsegrid.operators import flatten as L
from pulsegrid.operators import measures as S
from pulsegrid.operators import quality as D
from pulsegrid.operators import star as R
from pulsegrid.plans.mail_queries import P
from pulsegrid.plans.raw import raw_custom_events, raw_page_views
from pulsegrid.plans.registry import query
from pulsegrid.sources import sinks
from pulsegrid.sources.exports import export_raw_page_views

T = "page_views hr_history hr_employee mailings receivers engagement page_inventory custom_events sites event_master"
START, END = "2024-01-02", "2024-01-20"
# A view's month is that of its wall time; the test rows are all in winter, one hour ahead of UTC.
VIEWS = f""", v AS (SELECT * FROM page_views WHERE ts >= TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}')"""
TOP = """, n AS (SELECT *, lead(ts) OVER (PARTITION BY source_file, session_id, CASE WHEN session_id IS NULL THEN view_id END ORDER BY ts, view_id) AS next_ts FROM page_views),
f AS (SELECT * EXCLUDE (next_ts), next_ts IS NULL AS is_last_in_session, CASE WHEN date_diff('microsecond', ts, next_ts) <= 1800000000 THEN date_diff('microsecond', ts, next_ts) / 1000000 END AS time_on_page_s FROM n)"""
ASOF = TOP + """, h AS (SELECT lpad(gpn, 8, '0') AS g, snapshot_year * 12 + snapshot_month AS ym, division, country FROM hr_history),
w AS (SELECT f.*, coalesce(b.division, a.division) AS hr_division, coalesce(b.country, a.country) AS hr_country FROM f
  LEFT JOIN LATERAL (SELECT division, country FROM h WHERE h.g = f.gpn AND h.ym <= year(f.ts) * 12 + month(f.ts) ORDER BY ym DESC LIMIT 1) b ON true
  LEFT JOIN LATERAL (SELECT division, country FROM h WHERE h.g = f.gpn AND h.ym > year(f.ts) * 12 + month(f.ts) ORDER BY ym LIMIT 1) a ON true)"""
SESSION = ASOF + """, s AS (SELECT session_id, first(user_id ORDER BY ts, view_id) FILTER (WHERE user_id IS NOT NULL) AS user_id, first(gpn ORDER BY ts, view_id) FILTER (WHERE gpn IS NOT NULL) AS gpn,
  first(hr_division ORDER BY ts, view_id) FILTER (WHERE hr_division IS NOT NULL) AS hr_division, first(hr_country ORDER BY ts, view_id) FILTER (WHERE hr_country IS NOT NULL) AS hr_country,
  min(ts) AS session_start, max(ts) AS session_end, round_even(date_diff('microsecond', min(ts), max(ts)) / 1000000, 0) AS duration_s,
  CAST(coalesce(sum(CAST(round(time_on_page_s * 1000000) AS BIGINT)), 0) AS DOUBLE) / 1000000 AS engagement_s,
  round_even(CAST(sum(CAST(round(time_on_page_s * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 / nullif(count(time_on_page_s), 0), 1) AS avg_time_on_page_s, count(*) AS n_views,
  first(page_id ORDER BY ts, view_id) AS entry_page, last(page_id ORDER BY ts, view_id) AS exit_page, count(*) = 1 AS is_bounce, CAST(min(ts) AS DATE) AS session_date
  FROM w WHERE session_id IS NOT NULL GROUP BY session_id)"""
MEAN = "CAST(sum(CAST(round({0} * 1000000) AS BIGINT)) AS DOUBLE) / 1000000 / nullif(count({0}), 0)"


def fact(t: dict[str, DataFrame]) -> DataFrame:
    return R.fact_page_view(t["page_views"], t["hr_history"])


def sessions(t: dict[str, DataFrame]) -> DataFrame:
    return R.agg_session(fact(t))


def flat(t: dict[str, DataFrame]) -> DataFrame:
    return L.flatten_page_views(raw_page_views(t), START, END)


# telemetry
LOCAL = "ts + INTERVAL 1 HOUR"
TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
query("src05_export_raw_page_views", lambda t: export_raw_page_views(raw_page_views(t), START, END).select(F.col("timestamp [UTC]").alias("at"), "id", "url", "user_Id"), T, VIEWS + f" SELECT {TEXT} AS at, view_id AS id, url, user_id AS user_Id FROM v")
TURN = "CAST(substr(view_id, 2) AS BIGINT) % 4"
FLAT = 'site_id AS "cp_SiteID", page_id AS "cp_PageId", theme AS "cp_Theme", gpn AS "cp_GPN", tracking_id AS "cp_TrackingID"'
query("prj01_parse_custom_dimensions", lambda t: raw_page_views(t).select("id", L.parse_custom_dimensions("customDimensions").alias("m")).select("id", F.size("m").alias("n_keys"), F.col("m")["cp_PageId"].alias("page_id"), F.col("m")["env"].alias("env")), T, f"SELECT view_id AS id, 8 + CASE WHEN gpn IS NULL THEN 0 ELSE 1 END + CASE WHEN tracking_id IS NULL THEN 0 ELSE 1 END + CASE WHEN {TURN} = 2 THEN 1 ELSE 0 END AS n_keys, page_id, 'prod' AS env FROM page_views")
query("prj02_flatten_props", lambda t: L.flatten_props(raw_page_views(t).select("id", L.parse_custom_dimensions("customDimensions").alias("props"))), T, "SELECT view_id AS id, content_type AS \"cp_ContentType\", gpn AS \"cp_GPN\", page_id AS \"cp_PageId\", page_name AS \"cp_PageName\", url AS \"cp_PageURL\", site_id AS \"cp_SiteID\", site_name AS \"cp_SiteName\", theme AS \"cp_Theme\", 'prod' AS env, " + f"CASE WHEN {TURN} < 2 THEN tracking_id WHEN {TURN} = 2 THEN ' ' END AS \"cp_CampaignTrackingID\", CASE WHEN {TURN} >= 2 THEN tracking_id END AS \"cp_Campagne Tracking_ID\" FROM page_views")
query("prj03_flatten_page_views", lambda t: L.newest_first(flat(t), "timestamp [UTC]").select("id", "cp_SiteID", "cp_PageId", "cp_Theme", "cp_GPN", "cp_TrackingID"), T, VIEWS + f" SELECT view_id AS id, {FLAT} FROM v")
CLICK = f", c AS (SELECT * FROM custom_events WHERE name = 'click_event' AND ts >= TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}')"
query("prj04_flatten_click_events", lambda t: L.newest_first(L.flatten_click_events(raw_custom_events(t), START, END), "timestamp").select("id", "cp_Link_Type", "cp_ComponentName", "cp_GPN", "cp_Email"), T, CLICK + ' SELECT event_id AS id, link_type AS "cp_Link_Type", component AS "cp_ComponentName", gpn AS "cp_GPN", email AS "cp_Email" FROM c')
query("prj05_clean_page_views", lambda t: L.clean_page_views(flat(t)).select("view_id", "timestamp", "session_id", "user_id", "page_id", "theme", "gpn", "tracking_id", "cluster", "pack", "channel", "pack_id"), T, VIEWS + f" SELECT view_id, {LOCAL} AS timestamp, session_id, user_id, page_id, theme, gpn, tracking_id, split_part(tracking_id, '-', 1) AS cluster, split_part(tracking_id, '-', 2) AS pack, split_part(tracking_id, '-', 5) AS channel, {P} AS pack_id FROM v")
query("prj06_to_local_ts", lambda t: t["page_views"].select("view_id", V.to_local_ts("ts").alias("local_ts")), T, f"SELECT view_id, {LOCAL} AS local_ts FROM page_views")
query("prj08_normalize_gpn", lambda t: t["page_views"].select("view_id", V.normalize_gpn(F.concat(F.lit(" "), F.col("gpn").cast("int").cast("string"), F.lit(".0"))).alias("gpn")), T, "SELECT view_id, CASE WHEN CAST(gpn AS INTEGER) <> 0 THEN gpn END AS gpn FROM page_views")
query("prj09_parse_tracking_id", lambda t: I.parse_tracking_id(t["page_views"].select("view_id", F.lit(" ").alias("a"), F.col("tracking_id").alias("b")), "a", "b").drop("a", "b"), T, "SELECT view_id, tracking_id, " + ", ".join(f"split_part(tracking_id, '-', {i + 1}) AS {c}" for i, c in enumerate(I.SEGMENTS)) + f", {P} AS pack_id FROM page_views")
query("prj10_split_tracking", lambda t: I.split_tracking(t["page_views"].select("view_id", "tracking_id")), T, "SELECT view_id, tracking_id, " + ", ".join(f"coalesce(split_part(tracking_id, '-', {i + 1}), '') AS {c}" for i, c in enumerate(I.SEGMENTS)) + f", coalesce({P}, '-') AS pack_id FROM page_views")
query("prj11_pack_keys", lambda t: t["mailings"].select("mailing_id", I.pack_key("tracking_id").alias("a"), I.pack_key_split_part("tracking_id").alias("b"), I.activity_date_key("tracking_id").alias("c"), I.channel_suffix("tracking_id").alias("d"), I.is_channel_of("tracking_id", "mail").alias("e")), T, f"SELECT mailing_id, {P} AS a, {P} AS b, array_to_string(string_split(upper(trim(tracking_id)), '-')[1:3], '-') AS c, right(tracking_id, 3) AS d, right(tracking_id, 3) = 'EMI' AS e FROM mailings")
query("prj16_timespan_hours", lambda t: t["engagement"].join(t["receivers"].select("receiver_id", "sent_at"), "receiver_id").select("id", V.timespan_hours("sent_at", "event_at").alias("hours"), V.seconds_to_event("sent_at", "event_at").alias("seconds")), T, "SELECT id, CAST(floor(date_diff('second', sent_at, event_at) / 3600) AS INTEGER) AS hours, date_diff('second', sent_at, event_at) AS seconds FROM engagement JOIN receivers USING (receiver_id)")
query("prj18_label_null", lambda t: L.label_nulls(t["page_inventory"].select("page_id", "page_type", "tracking_id"), "page_type", "tracking_id", label="(none)"), T, "SELECT page_id, coalesce(page_type, '(none)') AS page_type, coalesce(tracking_id, '(none)') AS tracking_id FROM page_inventory")
query("prj20_strip_identity", lambda t: L.strip_identity(t["custom_events"]).select("event_id", "user_id", "name"), T, "SELECT event_id, user_id, name FROM custom_events")
query("prj21_anonymize_clicks", lambda t: L.anonymize_clicks(V.event_family(t["custom_events"], "click_event").select("event_id", "gpn", "email", "link_type"), "test-only"), T, "SELECT event_id, link_type, sha256('test-only' || gpn) AS person_hash FROM custom_events WHERE name = 'click_event'")
query("prj22_view_date_hour", lambda t: L.with_view_date_hour(t["page_views"].select("view_id", "ts")), T, "SELECT view_id, ts, CAST(ts AS DATE) AS view_date, CAST(hour(ts) AS INTEGER) AS view_hour FROM page_views")
query("prj23_format_mmss", lambda t: R.time_on_page(t["page_views"]).select("view_id", V.format_mmss(F.floor("time_on_page_s")).alias("top")), T, TOP + " SELECT view_id, CAST(CAST(floor(floor(time_on_page_s) / 60) AS INTEGER) AS VARCHAR) || ':' || lpad(CAST(CAST(floor(time_on_page_s) AS INTEGER) % 60 AS VARCHAR), 2, '0') AS top FROM f")
query("prj25_compose_tracking_id", lambda t: t["mailings"].filter("tracking_id IS NOT NULL").select("mailing_id", I.compose_tracking_id(F.split_part("tracking_id", F.lit("-"), F.lit(1)), F.split_part("tracking_id", F.lit("-"), F.lit(2)).cast("int"), F.col("created_at"), F.split_part("tracking_id", F.lit("-"), F.lit(4)).cast("int"), F.lit("EMI")).alias("tid")), T, "SELECT mailing_id, split_part(tracking_id, '-', 1) || '-' || split_part(tracking_id, '-', 2) || '-' || strftime(created_at, '%y%m%d') || '-' || split_part(tracking_id, '-', 4) || '-EMI' AS tid FROM mailings WHERE tracking_id IS NOT NULL")
query("cov21_key_inventory", lambda t: C.key_inventory(raw_custom_events(t).select(L.parse_custom_dimensions("customDimensions").alias("props")), exact=True), T, " UNION ALL ".join(f"SELECT '{k}' AS key, count({c}) AS n, count(DISTINCT {c}) AS n_values, min({c}) AS sample FROM custom_events" for k, c in (("cp_GPN", "gpn"), ("cp_Email", "email"), ("cp_PageId", "page_id"), ("cp_Link_Type", "link_type"), ("cp_ComponentName", "component"), ("env", "'prod'"))))
# predicates
query("fil01_in_window", lambda t: t["page_views"].filter(V.in_window("ts", START, END)).select("view_id", "ts"), T, VIEWS + " SELECT view_id, ts FROM v")
query("fil02_optional_eq", lambda t: t["page_views"].filter(V.optional_eq("site_name", "SITE 2") & V.optional_eq("theme", "")).select("view_id"), T, "SELECT view_id FROM page_views WHERE lower(site_name) = 'site 2'")
query("fil03_url_contains", lambda t: V.url_contains(t["page_views"], "S1/p[0-9]+6$", regex=True).select("view_id", "url"), T, "SELECT view_id, url FROM page_views WHERE regexp_matches(url, '(?i)S1/p[0-9]+6$')")
query("fil04_active_only", lambda t: V.active_only(t["engagement"]).select("id"), T, "SELECT id FROM engagement WHERE is_active = 1")
query("fil05_tracked_only", lambda t: V.tracked_only(t["mailings"]).select("mailing_id"), T, "SELECT mailing_id FROM mailings WHERE tracking_id IS NOT NULL")
query("fil06_scope_articles", lambda t: V.scope_articles(t["page_inventory"], t["sites"], "News and events", "2024-09-01").select("page_id"), T, "SELECT page_id FROM page_inventory JOIN sites USING (site_id) WHERE site_name = 'News and events' AND article_date >= DATE '2024-09-01'")
query("fil07_drop_sentinel_dates", lambda t: V.drop_sentinel_dates(t["event_master"]).select("event_id", "event_date"), T, "SELECT event_id, event_date FROM event_master WHERE event_date < DATE '2100-01-01'")
query("fil08_event_family", lambda t: V.event_family(t["custom_events"], "SEARCH_TRIGGERED").select("event_id"), T, "SELECT event_id FROM custom_events WHERE name = 'SEARCH_TRIGGERED'")
query("fil09_filter_members", lambda t: V.filter_members(t["page_views"].select("view_id", "gpn"), t["hr_history"], "gpn", negate=True), T, "SELECT view_id, gpn FROM page_views v WHERE NOT EXISTS (SELECT 1 FROM hr_history h WHERE h.gpn = v.gpn)")
query("fil10_k_anonymous", lambda t: V.k_anonymous(t["page_views"].select("view_id", "user_id", "page_id", F.to_date("ts").alias("day")), ["page_id", "day"], "user_id", 5), T, ", d AS (SELECT view_id, user_id, page_id, CAST(ts AS DATE) AS day FROM page_views) SELECT * FROM d WHERE (page_id, day) IN (SELECT (page_id, day) FROM d GROUP BY page_id, day HAVING count(DISTINCT user_id) >= 5)")
# star schema
query("win01_time_on_page", lambda t: R.time_on_page(t["page_views"]).select("view_id", "time_on_page_s", "is_last_in_session"), T, TOP + " SELECT view_id, time_on_page_s, is_last_in_session FROM f")
query("win01_time_on_page_across_files", lambda t: R.time_on_page(t["page_views"], across_files=True).select("view_id", "is_last_in_session"), T, TOP.replace("source_file, session_id", "session_id") + " SELECT view_id, is_last_in_session FROM f")
query("joi01_hr_asof", lambda t: fact(t).select("view_id", "gpn", "hr_division", "hr_country"), T, ASOF + " SELECT view_id, gpn, hr_division, hr_country FROM w")
query("agg01_agg_session", sessions, T, SESSION + " SELECT * FROM s")
query("agg02_dim_page", lambda t: R.dim_page(t["page_views"]), T, "SELECT page_id, page_name, url, site_id, site_name, theme, content_type FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY source_file, ts, view_id) AS r FROM page_views) WHERE r = 1")
query("agg03_dim_date", lambda t: R.dim_date(t["page_views"]), T, "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name, CAST(week(d) AS INTEGER) AS iso_week, CAST(isodow(d) AS INTEGER) AS weekday, dayname(d) AS weekday_name FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM page_views)")
query("agg04_fact_page_view", fact, T, ASOF + " SELECT * FROM w")
query("joi27_star_join", lambda t: R.star_join(fact(t), R.dim_page(t["page_views"]), R.dim_date(t["page_views"])).groupBy("site_name", "month_name", "weekday").agg(F.count("*").alias("views")), T, "SELECT site_name, monthname(ts) AS month_name, CAST(isodow(ts) AS INTEGER) AS weekday, count(*) AS views FROM page_views GROUP BY ALL")
query("cov22_pipeline_summary", lambda t: R.pipeline_summary(fact(t).select("*"), sessions(t)).drop("mean_top"), T, SESSION + " SELECT (SELECT count(*) FROM f) AS n_views, (SELECT count(time_on_page_s) FROM f) AS n_measured, (SELECT median(time_on_page_s) FROM f) AS median_top, (SELECT round(quantile_cont(time_on_page_s, 0.9), 6) FROM f) AS p90_top, count(*) AS n_sessions, count(CASE WHEN is_bounce THEN 1 END) AS n_bounces, round(avg(n_views), 4) AS mean_pages FROM s")
query("dq17_hr_match_stats", lambda t: R.hr_match_stats(t["page_views"], t["hr_history"]), T, "SELECT count(*) AS n_views, count(CASE WHEN CAST(gpn AS INTEGER) <> 0 THEN 1 END) AS n_with_gpn, count(DISTINCT CASE WHEN CAST(gpn AS INTEGER) <> 0 THEN gpn END) AS n_persons, count(DISTINCT CASE WHEN CAST(gpn AS INTEGER) <> 0 AND gpn IN (SELECT gpn FROM hr_history) THEN gpn END) AS n_matched FROM page_views")
query("win06_first_last", lambda t: R.first_last(t["page_views"].filter("session_id IS NOT NULL"), "session_id", "tracking_id", "ts", "view_id"), T, "SELECT session_id, first(tracking_id ORDER BY ts, view_id) FILTER (WHERE tracking_id IS NOT NULL) AS first_tracking_id, last(tracking_id ORDER BY ts, view_id) FILTER (WHERE tracking_id IS NOT NULL) AS last_tracking_id FROM page_views WHERE session_id IS NOT NULL GROUP BY 1")
query("win07_latest_per_key", lambda t: R.latest_per_key(t["hr_history"], "gpn", F.desc("snapshot_year"), F.desc("snapshot_month")), T, "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY gpn ORDER BY snapshot_year DESC, snapshot_month DESC) AS r FROM hr_history) WHERE r = 1")
query("snk02_append_new_keys", lambda t: sinks.append_new_keys(t["page_inventory"].filter("page_id < 'p3'").select("page_id", "title"), t["page_views"].select("page_id", F.col("page_name").alias("title")), "page_id"), T, ", e AS (SELECT page_id, title FROM page_inventory WHERE page_id < 'p3') SELECT * FROM e UNION ALL SELECT DISTINCT page_id, page_name FROM page_views v WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.page_id = v.page_id)")
query("snk06_merge_upsert", lambda t: sinks.merge_upsert(t["receivers"].select("receiver_id", "log_status"), t["engagement"].filter("is_active = 1").select("receiver_id", F.lit("Seen").alias("log_status")).distinct(), "receiver_id"), T, "SELECT receiver_id, CASE WHEN receiver_id IN (SELECT receiver_id FROM engagement WHERE is_active = 1) THEN 'Seen' ELSE log_status END AS log_status FROM receivers")
query("snk09_dashboard_page_views", lambda t: sinks.dashboard_arrays(t["mailings"], t["mailings"].select(I.pack_key("tracking_id").alias("pack_id"), F.lit("sent").alias("event"), F.col("created_at").alias("day")), t["page_views"].select(I.pack_key("tracking_id").alias("pack_id"), F.to_date("ts").alias("day")), t["mailings"].select(I.pack_key("tracking_id").alias("pack_id"), F.lit("x").alias("status"), F.col("created_at").alias("day")))["page_views"], T, f"SELECT {P} AS pack_id, CAST(ts AS DATE) AS day, count(*) AS n FROM page_views GROUP BY 1, 2")
query("snk10_weighted_sample", lambda t: sinks.weighted_sample(t["page_views"].filter("tracking_id IS NOT NULL").select(I.pack_key("tracking_id").alias("pack_id"), "view_id"), "pack_id", F.md5("view_id"), 200), T, f", v AS (SELECT {P} AS pack_id, view_id, row_number() OVER (PARTITION BY {P} ORDER BY md5(view_id)) AS r, count(*) OVER (PARTITION BY {P}) AS n FROM page_views WHERE tracking_id IS NOT NULL) SELECT pack_id, view_id, n / least(n, 200) AS weight FROM v WHERE r <= 200")
# measures
query("mea01_kpi_views", lambda t: S.kpi_views(t["page_views"], ["site_name"]), T, "SELECT site_name, count(*) AS views, count(DISTINCT user_id) AS visitors, count(*) / count(DISTINCT user_id) AS views_per_visitor FROM page_views GROUP BY 1")
KS = "count(*) AS sessions, count(CASE WHEN is_bounce THEN 1 END) / count(*) AS bounce_rate, sum(n_views) / count(*) AS pages_per_session FROM s GROUP BY 1"
query("mea02_kpi_sessions", lambda t: S.kpi_sessions(sessions(t), ["session_date"]), T, SESSION + " SELECT session_date, " + KS)
query("mea03_kpi_engagement", lambda t: S.kpi_engagement(fact(t), sessions(t)), T, SESSION + f" SELECT {MEAN.format('time_on_page_s')} AS avg_time_on_page_s, count(time_on_page_s) / count(*) AS measurable_share, {MEAN.format('load_ms')} AS avg_load_ms, (SELECT {MEAN.format('duration_s')} FROM s WHERE NOT is_bounce) AS avg_session_s FROM f")
query("mea04_kpi_content", lambda t: S.kpi_content(t["page_views"], ["theme"]), T, "SELECT theme, count(DISTINCT page_id) AS pages, count(*) / count(DISTINCT page_id) AS views_per_page, count(DISTINCT user_id) / count(DISTINCT page_id) AS visitors_per_page FROM page_views GROUP BY 1")
query("mea05_kpi_hr_coverage", lambda t: S.kpi_hr_coverage(fact(t)), T, ASOF + " SELECT count(hr_division) / count(*) AS hr_coverage, count(DISTINCT hr_division) AS divisions FROM w")
CHANGE = ", n AS (SELECT CAST(date_trunc('{0}', {1}) AS DATE) AS period, count(*) AS views, count(DISTINCT {2}) AS visitors FROM {3} GROUP BY 1) SELECT n.*, b.views AS views_before, b.visitors AS visitors_before, (n.views - b.views) / b.views AS views_change, (n.visitors - b.visitors) / b.visitors AS visitors_change FROM n LEFT JOIN n b ON CAST(b.period + INTERVAL 1 {0} AS DATE) = n.period"
query("mea06_week_over_week", lambda t: S.period_change(t["page_views"], "week"), T, CHANGE.format("week", "ts", "user_id", "page_views"))
query("mea06_month_over_month", lambda t: S.period_change(t["engagement"].select("event_at", F.col("person_key").alias("user_id")), "month", "event_at"), T, CHANGE.format("month", "event_at", "person_key", "engagement"))
query("mea07_views_ytd", lambda t: S.views_ytd(t["page_views"]), T, "SELECT CAST(ts AS DATE) AS day, count(*) AS views, CAST(sum(count(*)) OVER (PARTITION BY year(CAST(ts AS DATE)) ORDER BY CAST(ts AS DATE)) AS BIGINT) AS views_ytd FROM page_views GROUP BY CAST(ts AS DATE)")
query("mea08_page_entry_exit", lambda t: S.page_entry_exit(sessions(t), R.dim_page(t["page_views"])), T, SESSION + ", e AS (SELECT entry_page AS page_id, count(*) AS entries, count(CASE WHEN is_bounce THEN 1 END) AS bounces FROM s GROUP BY 1), x AS (SELECT exit_page AS page_id, count(*) AS exits FROM s GROUP BY 1) SELECT page_id, coalesce(entries, 0) AS entries, coalesce(exits, 0) AS exits, coalesce(bounces / entries, 0) AS bounce_rate FROM (SELECT DISTINCT page_id FROM page_views) LEFT JOIN e USING (page_id) LEFT JOIN x USING (page_id)")
query("mea09_heatmap", lambda t: S.heatmap(t["page_views"]), T, "SELECT CAST(d AS INTEGER) AS weekday, CAST(h AS INTEGER) AS hour, count(view_id) AS views FROM (SELECT unnest(range(1, 8)) AS d) CROSS JOIN (SELECT unnest(range(24)) AS h) LEFT JOIN page_views ON isodow(ts) = d AND hour(ts) = h GROUP BY ALL")
PER_PAGE = f"SELECT page_id, count(*) AS views, {MEAN.format('time_on_page_s')} AS avg_s FROM f GROUP BY 1"
query("mea10_engagement_flag", lambda t: S.engagement_flag(fact(t)), T, TOP + f", p AS ({PER_PAGE}) SELECT *, CASE WHEN views > 100 AND avg_s < 10 THEN 'low_engagement' WHEN views < 20 AND avg_s > 120 THEN 'hidden_gem' ELSE 'normal' END AS flag FROM p")
query("mea11_bounce_by_division", lambda t: S.bounce_by_division(sessions(t)), T, SESSION + " SELECT coalesce(hr_division, '(Unknown)') AS division, " + KS)
query("mea11_visitors_by_country", lambda t: S.visitors_by(fact(t), "hr_country"), T, ASOF + " SELECT coalesce(hr_country, '(Unknown)') AS hr_country, count(DISTINCT user_id) AS visitors, count(*) AS views FROM w GROUP BY 1")
query("mea12_division_theme_matrix", lambda t: S.division_theme_matrix(fact(t), [f"theme{i}" for i in range(6)]), T, ASOF + " SELECT coalesce(hr_division, '(Unknown)') AS division, " + ", ".join(f"count(CASE WHEN theme = 'theme{i}' THEN 1 END) AS theme{i}" for i in range(6)) + " FROM w GROUP BY 1")
query("mea13_session_depth", lambda t: S.session_depth(sessions(t)), T, SESSION + " SELECT n_views, count(*) AS sessions FROM s GROUP BY 1")
query("mea14_top_pages", lambda t: S.top_n(t["page_views"], "page_id", 10), T, "SELECT page_id, count(*) AS views FROM page_views GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
query("mea14_page_detail", lambda t: S.page_detail(fact(t), R.dim_page(t["page_views"])), T, TOP + f" SELECT page_id, any_value(page_name) AS page_name, any_value(site_name) AS site_name, count(*) AS views, count(DISTINCT user_id) AS visitors, {MEAN.format('time_on_page_s')} AS avg_s FROM f GROUP BY 1")
query("cov24_bounce_by_division", lambda t: S.bounce_by_division(sessions(t)).filter("sessions >= 10"), T, SESSION + ", b AS (SELECT coalesce(hr_division, '(Unknown)') AS division, " + KS + ") SELECT * FROM b WHERE sessions >= 10")
# windows
SEEN = ", d AS (SELECT site_id, content_type, user_id, CAST(ts AS DATE) AS day FROM page_views), k AS (SELECT DISTINCT site_id, content_type, day FROM d)"
query("win03_datewise_overview", lambda t: S.datewise_overview(t["page_views"].withColumn("day", F.to_date("ts")), ["site_id", "content_type"]), T, SEEN + " SELECT k.*, " + ", ".join(f"(SELECT count(*) FROM d WHERE d.site_id = k.site_id AND d.content_type = k.content_type AND d.day <= k.day AND d.day > k.day - {s}) AS views_{s}d" for s in S.SPANS) + " FROM k")
query("win04_rolling_unique", lambda t: S.rolling_unique(t["page_views"].withColumn("day", F.to_date("ts")), ["site_id", "content_type"], "user_id"), T, SEEN + " SELECT k.*, " + ", ".join(f"(SELECT count(DISTINCT user_id) FROM d WHERE d.site_id = k.site_id AND d.content_type = k.content_type AND d.day <= k.day AND d.day > k.day - {s}) AS users_{s}d" for s in S.SPANS) + " FROM k")
query("win05_pareto_sites", lambda t: S.pareto_sites(t["page_inventory"]), T, ", s AS (SELECT site_id, count(*) AS n FROM page_inventory WHERE tracking_id IS NOT NULL GROUP BY 1), r AS (SELECT *, sum(n) OVER (ORDER BY n DESC, site_id ROWS UNBOUNDED PRECEDING) AS running, sum(n) OVER () AS total FROM s) SELECT site_id, n, round(running * 100.0 / total, 2) AS cumulative_pct, (running - n) * 100 < 80 * total AS in_first_80 FROM r")
# sorting and sets
query("srt01_order_result", lambda t: D.order_result(t["page_inventory"].select("page_id", "article_date"), [("article_date", True), ("page_id", False)]), T, "SELECT page_id, article_date FROM page_inventory")
query("srt02_top_k", lambda t: D.top_k(t["page_inventory"].select("page_id", "article_date"), [("article_date", True), ("page_id", False)], 15), T, "SELECT page_id, article_date FROM page_inventory ORDER BY article_date DESC NULLS LAST, page_id LIMIT 15")
query("srt03_sample_values", lambda t: D.sample_values(t["page_views"], "theme", 4), T, "SELECT DISTINCT theme FROM page_views ORDER BY theme LIMIT 4")
query("set01_union_all", lambda t: D.union_all(t["mailings"].select("tracking_id"), t["page_inventory"].select("tracking_id")), T, "SELECT tracking_id FROM mailings UNION ALL SELECT tracking_id FROM page_inventory")
query("set02_distinct_keys", lambda t: D.distinct_keys(t["page_views"], "page_id", "site_id"), T, "SELECT DISTINCT page_id, site_id FROM page_views")
query("set03_intersect_values", lambda t: D.intersect_values(t["page_views"], t["page_inventory"], "page_id"), T, "SELECT page_id FROM page_views INTERSECT SELECT page_id FROM page_inventory")
query("set04_new_keys", lambda t: D.new_keys(t["page_views"].select("view_id", "gpn"), t["hr_history"], "gpn"), T, "SELECT view_id, gpn FROM page_views WHERE gpn IS NULL OR gpn NOT IN (SELECT gpn FROM hr_history)")
# data quality
MAIL_COLUMNS = (("mailing_id", "string"), ("tracking_id", "string"), ("title", "string"), ("created_by", "string"), ("created_at", "date"), ("event_id", "string"))
PROFILE = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS type, count(*) AS n, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS \"distinct\", (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS x FROM mailings WHERE {c} IS NOT NULL ORDER BY x LIMIT 5)) AS samples FROM mailings" for c, k in MAIL_COLUMNS)
query("dq01_profile_columns", lambda t: D.profile_columns(t["mailings"]), T, PROFILE)
SHARED = {"mailings": ("mailing_id", "tracking_id", "title"), "receivers": ("mailing_id", "receiver_id", "person_key"), "engagement": ("mailing_id", "receiver_id", "person_key")}
COLS = ", c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS t, '{c}' AS c, count(DISTINCT {c}) AS d FROM {n}" for n, cs in SHARED.items() for c in cs) + ")"
query("dq02_candidate_keys", lambda t: D.candidate_keys({n: D.profile_columns(t[n].select(*cs)) for n, cs in SHARED.items()}), T, COLS + " SELECT c AS \"column\", count(*) AS n_tables, string_agg(t || ':' || d, ',' ORDER BY t) AS tables FROM c GROUP BY 1 HAVING count(*) > 1")
KEYS = {"mailings": "mailing_id", "receivers": "mailing_id", "page_inventory": "page_id", "page_views": "page_id"}
OVER = ", v AS (" + " UNION ALL ".join(f"SELECT DISTINCT '{n}' AS t, {c} AS v FROM {n}" for n, c in KEYS.items()) + "), z AS (SELECT t, count(*) AS n FROM v GROUP BY 1), p AS (SELECT x.t AS a, y.t AS b, count(*) AS shared FROM v x JOIN v y ON x.v = y.v AND x.t < y.t GROUP BY ALL), q AS (SELECT a, b, za.n AS n_a, zb.n AS n_b, shared, round(shared / za.n, 4) AS share_a, round(shared / zb.n, 4) AS share_b FROM p JOIN z za ON za.t = a JOIN z zb ON zb.t = b)"
query("dq03_key_overlap", lambda t: D.key_overlap({n: t[n] for n in KEYS}, KEYS), T, OVER + " SELECT *, CASE WHEN share_a > 0.9 AND share_b > 0.9 THEN '1:1' WHEN share_a > 0.9 AND share_b < 0.5 THEN '1:N' WHEN share_b > 0.9 AND share_a < 0.5 THEN 'N:1' ELSE 'M:N' END AS relation FROM q")
query("dq04_pattern_counts", lambda t: D.pattern_counts(t["hr_employee"], "^[0-9]{8}$"), T, " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, count(CASE WHEN regexp_matches({c}, '^[0-9]{{8}}$') THEN 1 END) AS matches FROM hr_employee" for c in ("person_key", "gpn", "org_unit")))
query("dq04_table_fingerprint", lambda t: D.table_fingerprint({"page_views": (t["page_views"], "view_id", "ts"), "mailings": (t["mailings"], "mailing_id", "created_at")}), T, " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS n, count(DISTINCT {k}) AS keys, CAST(min({c}) AS DATE) AS first, CAST(max({c}) AS DATE) AS last FROM {n}" for n, k, c in (("page_views", "view_id", "ts"), ("mailings", "mailing_id", "created_at"))))
query("dq05_enum_counts", lambda t: D.enum_counts(t["receivers"], ["log_status", "language", "is_active"]), T, " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM receivers GROUP BY 2" for c in ("log_status", "language", "is_active")))
query("dq06_dedup_profile", lambda t: D.dedup_profile(t["engagement"]), T, ", g AS (SELECT link_type, count(*) AS n FROM engagement GROUP BY link_type, mailing_id, person_key) SELECT link_type, CAST(sum(n) AS BIGINT) AS rows, count(*) AS pairs, min(n) AS least, max(n) AS most, round(sum(n) / count(*), 4) AS mean FROM g GROUP BY 1")
query("dq06_most_repeated", lambda t: D.most_repeated(t["engagement"]), T, ", g AS (SELECT mailing_id, count(*) - 1 AS more FROM engagement GROUP BY mailing_id, link_type, person_key) SELECT mailing_id, CAST(sum(more) AS BIGINT) AS extra FROM g GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
query("dq07_temporal_coverage", lambda t: D.temporal_coverage({"receivers": (t["receivers"], "sent_at"), "mailings": (t["mailings"], "created_at")}), T, " UNION ALL ".join(f"SELECT '{n}' AS \"table\", CAST(year({c}) AS INTEGER) AS year, count(*) AS n, CAST(min({c}) AS DATE) AS first, CAST(max({c}) AS DATE) AS last FROM {n} GROUP BY 2" for n, c in (("receivers", "sent_at"), ("mailings", "created_at"))))
query("dq09_id_conformance", lambda t: D.id_conformance(t["page_inventory"]), T, f"SELECT count(*) AS n, count(CASE WHEN tracking_id IS NULL THEN 1 END) AS nulls, count(CASE WHEN trim(tracking_id) = '' THEN 1 END) AS empty, count(CASE WHEN regexp_matches(tracking_id, '{I.CONFORMANT}') THEN 1 END) AS conformant, count(CASE WHEN NOT regexp_matches(tracking_id, '{I.CONFORMANT}') THEN 1 END) AS malformed, count(CASE WHEN tracking_id <> upper(tracking_id) THEN 1 END) AS mixed_case FROM page_inventory")
query("dq10_duplicate_keys", lambda t: D.duplicate_keys(t["hr_history"], "gpn", "division"), T, "SELECT gpn, count(*) AS n, count(DISTINCT division) AS n_values, coalesce(string_agg(DISTINCT division, ',' ORDER BY division), '') AS \"values\" FROM hr_history GROUP BY 1 HAVING count(*) > 1")
query("dq19_match_strategies", lambda t: D.match_strategies(t["page_views"], "gpn", t["hr_employee"], {"gpn": F.col("gpn"), "rewritten": F.regexp_replace("person_key", "^t", "00"), "person_key": F.col("person_key")}), T, ", w AS (SELECT DISTINCT gpn AS v FROM page_views WHERE gpn IS NOT NULL) SELECT 'gpn' AS strategy, count(DISTINCT gpn) AS hits FROM hr_employee WHERE gpn IN (SELECT v FROM w) UNION ALL SELECT 'rewritten', count(DISTINCT regexp_replace(person_key, '^t', '00')) FROM hr_employee WHERE regexp_replace(person_key, '^t', '00') IN (SELECT v FROM w) UNION ALL SELECT 'person_key', count(DISTINCT person_key) FROM hr_employee WHERE person_key IN (SELECT v FROM w)")
