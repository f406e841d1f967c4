"""Tracking coverage of pages, mailings and views; inventories of telemetry."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.tracking import channel_suffix, pack_key, split_tracking
from pulsegrid.functions.values import label_null, optional_eq, scope_articles, url_contains
from pulsegrid.operators.packs import FLOOR, SITE

Tables = Mapping[str, DataFrame]
_n = lambda: F.count("*")


def pct(a: Column, b: Column) -> Column:
    return F.round(F.try_divide(a.cast("double") * 100, b.cast("double")), 2)


def _packs() -> Column:
    """Distinct packs; a row without an id adds none."""
    return F.count_distinct(pack_key("tracking_id"))


def coverage_overall(pages: DataFrame) -> DataFrame:
    both = F.col("tracking_id").isNotNull() & F.col("article_date").isNotNull()
    return pages.agg(_n().alias("pages"), F.count("tracking_id").alias("with_tid"), F.count("article_date").alias("with_date"), F.count_if(both).alias("with_both"), pct(F.count("tracking_id"), _n()).alias("pct_tid"), pct(F.count("article_date"), _n()).alias("pct_date"))


def coverage_by_site(t: Tables, more_than: int = 10, top: int = 100) -> DataFrame:
    p = t["page_inventory"].join(t["sites"], "site_id", "left").groupBy("site_id", "site_name", "site_url")
    p = p.agg(_n().alias("pages"), F.count("tracking_id").alias("with_tid"), F.count("article_date").alias("dated"), pct(F.count("tracking_id"), _n()).alias("pct_tid"), _packs().alias("packs"))
    return p.filter(F.col("pages") > more_than).orderBy(F.desc("with_tid"), F.desc("pct_tid"), "site_id").limit(top)


def top_article_sites(t: Tables, top: int = 50) -> DataFrame:
    p = t["page_inventory"].filter("tracking_id IS NOT NULL").join(t["sites"], "site_id", "left").groupBy("site_id", "site_name")
    suffix = channel_suffix("tracking_id")
    p = p.agg(_n().alias("pages"), F.min("article_date").alias("earliest"), F.max("article_date").alias("latest"), _packs().alias("packs"), F.count_distinct(suffix).alias("n_suffixes"), F.array_join(F.array_sort(F.collect_set(suffix)), ",").alias("suffixes"))
    return p.orderBy(F.desc("pages"), "site_id").limit(top)


def coverage_trend(pages: DataFrame, as_of: str, months: int = 36, ready_pct: float = 80) -> DataFrame:
    """Articles per month of the last `months`, with coverage and whether it is enough for a funnel."""
    p = pages.filter(F.col("article_date") >= F.add_months(F.lit(as_of).cast("date"), -months)).groupBy(F.trunc("article_date", "month").alias("month"))
    p = p.agg(_n().alias("articles"), F.count("tracking_id").alias("with_tid"), pct(F.count("tracking_id"), _n()).alias("pct_tid"))
    return p.withColumn("ready", F.col("with_tid") * 100 >= ready_pct * F.col("articles")).orderBy("month")


def first_ready_month(pages: DataFrame, as_of: str, ready_pct: float = 80) -> DataFrame:
    return coverage_trend(pages, as_of, ready_pct=ready_pct).filter("ready").agg(F.min("month").alias("first_ready"))


def coverage_by_month(t: Tables) -> DataFrame:
    """Monthly coverage of the scoped site's articles, newest first."""
    p = scope_articles(t["page_inventory"], t["sites"], SITE, FLOOR).groupBy(F.trunc("article_date", "month").alias("month"))
    return p.agg(_n().alias("articles"), F.count("tracking_id").alias("tracked"), pct(F.count("tracking_id"), _n()).alias("pct")).orderBy(F.desc("month"))


def coverage_by_type(pages: DataFrame, top: int = 50) -> DataFrame:
    p = pages.groupBy(label_null("page_type", "(null)").alias("page_type")).agg(_n().alias("pages"), F.count("tracking_id").alias("with_tid"), pct(F.count("tracking_id"), _n()).alias("pct_tid"))
    return p.orderBy(F.desc("pages"), "page_type").limit(top)


def coverage_by_traffic(t: Tables) -> DataFrame:
    """Classes of pages by what they have, weighted by their views."""
    kind = F.when(F.col("tracking_id").isNotNull(), "tracked").when(F.col("article_date").isNotNull(), "article_no_tid").otherwise("non_article")
    m = t["metrics"].groupBy("page_id").agg(_n().alias("rows"), F.sum("views").alias("views"), F.sum("visits").alias("visits"))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    g = t["page_inventory"].select("page_id", kind.alias("page_class")).join(m, "page_id", "left").groupBy("page_class").agg(F.count_distinct("page_id").alias("pages"), zero("rows"), zero("views"), zero("visits"))
    return g.withColumn("pct_views", pct(F.col("views"), F.sum("views").over(Window.partitionBy())))


def pack_intersection(t: Tables) -> DataFrame:
    """Packs of mail and of pages, those in both, and their share; one row from one aggregate."""
    m = t["mailings"].filter((channel_suffix("tracking_id") == "EMI") & (F.col("created_at") >= F.lit(FLOOR).cast("date"))).select(pack_key("tracking_id").alias("pack_id"), F.lit(1).alias("m")).distinct()
    p = scope_articles(t["page_inventory"], t["sites"], SITE, FLOOR).filter("tracking_id IS NOT NULL").select(pack_key("tracking_id").alias("pack_id"), F.lit(1).alias("p")).distinct()
    both = F.count_if(F.col("m").isNotNull() & F.col("p").isNotNull())
    return m.join(p, "pack_id", "full_outer").agg(F.count("m").alias("mail_packs"), F.count("p").alias("page_packs"), both.alias("in_both"), pct(both, F.count("m")).alias("pct"))


def tracking_format_probe(t: Tables) -> DataFrame:
    """How the ids of each system look."""
    def probe(df: DataFrame, name: str) -> DataFrame:
        c = F.col("tracking_id")
        return df.filter(c.isNotNull()).agg(F.lit(name).alias("system"), _n().alias("n"), F.round(F.avg(F.length(c)), 2).alias("mean_length"), F.count_if(F.length(c) == 32).alias("n_32"), F.count_if(c == F.upper(c)).alias("n_upper"), F.count_if(c != F.trim(c)).alias("n_blank"), F.count_if(F.size(F.split(c, "-")) == 5).alias("n_5_parts"))

    return probe(t["mailings"], "mail").unionByName(probe(t["page_inventory"], "pages"))


def id_overlap(a: DataFrame, b: DataFrame, key: str = "tracking_id") -> DataFrame:
    """Ids on both sides, on one side only, and the Jaccard similarity."""
    x, y = (d.filter(F.col(key).isNotNull()).select(key, F.lit(1).alias(n)).distinct() for d, n in ((a, "a"), (b, "b")))
    j = x.join(y, key, "full_outer")
    both = F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull())
    return j.agg(both.alias("both"), F.count_if(F.col("b").isNull()).alias("only_left"), F.count_if(F.col("a").isNull()).alias("only_right"), F.round(F.try_divide(both.cast("double"), _n().cast("double")), 6).alias("jaccard"))


def suffix_volume(t: Tables) -> DataFrame:
    """Ids by channel suffix in each system."""
    s = lambda df, n: df.filter("tracking_id IS NOT NULL").select(channel_suffix("tracking_id").alias("suffix"), F.lit(n).alias("system"))
    g = s(t["mailings"], "mail").unionByName(s(t["page_inventory"], "pages")).groupBy("suffix")
    return g.agg(F.count_if(F.col("system") == "mail").alias("mail"), F.count_if(F.col("system") == "pages").alias("pages")).orderBy(F.desc("mail"), F.desc("pages"), "suffix")


def suffix_by_month(views: DataFrame, suffix: str) -> DataFrame:
    return views.filter(F.col("tracking_id").endswith(suffix)).groupBy(F.trunc("ts", "month").alias("month")).agg(_n().alias("n"))


def adoption_by_year(t: Tables) -> DataFrame:
    m = t["mailings"].groupBy(F.year("created_at").alias("year"))
    return m.agg(_n().alias("mailings"), F.count("tracking_id").alias("tracked"), F.count_distinct("tracking_id").alias("ids"), F.count_distinct(F.when(channel_suffix("tracking_id") == "EMI", pack_key("tracking_id"))).alias("packs"))


def url_id_cardinality(pages: DataFrame) -> DataFrame:
    g = pages.filter("url IS NOT NULL").groupBy("url").agg(_n().alias("n"), F.count_distinct("tracking_id").alias("ids"))
    return g.agg(F.sum("n").alias("pages"), _n().alias("urls"), pct(_n(), F.sum("n")).alias("pct_urls"), F.count_if(F.col("ids") > 1).alias("urls_with_several_ids"))


def pv_coverage_by_site(views: DataFrame, most: int = 20) -> DataFrame:
    g = views.groupBy("site_name").agg(_n().alias("views"), F.count("tracking_id").alias("with_tid"), F.count_distinct("tracking_id").alias("ids"), F.slice(F.array_sort(F.collect_set(channel_suffix("tracking_id"))), 1, most).alias("c"))
    return g.select("site_name", "views", "with_tid", pct(F.col("with_tid"), F.col("views")).alias("pct"), "ids", F.array_join("c", ",").alias("channels"))


def pv_coverage(views: DataFrame) -> DataFrame:
    return views.agg(_n().alias("views"), F.count("tracking_id").alias("with_tid"), pct(F.count("tracking_id"), _n()).alias("pct"), _packs().alias("packs"))


def views_by_channel(views: DataFrame) -> DataFrame:
    return views.groupBy(label_null(channel_suffix("tracking_id"), "(untracked)").alias("channel")).agg(_n().alias("views"))


def top_pages(views: DataFrame, pages: DataFrame, tracked: bool, n: int = 15) -> DataFrame:
    """The most viewed pages with, or without, tracking ids."""
    v = views.filter(F.col("tracking_id").isNotNull() if tracked else F.col("tracking_id").isNull()).groupBy("page_id").agg(_n().alias("views"), F.count_distinct("user_id").alias("users"), F.count_distinct("tracking_id").alias("ids"))
    return v.join(pages.select("page_id", "page_name", "site_name"), "page_id", "left").orderBy(F.desc("views"), "page_id").limit(n)


def _distinct(c: str, exact: bool) -> Column:
    return F.count_distinct(c) if exact else F.approx_count_distinct(c)


def _seen(g, exact: bool) -> DataFrame:  # noqa: ANN001
    return g.agg(_n().alias("views"), _distinct("user_id", exact).alias("users"), _distinct("session_id", exact).alias("sessions"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def url_summary(views: DataFrame, pattern: str, exact: bool = False) -> DataFrame:
    return _seen(url_contains(views, pattern).groupBy(), exact)


def url_breakout(views: DataFrame, pattern: str, exact: bool = False) -> DataFrame:
    return _seen(url_contains(views, pattern).groupBy("url"), exact).orderBy(F.desc("views"), "url")


def site_summary(views: DataFrame, site_id: str | None = None, site_name: str | None = None, start: str | None = None, exact: bool = True) -> DataFrame:
    v = views.filter(optional_eq("site_id", site_id) & optional_eq("site_name", site_name))
    v = v.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz")) if start else v
    return v.groupBy("site_id", "site_name").agg(_n().alias("views"), _distinct("user_id", exact).alias("users"), _distinct("page_id", exact).alias("pages"), pct(F.count("tracking_id"), _n()).alias("pct_tracked"))


def views_by_tracking(views: DataFrame, cluster: str | None = None, pack: str | None = None, channel: str | None = None) -> DataFrame:
    """Tracked views with split ids, optionally of one cluster, pack or channel, newest first."""
    v = split_tracking(views.filter("coalesce(tracking_id, '') <> ''"))
    return v.filter(optional_eq("cluster", cluster) & optional_eq("pack", pack) & optional_eq("channel", channel)).select("view_id", "ts", "tracking_id", "cluster", "pack", "activity_date", "activity", "channel", "pack_id").orderBy(F.desc("ts"), "view_id")


def event_inventory(events: DataFrame) -> DataFrame:
    return events.groupBy("name").agg(_n().alias("n"), F.count_distinct("user_id").alias("users")).orderBy(F.desc("n"), "name")


def link_type_distribution(events: DataFrame) -> DataFrame:
    return events.filter(F.col("name") == "click_event").groupBy("link_type").agg(_n().alias("n"), F.count_distinct("user_id").alias("users")).orderBy(F.desc("n"), "link_type")


def key_inventory(df: DataFrame, col: str = "props", exact: bool = False) -> DataFrame:
    """For each key of a map column: rows, distinct values, and a sample (the least value)."""
    return df.select(F.explode(col).alias("key", "value")).groupBy("key").agg(_n().alias("n"), _distinct("value", exact).alias("n_values"), F.min("value").alias("sample"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n) of several tables in one result."""
    return reduce(DataFrame.unionByName, (df.agg(F.lit(name).alias("table"), _n().alias("n")) for name, df in tables.items()))


def metrics_by_page_day(t: Tables, since: str) -> DataFrame:
    """Metrics of tracked pages with page and site, by day."""
    p = t["page_inventory"].filter("tracking_id IS NOT NULL").select("page_id", "tracking_id", "article_date", "site_id").join(t["sites"].select("site_id", "site_name"), "site_id", "left")
    m = t["metrics"].filter(F.col("day_key") >= since).join(p, "page_id")
    s = F.sum(F.col("duration_sum").cast("decimal(18,2)")).cast("double")
    return m.groupBy("tracking_id", "article_date", "page_id", "site_name", "day_key").agg(F.sum("views").alias("views"), F.sum("visits").alias("visits"), s.alias("duration_s"), F.try_divide(s, F.sum("visits").cast("double")).alias("avg_s"), F.sum("comments").alias("comments"), F.count_distinct("contact_id").alias("contacts"), F.count_distinct("app").alias("apps"))


def views_tracked_untracked(t: Tables) -> DataFrame:
    p = t["page_inventory"].select("page_id", "tracking_id")
    return t["metrics"].join(p, "page_id", "left").groupBy(label_null("tracking_id", "(untracked)").alias("tracking_id")).agg(F.sum("views").alias("views"))


def views_with_tracking(t: Tables) -> DataFrame:
    p = t["page_inventory"].filter("tracking_id IS NOT NULL").select("page_id", F.col("tracking_id").alias("page_tracking_id"), "title")
    return t["page_views"].join(p, "page_id").select("view_id", "page_id", "page_tracking_id", "title")


def clicks_with_tracking(t: Tables) -> DataFrame:
    c = t["custom_events"].filter(F.col("name") == "click_event").select("event_id", "page_id", "link_type")
    return c.join(t["page_inventory"].select("page_id", "tracking_id"), "page_id")


def clicks_with_person(t: Tables) -> DataFrame:
    c = t["custom_events"].filter(F.col("name") == "click_event").select("event_id", "gpn", "component")
    return c.join(t["hr_employee"].select("gpn", "person_key"), "gpn")


def views_by_day(t: Tables) -> DataFrame:
    return t["metrics"].join(t["page_inventory"].filter("tracking_id IS NOT NULL").select("page_id", "tracking_id"), "page_id").groupBy("tracking_id", "day_key").agg(F.sum("views").alias("views"))


def cta_clicks(t: Tables) -> DataFrame:
    """Clicks by tracking id of the page and label of the component."""
    return clicks_with_tracking(t).join(t["custom_events"].select("event_id", "component"), "event_id").groupBy(label_null("tracking_id", "(untracked)").alias("tracking_id"), "component").agg(_n().alias("clicks"))


def page_date_rollup(t: Tables) -> DataFrame:
    """Metrics by page and day over the applications."""
    return t["metrics"].groupBy("page_id", "day_key").agg(F.sum("views").alias("views"), F.sum("visits").alias("visits"), F.sum("comments").alias("comments"))


def interactions_metrics(views: DataFrame) -> DataFrame:
    """The metric fact from raw views: page, day and contact, with views, visits (hours) and time."""
    g = views.groupBy("page_id", F.date_format("ts", "yyyyMMdd").alias("day_key"), F.col("user_id").alias("contact_id"))
    return g.agg(_n().alias("views"), F.count_distinct(F.date_trunc("hour", "ts")).alias("visits"), F.sum(F.col("load_ms").cast("decimal(18,2)")).cast("double").alias("duration_sum"))


def interactions_fact(views: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The metric fact from raw views (page_id, ts, contact_id, app, duration, is_comment): page x day x contact x application, with
    views, visits, summed and mean duration, and comments.

    A visit is a session window: views of one contact on one page in one application without a pause of `gap`; it counts on the day
    it begins, so that a day may have views and no visit."""
    keys = ("page_id", "day_key", "contact_id", "app")
    v = views.withColumn("day_key", F.date_format("ts", "yyyyMMdd"))
    total = F.sum(F.col("duration").cast("decimal(18,2)")).cast("double")
    by_day = v.groupBy(*keys).agg(_n().alias("views"), total.alias("duration_sum"), F.try_divide(total, F.count("duration").cast("double")).alias("duration_avg"), F.count_if("is_comment").alias("comments"))
    visits = v.groupBy("page_id", "contact_id", "app", F.session_window("ts", gap).alias("w")).agg(F.date_format(F.min("ts"), "yyyyMMdd").alias("day_key"))
    visits = visits.groupBy(*keys).agg(_n().alias("visits"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    out = by_day.alias("a").join(visits.alias("b"), same, "left")
    return out.select(*(F.col(f"a.{k}").alias(k) for k in keys), "views", F.coalesce("visits", F.lit(0)).alias("visits"), "duration_sum", "duration_avg", "comments")


def interactions_window(metrics: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Metrics by page over the `days` up to a day."""
    day = F.to_date("day_key", "yyyyMMdd")
    end = F.lit(as_of).cast("date")
    m = metrics.filter((day <= end) & (day > F.date_sub(end, days)))
    return m.groupBy("page_id").agg(F.sum("views").alias("views"), F.sum("visits").alias("visits"), F.count_distinct("contact_id").alias("contacts"))
