"""Campaign packs across channels.  Systems meet on the first two segments of the tracking id only, and each
channel is aggregated to packs before they meet."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.tracking import channel_suffix, is_channel_of, pack_key
from pulsegrid.functions.values import active_only, apart, optional_eq, scope_articles, share
from pulsegrid.operators import mail, star

Tables = Mapping[str, DataFrame]
FLOOR, SITE = "2024-09-01", "News and events"


def _tracked(df: DataFrame) -> DataFrame:
    return df.filter("tracking_id IS NOT NULL").withColumn("pack_id", pack_key("tracking_id"))


def full_outer_packs(*dfs: DataFrame, key: str = "pack_id") -> DataFrame:
    """Full outer join of frames with one row per key."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), dfs)


def _mails(t: Tables, floor: str = FLOOR) -> DataFrame:
    m = t["mailings"].filter(is_channel_of("tracking_id", "mail") & (F.col("created_at") >= F.lit(floor).cast("date")))
    return _tracked(m).select("mailing_id", "pack_id")


def email_pack(t: Tables, floor: str = FLOOR) -> DataFrame:
    """Mailings, recipients, unique opens and clicks per pack."""
    r = mail.mailing_by_dim(t, "region", "country")
    zero = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    return _mails(t, floor).join(r, "mailing_id", "left").groupBy("pack_id").agg(F.count_distinct("mailing_id").alias("mailings"), zero("n").alias("recipients"), zero("unique_opens").alias("unique_opens"), zero("unique_clicks").alias("unique_clicks"))


def email_region_pack(t: Tables, floor: str = FLOOR) -> DataFrame:
    """The same per pack, region and country."""
    r = _mails(t, floor).join(mail.mailing_by_dim(t, "region", "country"), "mailing_id")
    zero = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    g = r.groupBy("pack_id", "region", "country").agg(zero("n").alias("recipients"), zero("unique_opens").alias("unique_opens"), zero("unique_clicks").alias("unique_clicks"))
    return g.filter("recipients > 0").orderBy("pack_id", F.desc("recipients"), "region", "country")


def _exact(c: str) -> Column:
    """A sum of doubles with two decimals that does not depend on their order."""
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def intranet_pack(t: Tables, floor: str = FLOOR) -> DataFrame:
    """Pages, views, visits, time and readers per pack, on the pages of the scoped site."""
    pages = _tracked(scope_articles(t["page_inventory"], t["sites"], SITE, floor).filter(is_channel_of("tracking_id", "pages"))).select("page_id", "pack_id")
    m = pages.join(t["metrics"], "page_id")
    return m.groupBy("pack_id").agg(F.count_distinct("page_id").alias("pages"), F.sum("views").alias("page_views"), F.sum("visits").alias("page_visits"), _exact("duration_sum").alias("duration_s"), F.count_distinct("contact_id").alias("readers"))


def plan_dim(t: Tables) -> DataFrame:
    """Planned activities with their pack and cluster."""
    p = t["plan_packs"].join(t["plan_clusters"], "cluster_id", "left")
    return t["plan_activities"].join(p, "pack_id", "left").select(F.upper(F.trim("tracking_id")).alias("tracking_id"), pack_key("tracking_id").alias("pack_id"), "pack_name", "theme", "target_region", "cluster_name", "publish_date")


def pack_dim(t: Tables) -> DataFrame:
    """One row per planned pack."""
    some = [F.min(c).alias(c) for c in ("pack_name", "theme", "target_region", "cluster_name", "publish_date")]
    return plan_dim(t).groupBy("pack_id").agg(*some)


def cross_channel_fact(t: Tables) -> DataFrame:
    """The pack fact: plan, mail and intranet side by side, with rates."""
    f = full_outer_packs(pack_dim(t), email_pack(t), intranet_pack(t)).filter("pack_id IS NOT NULL")
    pct = lambda a, b: F.round(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")) * 100, 2)
    f = f.withColumns({
        "open_rate_pct": pct("unique_opens", "recipients"), "click_rate_pct": pct("unique_clicks", "recipients"), "avg_duration_s": F.round(F.try_divide(F.col("duration_s"), F.col("page_visits").cast("double")), 1),
        "click_to_view_pct": pct("page_views", "unique_clicks"), "reach_pct": pct("readers", "recipients"),
    })
    return f.orderBy(F.coalesce("recipients", "page_views", F.lit(0)).desc(), "pack_id")


def intranet_pack_from_metrics(t: Tables, since: str) -> DataFrame:
    """Views, visits, time and viewers per pack from a day key on."""
    m = t["metrics"].filter(F.col("day_key") >= since).join(_tracked(t["page_inventory"]).select("page_id", "pack_id"), "page_id")
    return m.groupBy("pack_id").agg(F.sum("views").alias("views"), F.sum("visits").alias("visits"), _exact("duration_sum").alias("duration_s"), F.count_distinct("contact_id").alias("viewers"))


def pack_from_facts(t: Tables) -> DataFrame:
    """Counts of mail events, views and registrations per pack, joined full outer."""
    n = lambda kind, name: F.count_if(F.col("event") == kind).alias(name)
    m = _tracked(mail.fact_email(t)).groupBy("pack_id").agg(n("sent", "sent"), n("bounced", "bounced"), n("opened", "opened"), n("clicked", "clicked"))
    v = _tracked(t["page_views"]).groupBy("pack_id").agg(F.count("*").alias("views"), F.count_distinct("user_id").alias("viewers"))
    return full_outer_packs(m, v, mail.event_pack(t))


def pack_overview(t: Tables) -> DataFrame:
    """Planned packs first, with what mail and intranet have of them."""
    return pack_dim(t).join(email_pack(t), "pack_id", "left").join(intranet_pack(t), "pack_id", "left")


def coverage_status(t: Tables, both_only: bool = False) -> DataFrame:
    """Packs by where they occur: both, email_only or sp_only."""
    m = _tracked(t["mailings"]).select("pack_id", F.lit(1).alias("m")).distinct()
    p = _tracked(t["page_inventory"]).select("pack_id", F.lit(1).alias("p")).distinct()
    s = m.join(p, "pack_id", "inner" if both_only else "full_outer")
    return s.select("pack_id", F.when(F.col("m").isNull(), "sp_only").when(F.col("p").isNull(), "email_only").otherwise("both").alias("coverage_status"))


def pair_ids_by_pack(t: Tables) -> DataFrame:
    """Mail ids and page ids of the same pack."""
    m = _tracked(t["mailings"]).select("pack_id", F.col("tracking_id").alias("mail_id")).distinct()
    return m.join(_tracked(t["page_inventory"]).select("pack_id", F.col("tracking_id").alias("page_tracking_id")).distinct(), "pack_id")


def with_untracked(t: Tables, label: str = "UNATTRIBUTED") -> DataFrame:
    """Views per pack, those without a tracking id under a label."""
    return t["page_views"].groupBy(F.coalesce(pack_key("tracking_id"), F.lit(label)).alias("pack_id")).agg(F.count("*").alias("views"), F.count_distinct("user_id").alias("viewers"))


def pack_dim_from_masters(t: Tables) -> DataFrame:
    """Packs from the masters of mailings and events: first date, titles and channels, and planned audience."""
    m = _tracked(t["mailings"]).select("pack_id", F.col("created_at").alias("day"), channel_suffix("tracking_id").alias("channel"), F.lit("mailing").alias("kind"))
    e = _tracked(t["event_master"]).select("pack_id", F.col("event_date").alias("day"), channel_suffix("tracking_id").alias("channel"), F.lit("event").alias("kind"))
    g = m.unionByName(e).groupBy("pack_id").agg(F.min("day").alias("first_day"), F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("channels"), F.count_if(F.col("kind") == "mailing").alias("mailings"), F.count_if(F.col("kind") == "event").alias("events"))
    audience = t["receivers"].join(_tracked(t["mailings"]).select("mailing_id", "pack_id"), "mailing_id").groupBy("pack_id").agg(F.count_distinct("person_key").alias("audience"))
    return g.join(audience, "pack_id", "left")


def pack_created(t: Tables) -> DataFrame:
    return _tracked(t["mailings"]).groupBy("pack_id").agg(F.min("created_at").alias("created"), F.count("*").alias("mailings"))


GRAINS = {"cluster": 1, "pack": 2, "activity": 4}


def rollup_grain(t: Tables, grain: str) -> DataFrame:
    """Mail events by cluster, pack or activity."""
    key = F.array_join(F.slice(F.split("tracking_id", "-"), 1, GRAINS[grain]), "-").alias(grain)
    return mail.fact_email(t).filter("tracking_id IS NOT NULL").groupBy(key, "event").agg(F.count("*").alias("n"))


def rollup_all(t: Tables) -> DataFrame:
    """All grains and the total in one pass: absent levels are null."""
    f = mail.fact_email(t).filter("tracking_id IS NOT NULL").select(F.split("tracking_id", "-").alias("s"))
    f = f.select(F.get("s", 0).alias("cluster"), F.get("s", 1).alias("pack"), F.get("s", 3).alias("activity"))
    return f.rollup("cluster", "pack", "activity").agg(F.count("*").alias("n"))


def attribution_lag(t: Tables, days: int = 30, sent_on: Column | None = None) -> DataFrame:
    """Per pack: mailings with a view of the pack within `days` after sent_on (the day of creation), and percentiles of the hours to the first.

    Views are cut to the first of each pack and day, mailings to their number of each pack and day; the next view is found in one order of both."""
    v = _tracked(t["page_views"]).filter("ts IS NOT NULL").groupBy("pack_id", F.to_date("ts").alias("day")).agg(F.min("ts").cast("timestamp_ntz").alias("at")).drop("day")
    m = _tracked(t["mailings"]).select("pack_id", "mailing_id", (F.col("created_at") if sent_on is None else sent_on).cast("date").cast("timestamp_ntz").alias("at"))
    m = m.filter("at IS NOT NULL").distinct().groupBy("pack_id", "at").agg(F.count("*").alias("n"))
    s = F.timestamp_diff("SECOND", F.col("at"), F.col("next_at"))
    lag = next_view(m, v, "pack_id").filter(F.col("next_at") < F.date_add(F.to_date("at"), days + 1).cast("timestamp_ntz")).withColumn("hours", s / 3600)
    return lag.groupBy("pack_id").agg(F.sum("n").alias("mailings"), *(F.round(F.percentile("hours", q, F.col("n")), 4).alias(f"p{int(q * 100)}_hours") for q in (0.5, 0.9, 0.99)))


def next_view(sends: DataFrame, views: DataFrame, key: str, split_hours: int = 24) -> DataFrame:
    """sends (key, at, ..) with `next_at`, the first view (key, at) of the same key at or after the send: a forward as-of join.

    Both sides lie in one order within (key, stretch of time), so that a key with most rows is many tasks; what is not
    found in its stretch comes from the first view of the next stretch that has one, carried over a row for each stretch."""
    rest = [c for c in sends.columns if c not in (key, "at")]
    kind = sends.schema
    both = sends.withColumn("seen", F.lit(None).cast(kind["at"].dataType)).unionByName(views.select(key, "at", F.col("at").alias("seen"), *(F.lit(None).cast(kind[c].dataType).alias(c) for c in rest)))
    both = both.withColumn("__stretch", F.floor(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("at")) / (3600 * split_hours)))
    backwards = Window.partitionBy(key, "__stretch").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__within", F.min("seen").over(backwards)).filter("seen IS NULL")
    later = Window.partitionBy(key).orderBy(F.desc("__stretch")).rowsBetween(Window.unboundedPreceding, -1)  # a row a stretch
    carried = both.groupBy(key, "__stretch").agg(F.min("seen").alias("first")).select(key, "__stretch", F.min("first").over(later).alias("__later"))
    return found.join(carried, [key, "__stretch"], "left").select(*sends.columns, F.coalesce("__within", "__later").alias("next_at"))


def send_lags(t: Tables, days: int = 30, top: int = 20, since: str | None = None) -> DataFrame:
    """For the `top` largest mailings (by receivers, of sends since a day): receivers, those with a view of the mailing's pack at or
    within `days` after their send, and percentiles of the hours to the first such view; and all of them together.

    Sends of one mailing at one time are one row with their number."""
    r = t["receivers"].filter(F.col("sent_at") >= F.lit(since).cast("timestamp_ntz")) if since else t["receivers"]
    m = _tracked(t["mailings"]).select("mailing_id", "pack_id")
    largest = r.join(m, "mailing_id").groupBy("mailing_id").agg(F.count("*").alias("receivers")).orderBy(F.desc("receivers"), "mailing_id").limit(top)
    sends = r.join(m.join(largest, "mailing_id"), "mailing_id").groupBy("pack_id", "mailing_id", F.col("sent_at").cast("timestamp_ntz").alias("at")).agg(F.count("*").alias("n"))
    views = _tracked(t["page_views"]).join(sends.select("pack_id").distinct(), "pack_id", "left_semi").select("pack_id", F.col("ts").cast("timestamp_ntz").alias("at")).distinct()
    lag = next_view(sends, views, "pack_id").withColumn("s", F.timestamp_diff("SECOND", "at", "next_at"))
    hours = F.when(F.col("s") <= days * 86400, F.col("s") / 3600)
    g = lag.withColumn("h", hours).groupingSets([["mailing_id"], []], "mailing_id")
    q = [F.round(F.percentile("h", p, F.col("n")), 4).alias(f"p{int(p * 100)}_hours") for p in (0.5, 0.9, 0.99)]
    return g.agg(F.sum("n").alias("receivers"), F.sum(F.when(F.col("h").isNotNull(), F.col("n")).otherwise(0)).alias("with_view"), *q)


def fk_match_rate(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: rows with a key, those that the other side knows, and their share."""
    known = right.select(key).distinct().withColumn("known", F.lit(1))
    g = left.groupBy(key).agg(F.count("*").alias("n")).filter(F.col(key).isNotNull()).join(known, key, "left")
    g = g.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("known") == 1, F.col("n")).otherwise(0)).alias("matched"))
    return g.withColumn("share", share(F.col("matched"), F.col("n")))


def same_pack_share(t: Tables) -> DataFrame:
    """Mailings with an event: how many have an event of the same pack."""
    e = t["event_master"].select("event_id", pack_key("tracking_id").alias("event_pack"))
    m = t["mailings"].join(e, "event_id").filter("tracking_id IS NOT NULL")
    return m.agg(F.count("*").alias("n"), F.count_if(pack_key("tracking_id") == F.col("event_pack")).alias("same_pack"))


def tracking_consistency(t: Tables) -> DataFrame:
    """Per month: views, those whose id agrees with the page's, differs, or is on one side only."""
    p = t["page_inventory"].select("page_id", F.col("tracking_id").alias("page_tid"))
    v = t["page_views"].join(p, "page_id", "left").groupBy(F.trunc("ts", "month").alias("month"))
    a, b = F.col("tracking_id"), F.col("page_tid")
    return v.agg(F.count("*").alias("n"), F.count_if(a == b).alias("same"), F.count_if(a != b).alias("differs"), F.count_if(a.isNotNull() & b.isNull()).alias("view_only"), F.count_if(a.isNull() & b.isNotNull()).alias("page_only"))


def bridge_gpn(t: Tables) -> DataFrame:
    """Page views with the person key of the HR row that has both keys; keys stay strings."""
    e = t["hr_employee"].select(F.col("gpn").alias("__g"), "person_key")
    return t["page_views"].join(e, apart(F.col("gpn"), "view_id") == F.col("__g"), "left").select("view_id", "gpn", "person_key")


def employee_activity(t: Tables, since: str) -> DataFrame:
    """Views and opens per employee since a day, both aggregated first; employees with neither are left out."""
    floor = F.lit(since).cast("timestamp_ntz")
    v = t["page_views"].filter(F.col("ts") >= floor).filter("gpn IS NOT NULL").groupBy("gpn").agg(F.count("*").alias("views"))
    o = active_only(t["engagement"]).filter((F.col("link_type") == "OPEN") & (F.col("event_at") >= floor)).groupBy("person_key").agg(F.count("*").alias("opens"))
    e = t["hr_employee"].join(v, "gpn", "left").join(o, "person_key", "left").select("person_key", "gpn", F.coalesce("views", F.lit(0)).alias("views"), F.coalesce("opens", F.lit(0)).alias("opens"))
    return mail.enrich_hr(e.filter(F.col("views") + F.col("opens") > 0), t, ("region", "division"))


def person_cross_channel(t: Tables) -> DataFrame:
    """Per pack: persons who clicked its mail, who viewed its pages, and who did both."""
    clicked = active_only(t["engagement"]).filter(F.col("link_type") == "CLICK").join(_tracked(t["mailings"]).select("mailing_id", "pack_id"), "mailing_id").select("person_key", "pack_id", F.lit(1).alias("c")).distinct()
    viewed = _tracked(t["page_views"]).filter("gpn IS NOT NULL").select("gpn", "pack_id").distinct().join(t["hr_employee"].select("gpn", "person_key"), "gpn").select("person_key", "pack_id", F.lit(1).alias("v")).distinct()
    both = clicked.join(viewed, ["person_key", "pack_id"], "full_outer")
    return both.groupBy("pack_id").agg(F.count("c").alias("clicked"), F.count("v").alias("viewed"), F.count_if(F.col("c").isNotNull() & F.col("v").isNotNull()).alias("both"))


def reconcile_packs(t: Tables) -> DataFrame:
    """Packs whose views exceed twice their clicks, or that were sent without any view."""
    f = pack_from_facts(t)
    z = lambda c: F.coalesce(c, F.lit(0))
    return f.select("pack_id", z("sent").alias("sent"), z("clicked").alias("clicked"), z("views").alias("views"), F.when(z("views") > 2 * z("clicked"), "views_over_clicks").when((z("sent") > 0) & (z("views") == 0), "sent_without_views").otherwise("ok").alias("finding"))


def pack_spotlight(t: Tables) -> DataFrame:
    """The pack with most recipients, with its facts and its first mailing's creator."""
    top = email_pack(t, "2000-01-01").orderBy(F.desc("recipients"), "pack_id").limit(1)
    m = _tracked(t["mailings"].filter(is_channel_of("tracking_id", "mail"))).select("pack_id", F.struct("created_at", "mailing_id").alias("o"), "created_by")
    who = m.join(top.select("pack_id"), "pack_id").groupBy("pack_id").agg(F.min_by("created_by", "o").alias("creator"))
    return top.join(who, "pack_id").join(with_untracked(t).select("pack_id", "views"), "pack_id", "left")


def pack_end_to_end(t: Tables, as_of: str, days: int = 90) -> DataFrame:
    """One row for the pack with most recipients of the `days` up to a day: cluster, date of publication, receivers sent to, who
    opened and clicked, page views, readers, mean time on page, and the full name of the first mailing's creator.

    Receivers are cut to the days, and all else to the pack, before anything is counted."""
    end = F.lit(as_of).cast("date")
    m = _tracked(t["mailings"]).select("mailing_id", "pack_id", "created_at", "created_by")
    r = t["receivers"].filter((F.to_date("sent_at") <= end) & (F.to_date("sent_at") > F.date_sub(end, days))).join(m.select("mailing_id", "pack_id"), "mailing_id")
    top = r.groupBy("pack_id").agg(F.count_distinct("person_key").alias("recipients")).orderBy(F.desc("recipients"), "pack_id").limit(1)
    sent = r.filter("log_status <> 'Bounce'").join(top.select("pack_id"), "pack_id", "left_semi").groupBy("pack_id").agg(F.count_distinct("person_key").alias("sent"))
    mine = m.join(top.select("pack_id"), "pack_id", "left_semi")
    did = lambda k: F.count_distinct(F.when(F.col("link_type") == k, F.col("person_key")))
    seen = active_only(t["engagement"]).join(mine.select("mailing_id", "pack_id"), "mailing_id").join(r.select("mailing_id", "receiver_id"), ["mailing_id", "receiver_id"], "left_semi")
    seen = seen.groupBy("pack_id").agg(did("OPEN").alias("opened"), did("CLICK").alias("clicked"))
    fact = star.time_on_page(t["page_views"])  # a view's time needs its whole session
    v = _tracked(fact).join(top.select("pack_id"), "pack_id", "left_semi")
    micro = F.sum(F.round(F.col("time_on_page_s") * 1_000_000).cast("long"))
    v = v.groupBy("pack_id").agg(F.count("*").alias("page_views"), F.count_distinct("user_id").alias("readers"), F.round(F.try_divide(micro / 1_000_000, F.count("time_on_page_s")), 4).alias("avg_time_on_page_s"))
    first = mine.groupBy("pack_id").agg(F.min_by("created_by", F.struct("created_at", "mailing_id")).alias("creator"))
    first = first.join(t["hr_names"].select(F.col("person_key").alias("creator"), "full_name"), "creator", "left").select("pack_id", F.col("full_name").alias("creator_name"))
    plan = t["plan_activities"].withColumn("pack_id", F.upper(F.trim("pack_id"))).join(top.select("pack_id"), "pack_id", "left_semi").groupBy("pack_id").agg(F.min("publish_date").alias("publish_date"))
    out = top.join(plan, "pack_id", "left").join(sent, "pack_id", "left").join(seen, "pack_id", "left").join(v, "pack_id", "left").join(first, "pack_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select("pack_id", F.split_part("pack_id", F.lit("-"), F.lit(1)).alias("cluster_id"), "publish_date", "recipients", *(zero(c) for c in ("sent", "opened", "clicked", "page_views", "readers")), "avg_time_on_page_s", "creator_name")


def share_of_total(df: DataFrame, measure: str) -> DataFrame:
    """Adds the percentage of the grand total; the frame should be an aggregate."""
    total = F.sum(measure).over(Window.partitionBy())
    return df.withColumn("pct", F.round(F.try_divide(F.col(measure).cast("double") * 100, total.cast("double")), 2))


def dash_overview(t: Tables) -> DataFrame:
    f = pack_from_facts(t)
    return f.agg(F.count("*").alias("packs"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sent", "opened", "clicked", "views", "registered", "attended")))


def dash_packs(t: Tables, theme: str | None = None, region: str | None = None) -> DataFrame:
    return cross_channel_fact(t).filter(optional_eq("theme", theme) & optional_eq("target_region", region))


def dash_funnel(t: Tables) -> DataFrame:
    """Sent, opened, clicked, viewed, registered over all packs, each with its share of the step before."""
    names = ("sent", "opened", "clicked", "views", "registered")
    f = dash_overview(t).select(F.posexplode(F.array(*(F.struct(F.lit(n).alias("step"), F.col(n).alias("n")) for n in names))).alias("place", "s")).select("place", "s.*")
    return f.withColumn("step_rate", share(F.col("n"), F.lag("n").over(Window.orderBy("place"))))  # five rows


def dash_weekly(t: Tables) -> DataFrame:
    """Events per ISO week and channel."""
    week = lambda c: F.trunc(c, "week").alias("week")
    n = F.count("*").alias("n")
    m = mail.email_by_week(t).select("week", F.col("event").alias("series"), "n")
    v = t["page_views"].groupBy(week("ts"), F.lit("view").alias("series")).agg(n)
    r = t["registrations"].groupBy(week("registered_on"), F.lit("registration").alias("series")).agg(n)
    return m.unionByName(v).unionByName(r)
