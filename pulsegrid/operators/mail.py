"""E-mail facts: sends, opens and clicks of mailings, per recipient, mailing, link and organisation.

Receivers and engagement are the large tables; each is aggregated on its own before they meet, so that
no product of sends, opens and clicks arises.  Tables t are a mapping by name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.tracking import pack_key
from pulsegrid.functions.values import active_only, apart, final_device_type, seconds_to_event, share, timespan_hours

Tables = Mapping[str, DataFrame]
ORG = ("region", "country", "division", "area")


def enrich_hr(df: DataFrame, t: Tables, columns: tuple[str, ...] = ORG) -> DataFrame:
    """Adds organisation columns by person_key; rows without an employee or cost centre stay, and those without a
    person are spread by a hash of the row."""
    who = t["hr_employee"].select("person_key", "org_unit").join(t["hr_costcenter"], "org_unit", "left").select(F.col("person_key").alias("__who"), *columns)
    rest = [c for c in df.columns if c != "person_key"]
    return df.join(who, apart(F.col("person_key"), *rest) == F.col("__who"), "left").select("person_key", *rest, *columns)


def _people(t: Tables, columns: tuple[str, ...], users: tuple[str, ...] | None = None) -> DataFrame:
    """What HR has of each person, a row for each key without regard to case: `__orgs`, the different organisations of each
    spelling with their number of employees, and, unless users is None, `__users`, the different rows of HR users with their number."""
    who = t["hr_employee"].filter("person_key IS NOT NULL").select("person_key", "org_unit").join(t["hr_costcenter"].select("org_unit", *columns), "org_unit", "left")
    orgs = who.groupBy("person_key", *columns).agg(F.count("*").alias("times")).groupBy(F.lower("person_key").alias("__k")).agg(F.collect_list(F.struct("person_key", "times", *columns)).alias("__orgs"))
    if users is None:
        return orgs
    u = t["hr_user"].filter("user_key IS NOT NULL").groupBy(F.lower("user_key").alias("__k"), *users).agg(F.count("*").alias("times"))
    return orgs.join(u.groupBy("__k").agg(F.collect_list(F.struct("times", *users)).alias("__users")), "__k", "full_outer")


def _person(*rest: str) -> Column:
    """The key of _people that a row with a person_key looks for."""
    return apart(F.lower("person_key"), *rest)


def _spread(df: DataFrame, columns: tuple[str, ...], users: tuple[str, ...] | None = None) -> DataFrame:
    """Rows that have met _people, one for each different match, with its columns and `__times`, the number of matches alike.
    Rows are multiplied here only, after they have been moved, so that keys which many persons share do not multiply what is moved."""
    rest = [c for c in df.columns if c not in ("__k", "__orgs", "__users")]
    mine = F.filter("__orgs", lambda o: o["person_key"] == F.col("person_key"))
    out = df.select(*rest, *(["__users"] if users is not None else []), F.explode_outer(mine).alias("__o"))
    times = F.coalesce("__o.times", F.lit(1))
    if users is not None:
        out, times = out.select(*rest, "__o", F.explode_outer("__users").alias("__u")), times * F.coalesce("__u.times", F.lit(1))
    return out.select(*rest, *(F.col(f"__o.{c}") for c in columns), *(F.col(f"__u.{c}") for c in users or ()), times.alias("__times"))


def _repeated(df: DataFrame) -> DataFrame:
    """As many rows as __times says."""
    return df.withColumn("__times", F.explode(F.array_repeat(F.lit(0), F.col("__times").cast("int")))).drop("__times")


def join_ci(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "left") -> DataFrame:
    """An equality join without regard to case; still a hash or merge join.  Rows of the left side without a key match nothing
    and are spread by a hash of the row."""
    r = right.withColumn("__k", F.lower(right_key)).filter("__k IS NOT NULL") if how in ("left", "inner", "left_semi", "left_anti") else right.withColumn("__k", F.lower(right_key))
    return left.join(r, apart(F.lower(left_key), *left.columns) == F.col("__k"), how).drop("__k")


def email_sends(t: Tables) -> DataFrame:
    return t["receivers"].join(t["mailings"].select("mailing_id", "tracking_id", "title"), "mailing_id").select("mailing_id", "tracking_id", "title", "receiver_id", "person_key", "sent_at", "log_status")


def email_engagement(t: Tables, since: str | None = None) -> DataFrame:
    e = active_only(t["engagement"])
    e = e.filter(F.col("event_at") >= F.lit(since).cast("timestamp_ntz")) if since else e
    return e.join(t["mailings"].select("mailing_id", "tracking_id"), "mailing_id").select("mailing_id", "tracking_id", "receiver_id", "person_key", "link_type", "agent", "event_at")


def send_to_event(t: Tables) -> DataFrame:
    """Each active event with the seconds since its sending, by both keys."""
    r = t["receivers"].select("mailing_id", "receiver_id", "sent_at")
    e = active_only(t["engagement"]).select("id", "mailing_id", "receiver_id", "link_type", "event_at")
    return e.join(r, ["mailing_id", "receiver_id"]).select("id", "mailing_id", "receiver_id", "link_type", seconds_to_event("sent_at", "event_at").alias("seconds"))


def email_event_chain(t: Tables) -> DataFrame:
    """Mailing, receiver, its active events (kept without), and the receiver's organisation.

    The organisation is looked up before the events multiply the receivers, and spread over rows after."""
    m, org = t["mailings"].select("mailing_id", "tracking_id", "title"), ("region", "division")
    r = t["receivers"].select("mailing_id", "receiver_id", "person_key", "sent_at", "log_status")
    r = r.join(_people(t, org), _person("mailing_id", "receiver_id", "sent_at") == F.col("__k"), "left").drop("__k")
    e = active_only(t["engagement"]).select("mailing_id", "receiver_id", F.col("id").alias("event_row"), "link_type", "agent", "event_at")
    chain = m.join(r, "mailing_id").join(e, ["mailing_id", "receiver_id"], "left")
    rest = ("mailing_id", "receiver_id", "tracking_id", "title", "sent_at", "log_status", "event_row", "link_type", "agent", "event_at")
    return _repeated(_spread(chain, org)).select("person_key", *rest, *org)


def _interactions(t: Tables) -> DataFrame:
    """Sent or bounced from the receivers, opened or clicked from active events."""
    sent = t["receivers"].select("mailing_id", "receiver_id", "person_key", F.when(F.col("log_status") == "Bounce", "bounced").otherwise("sent").alias("event"), F.col("sent_at").alias("event_at"), F.lit(None).cast("string").alias("agent"))
    seen = active_only(t["engagement"]).select("mailing_id", "receiver_id", "person_key", F.when(F.col("link_type") == "OPEN", "opened").otherwise("clicked").alias("event"), "event_at", "agent")
    return sent.unionByName(seen)


def fact_email(t: Tables) -> DataFrame:
    """One row per interaction: sent or bounced from the receivers, opened or clicked from active events."""
    org, users = ("region", "division"), tuple(c for c in t["hr_user"].columns if c != "user_key")
    both = _interactions(t).join(t["mailings"].select("mailing_id", "tracking_id"), "mailing_id", "left")
    rest = [c for c in both.columns if c != "person_key"]
    f = both.join(_people(t, org, users), _person(*rest) == F.col("__k"), "left")
    return _repeated(_spread(f, org, users)).select("person_key", *rest, *org, *users)


def _counted(t: Tables, key: tuple[str, ...], columns: tuple[str, ...], **by: Column) -> DataFrame:
    """Interactions of fact_email counted (n) by key (mailing_id or none, tracking_id, person_key or none), event, `by` and organisation.

    What is alike is counted before it meets HR, and a row stands for `__n` of fact_email's: mailings and persons count as often as
    the masters have them.  If the key has mailing_id and person_key, the result has one row a group; else groups are added up at the end."""
    m = t["mailings"].groupBy("mailing_id", *(c for c in key if c == "tracking_id")).agg(F.count("*").alias("__n"))
    f = _interactions(t).select("mailing_id", "person_key", "event", *(c.alias(n) for n, c in by.items())).join(m, "mailing_id", "left")
    own = [c for c in key if c != "person_key"] + ["event", *by]
    f = f.withColumn("__who", _person(*own)).repartition("__who").groupBy("__who", "person_key", *own).agg(F.sum(F.coalesce("__n", F.lit(1))).alias("__n"))
    f = f.join(_people(t, columns, ()), F.col("__who") == F.col("__k"), "left").drop("__who")
    f = _spread(f, columns, ()).withColumn("n", F.col("__n") * F.col("__times"))
    return f if {"mailing_id", "person_key"} <= set(key) else f.groupBy(*key, "event", *by, *columns).agg(F.sum("n").alias("n"))


def gold_email_fact(t: Tables) -> DataFrame:
    """Interactions by mailing, recipient, event and hour, with organisation."""
    f = _counted(t, ("mailing_id", "tracking_id", "person_key"), ("region", "division"), hour=F.date_trunc("hour", "event_at").cast("timestamp_ntz"))
    return f.select("mailing_id", "tracking_id", "person_key", "event", "hour", "region", "division", "n")


def gold_email_by_dim(t: Tables) -> DataFrame:
    return _counted(t, ("tracking_id",), ("region", "division")).select("tracking_id", "region", "division", "event", "n")


def email_by_week(t: Tables) -> DataFrame:
    """Interactions by week and event."""
    return _counted(t, (), (), week=F.trunc("event_at", "week")).select("week", "event", "n")


def gold_email_by_pack(t: Tables) -> DataFrame:
    """Distinct recipients per pack that were sent to, opened and clicked."""
    who = lambda e: F.count_distinct(F.when(F.col("event") == e, F.col("person_key")))
    f = gold_email_fact(t).filter("tracking_id IS NOT NULL").withColumn("pack_id", pack_key("tracking_id"))
    return f.groupBy("pack_id").agg(who("sent").alias("sent"), who("opened").alias("opened"), who("clicked").alias("clicked"))


def _distinct_by_kind(e: DataFrame, key: str, of: str) -> DataFrame:
    kind = lambda k: F.count_distinct(F.when(F.col("link_type") == k, F.col(of)))
    return e.groupBy(key).agg(kind("OPEN").alias("unique_opens"), kind("CLICK").alias("unique_clicks"), F.count_if(F.col("link_type") == "CLICK").alias("total_clicks"))


def email_pack_from_events(t: Tables) -> DataFrame:
    """Per pack: sends, and recipients with an active open or click."""
    ids = t["mailings"].filter("tracking_id IS NOT NULL").select("mailing_id", pack_key("tracking_id").alias("pack_id"))
    sends = t["receivers"].join(ids, "mailing_id").groupBy("pack_id").agg(F.count("*").alias("sends"))
    seen = _distinct_by_kind(active_only(t["engagement"]).join(ids, "mailing_id"), "pack_id", "person_key").drop("total_clicks")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return sends.join(seen, "pack_id", "left").select("pack_id", "sends", zero("unique_opens"), zero("unique_clicks"))


def pack_funnel(t: Tables) -> DataFrame:
    """Distinct rows sent, opened and clicked per pack, next to its page views."""
    ids = t["mailings"].filter("tracking_id IS NOT NULL").select("mailing_id", pack_key("tracking_id").alias("pack_id"))
    sent = t["receivers"].join(ids, "mailing_id").groupBy("pack_id").agg(F.count_distinct("receiver_id").alias("sent"))
    seen = active_only(t["engagement"]).join(ids, "mailing_id").groupBy("pack_id").agg(*(F.count_distinct(F.when(F.col("link_type") == k, F.col("id"))).alias(n) for k, n in (("OPEN", "opened"), ("CLICK", "clicked"))))
    views = t["page_views"].filter("tracking_id IS NOT NULL").groupBy(pack_key("tracking_id").alias("pack_id")).agg(F.count("*").alias("views"))
    return sent.join(seen, "pack_id", "left").join(views, "pack_id", "left").select("pack_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("sent", "opened", "clicked", "views")))


def mailing_funnel(t: Tables) -> DataFrame:
    return _distinct_by_kind(active_only(t["engagement"]), "mailing_id", "receiver_id")


def agent_breakdown(t: Tables, since: str | None = None) -> DataFrame:
    return email_engagement(t, since).groupBy("agent", "link_type").agg(F.count("*").alias("n"), F.count_distinct("receiver_id").alias("receivers")).orderBy(F.desc("n"), "agent", "link_type")


def multi_device(t: Tables, per_mailing: bool = True) -> DataFrame:
    """Recipients who clicked with two or more agents, by mailing or over all mailings, with the agents as one label."""
    keys = ["mailing_id", "person_key"] if per_mailing else ["person_key"]
    c = active_only(t["engagement"]).filter(F.col("link_type") == "CLICK")
    return c.groupBy(*keys).agg(F.array_sort(F.collect_set("agent")).alias("a")).filter(F.size("a") > 1).select(*keys, F.array_join("a", " & ").alias("agents"))


def device_labels(t: Tables) -> DataFrame:
    """Clicks by final device label."""
    multi = multi_device(t).select("mailing_id", "person_key", F.lit(True).alias("multi"))
    c = active_only(t["engagement"]).filter(F.col("link_type") == "CLICK").join(multi, ["mailing_id", "person_key"], "left")
    return c.groupBy(final_device_type("agent", F.coalesce("multi", F.lit(False))).alias("device")).agg(F.count("*").alias("clicks"))


def multi_device_share(t: Tables, top: int = 20) -> DataFrame:
    """For the largest mailings: clickers, those on several devices, and their share."""
    size = t["receivers"].groupBy("mailing_id").agg(F.count("*").alias("receivers")).orderBy(F.desc("receivers"), "mailing_id").limit(top)
    clickers = active_only(t["engagement"]).filter(F.col("link_type") == "CLICK").groupBy("mailing_id", "person_key").agg((F.count_distinct("agent") > 1).alias("multi"))
    g = clickers.join(size, "mailing_id", "right").groupBy("mailing_id", "receivers").agg(F.count("person_key").alias("clickers"), F.count_if("multi").alias("multi"))
    return g.withColumn("share", share(F.col("multi"), F.col("clickers")))


LAST_SPAN = "15m+"  # fixed value
SPANS = (("24h", 24), ("72h", 72), ("1w", 168), ("15w", 2520))


def timespan_bucket(hours: Column) -> Column:
    out = F.when(hours < SPANS[0][1], SPANS[0][0])
    for name, n in SPANS[1:]:
        out = out.when(hours < n, name)
    return out.when(hours.isNotNull(), LAST_SPAN)


DIMENSIONS = (("event_date",), ("event_date", "event_hour"), ("division", "area"), ("region", "country"))


def timespan_rollup(t: Tables, *dims: str) -> DataFrame:
    """Events by time since sending and by organisation or date: one set of dimensions."""
    return timespan_rollups(t, (dims,)).select("timespan", *dims, "link_type", "n", "receivers")


def timespan_rollups(t: Tables, sets: tuple[tuple[str, ...], ...] = DIMENSIONS) -> DataFrame:
    """All rollups of events by time since sending in one pass over one join: a row for each set of dimensions, named in
    `by`, and its values; the dimensions of other sets are null.

    All rows of a receiver come to one task, which counts them for every group before groups are added up: receivers of
    tasks differ, so that their numbers are added, and no row is moved once for each set."""
    dims = list(dict.fromkeys(d for s in sets for d in s))
    org = tuple(d for d in dims if d in ORG)
    r = t["receivers"].select("mailing_id", "receiver_id", "sent_at")
    e = active_only(t["engagement"]).select("mailing_id", "receiver_id", "person_key", "link_type", "event_at").join(r, ["mailing_id", "receiver_id"])
    values = {"timespan": timespan_bucket(timespan_hours("sent_at", "event_at")), "event_date": F.to_date("event_at"), "event_hour": F.hour("event_at")}
    e = e.select("receiver_id", "person_key", "link_type", *(c.alias(n) for n, c in values.items() if n == "timespan" or n in dims))
    e = e.join(_people(t, org), _person(*(c for c in e.columns if c != "person_key")) == F.col("__k"), "left").drop("__k")
    e = _spread(e.repartition("receiver_id"), org)
    one = lambda s: F.struct(F.lit("_".join(s)).alias("by"), *((F.col(d) if d in s else F.lit(None)).cast(e.schema[d].dataType).alias(d) for d in dims))
    wide = e.select("receiver_id", "timespan", "link_type", "__times", F.explode(F.array(*map(one, sets))).alias("s")).select("receiver_id", "timespan", "link_type", "__times", "s.*")
    keys = ["by", "timespan", "link_type", *dims]
    per = wide.groupBy("receiver_id", *keys).agg(F.sum("__times").alias("n"))
    g = per.groupBy(*keys).agg(F.sum("n").alias("n"), F.count("*").alias("receivers"))
    return g.select("timespan", "link_type", *dims, "by", "n", "receivers")


def mailing_by_dim(t: Tables, *dims: str) -> DataFrame:
    """Recipients of each mailing by organisation: count, unique opens and clicks (null when none).

    Receivers and events meet as one row per mailing and person; the organisation is looked up for those only."""
    r = t["receivers"].select("mailing_id", "person_key", F.lit(1).alias("received"), F.lit(None).cast("string").alias("kind"))
    e = active_only(t["engagement"]).select("mailing_id", "person_key", F.lit(0).alias("received"), F.col("link_type").alias("kind"))
    did = lambda k: (F.coalesce(F.max(F.col("kind") == k), F.lit(False)) & F.col("person_key").isNotNull()).cast("int").alias(k)
    per = r.unionByName(e).groupBy("mailing_id", "person_key").agg(F.sum("received").alias("n"), did("OPEN"), did("CLICK"))
    some = lambda k: F.nullif(F.sum(k), F.lit(0))
    g = enrich_hr(per, t, dims).groupBy("mailing_id", *dims).agg(F.sum("n").alias("n"), some("OPEN").alias("unique_opens"), some("CLICK").alias("unique_clicks"))
    return g.filter("n > 0")


def mailing_kpi(t: Tables) -> DataFrame:
    """Long form: (mailing, measure, language, value) of sent, opened and clicked recipients."""
    r = t["receivers"].groupBy("mailing_id", "language").agg(F.count_if(F.col("log_status") != "Bounce").alias("sent"))
    e = active_only(t["engagement"]).groupBy("mailing_id", "language").agg(*(F.count_distinct(F.when(F.col("link_type") == k, F.col("person_key"))).alias(n) for k, n in (("OPEN", "opened"), ("CLICK", "clicked"))))
    wide = r.join(e, ["mailing_id", "language"], "left").na.fill(0)
    return wide.select("mailing_id", "language", F.expr("stack(3, 'sent', sent, 'opened', opened, 'clicked', clicked) as (measure, value)"))


def pivot_kpi(kpi: DataFrame) -> DataFrame:
    """Wide form: one row per mailing."""
    return kpi.groupBy("mailing_id").pivot("measure", ["sent", "opened", "clicked"]).agg(F.sum("value"))


def event_registrations(t: Tables) -> DataFrame:
    """Registrations with their event, without open-ended events."""
    ev = t["event_master"].filter(F.col("event_date") < F.lit("2100-01-01").cast("date")).select("event_id", "tracking_id", "title", "event_date")
    return t["registrations"].join(ev, "event_id")


def event_pack(t: Tables) -> DataFrame:
    """Per pack: registrations, attendances and no-shows."""
    r = event_registrations(t).groupBy(pack_key("tracking_id").alias("pack_id"))
    return r.agg(F.count("*").alias("registered"), F.count_if(F.col("status") == "attended").alias("attended"), F.count_if(F.col("status") == "no_show").alias("no_show"))


def template_links(t: Tables) -> DataFrame:
    return t["template_links"].join(t["mailings"].select("mailing_id", "title"), "mailing_id").select("link_id", "mailing_id", "title", "url", "label")


def _clicks(t: Tables) -> DataFrame:
    c = active_only(t["engagement"]).filter(F.col("link_type") == "CLICK")
    return c.groupBy("mailing_id", "link_no").agg(F.count("*").alias("clicks"), F.count_distinct("person_key").alias("clickers"))


def clicks_per_url(t: Tables) -> DataFrame:
    """Clicks of each template link; links without clicks have 0."""
    return t["template_links"].join(_clicks(t), ["mailing_id", "link_no"], "left").groupBy("url").agg(F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"))


def template_components(t: Tables) -> DataFrame:
    """Link to element value, element and component."""
    chain = t["template_links"].join(t["element_values"], "value_id", "left").join(t["elements"], "element_id", "left").join(t["components"], "component_id", "left")
    return chain.select("link_id", "mailing_id", "url", "key_name", "element_order", "component_name")


def link_engagement(t: Tables) -> DataFrame:
    """Clicks and clickers of each link with its component."""
    c = template_components(t).join(t["template_links"].select("link_id", "link_no"), "link_id").join(_clicks(t), ["mailing_id", "link_no"], "left")
    return c.select("mailing_id", "link_id", "component_name", F.coalesce("clicks", F.lit(0)).alias("clicks"), F.coalesce("clickers", F.lit(0)).alias("clickers"))


def dead_links(t: Tables) -> DataFrame:
    """Per mailing: links, links without a click, and their share."""
    g = link_engagement(t).groupBy("mailing_id").agg(F.count("*").alias("links"), F.count_if(F.col("clicks") == 0).alias("dead"))
    return g.withColumn("share", share(F.col("dead"), F.col("links")))


def audience_size(t: Tables, newest: int = 20) -> DataFrame:
    """The newest mailings with recipients, unique opens and unique clicks."""
    m = t["mailings"].orderBy(F.desc("created_at"), "mailing_id").limit(newest).select("mailing_id", "created_at")
    r = t["receivers"].join(m, "mailing_id").groupBy("mailing_id").agg(F.count("*").alias("recipients"))
    e = _distinct_by_kind(active_only(t["engagement"]).join(m.select("mailing_id"), "mailing_id"), "mailing_id", "person_key")
    return m.join(r, "mailing_id", "left").join(e, "mailing_id", "left").select("mailing_id", "created_at", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("recipients", "unique_opens", "unique_clicks")))


def top_creators(t: Tables, n: int = 10) -> DataFrame:
    """Who created most mailings, with organisation."""
    c = t["mailings"].groupBy(F.col("created_by").alias("person_key")).agg(F.count("*").alias("mailings"), F.count("tracking_id").alias("tracked"))
    return enrich_hr(c, t, ("region", "division")).orderBy(F.desc("mailings"), "person_key").limit(n)


def _region_cause(t: Tables, df: DataFrame) -> DataFrame:
    """df (with person_key) with org_unit and region, and why a region is missing; rows without a person are spread."""
    rest = [c for c in df.columns if c != "person_key"]
    who = t["hr_employee"].select(F.col("person_key").alias("__who"), "org_unit").join(t["hr_costcenter"].select("org_unit", "region"), "org_unit", "left")
    d = df.join(who, apart(F.col("person_key"), *(rest or ["person_key"])) == F.col("__who"), "left")
    cause = F.when(F.col("region").isNotNull(), "region").when(F.col("person_key").isNull(), "no_person").when(F.col("__who").isNull(), "no_employee").when(F.col("org_unit").isNull(), "no_org_unit").otherwise("no_costcenter")
    return d.withColumn("cause", cause).drop("__who")


def _causes(g) -> DataFrame:
    count = lambda c: F.count_if(F.col("cause") == c).alias(c)
    return g.agg(F.count("*").alias("n"), F.count_if(F.col("region").isNull()).alias("no_region"), count("no_person"), count("no_employee"), count("no_org_unit"), count("no_costcenter"))


def null_region(t: Tables) -> DataFrame:
    """Per year of sending: recipients, without a region, and why."""
    return _causes(_region_cause(t, t["receivers"].select("person_key", "receiver_id", F.year("sent_at").alias("year"))).groupBy("year"))


def null_region_by_mailing(t: Tables) -> DataFrame:
    """Where missing regions are concentrated: per mailing, with the year of its creation, recipients, those without a region
    and why, the share of the mailing and of all missing regions."""
    r = _causes(_region_cause(t, t["receivers"].select("person_key", "receiver_id", "mailing_id")).groupBy("mailing_id"))
    total = F.sum("no_region").over(Window.partitionBy())  # a row a mailing
    r = r.join(t["mailings"].select("mailing_id", F.year("created_at").alias("created_year")), "mailing_id", "left")
    return r.withColumns({"share": share(F.col("no_region"), F.col("n")), "share_of_all": share(F.col("no_region"), total)})


def null_region_by_creation(t: Tables) -> DataFrame:
    """The same by the year of the mailing's creation."""
    g = null_region_by_mailing(t).groupBy("created_year")
    return g.agg(F.count("*").alias("mailings"), *(F.sum(c).alias(c) for c in ("n", "no_region", "no_person", "no_employee", "no_org_unit", "no_costcenter")))


def null_region_persons(t: Tables, k: int = 100) -> DataFrame:
    """k persons (the least keys) without a region: whether HR has them, their unit, and whether the unit has a cost centre."""
    who = t["receivers"].filter("person_key IS NOT NULL").select("person_key").distinct()
    d = _region_cause(t, who).filter("region IS NULL").orderBy("person_key").limit(k)
    return d.select("person_key", (F.col("cause") != "no_employee").alias("in_hr"), "org_unit", F.when(F.col("org_unit").isNotNull(), F.lit(False)).alias("in_costcenter"))
