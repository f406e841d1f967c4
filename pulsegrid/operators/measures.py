"""Measures of the report model as functions over the star schema.

`by` is a list of columns or expressions to group by; an empty list gives one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

By = list[str | Column]
_n = lambda: F.count("*")


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def mean(c: str) -> Column:
    """A mean of numbers with up to six decimals that does not depend on their order; null without values."""
    return F.try_divide(F.sum(F.round(F.col(c) * 1_000_000).cast("long")).cast("double") / 1_000_000, F.count(c).cast("double"))


def kpi_views(fact: DataFrame, by: By = []) -> DataFrame:  # noqa: B006
    u = F.count_distinct("user_id")
    return fact.groupBy(*by).agg(_n().alias("views"), u.alias("visitors"), _ratio(_n(), u).alias("views_per_visitor"))


def kpi_sessions(sessions: DataFrame, by: By = []) -> DataFrame:  # noqa: B006
    return sessions.groupBy(*by).agg(_n().alias("sessions"), _ratio(F.count_if("is_bounce"), _n()).alias("bounce_rate"), _ratio(F.sum("n_views"), _n()).alias("pages_per_session"))


def kpi_engagement(fact: DataFrame, sessions: DataFrame) -> DataFrame:
    """Mean time on page, mean session length without bounces, measurable share, mean load time."""
    f = fact.agg(mean("time_on_page_s").alias("avg_time_on_page_s"), _ratio(F.count("time_on_page_s"), _n()).alias("measurable_share"), mean("load_ms").alias("avg_load_ms"))
    s = sessions.filter(~F.col("is_bounce")).agg(mean("duration_s").alias("avg_session_s"))
    return f.join(s, F.lit(True))  # two single rows


def kpi_content(fact: DataFrame, by: By = []) -> DataFrame:  # noqa: B006
    p = F.count_distinct("page_id")
    return fact.groupBy(*by).agg(p.alias("pages"), _ratio(_n(), p).alias("views_per_page"), _ratio(F.count_distinct("user_id"), p).alias("visitors_per_page"))


def kpi_hr_coverage(fact: DataFrame) -> DataFrame:
    return fact.agg(_ratio(F.count("hr_division"), _n()).alias("hr_coverage"), F.count_distinct("hr_division").alias("divisions"))


def period_change(df: DataFrame, unit: str, ts: str = "ts") -> DataFrame:
    """Views and visitors per month or week next to those of the period before; a gap gives null, not an older period."""
    step = {"month": lambda c: F.add_months(c, 1), "week": lambda c: F.date_add(c, 7)}[unit]
    now = df.groupBy(F.trunc(ts, unit).alias("period")).agg(_n().alias("views"), F.count_distinct("user_id").alias("visitors"))
    before = now.select(step(F.col("period")).alias("period"), F.col("views").alias("views_before"), F.col("visitors").alias("visitors_before"))
    change = lambda c: F.try_divide((F.col(c) - F.col(f"{c}_before")).cast("double"), F.col(f"{c}_before").cast("double")).alias(f"{c}_change")
    return now.join(before, "period", "left").select("*", change("views"), change("visitors"))


def views_ytd(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Views per day and their sum since the start of the year."""
    d = df.groupBy(F.to_date(ts).alias("day")).agg(_n().alias("views"))
    return d.withColumn("views_ytd", F.sum("views").over(Window.partitionBy(F.year("day")).orderBy("day")))


def page_entry_exit(sessions: DataFrame, pages: DataFrame) -> DataFrame:
    """Per page: sessions that start and end there, and the bounce rate of those that start there; pages without any have 0."""
    e = sessions.groupBy(F.col("entry_page").alias("page_id")).agg(_n().alias("entries"), F.count_if("is_bounce").alias("bounces"))
    x = sessions.groupBy(F.col("exit_page").alias("page_id")).agg(_n().alias("exits"))
    z = lambda c: F.coalesce(c, F.lit(0))
    return pages.select("page_id").join(e, "page_id", "left").join(x, "page_id", "left").select("page_id", z("entries").alias("entries"), z("exits").alias("exits"), _ratio(z("bounces"), z("entries")).alias("bounce_rate"))


def heatmap(fact: DataFrame, ts: str = "ts") -> DataFrame:
    """Views by weekday (1 Monday) and hour, empty cells with 0."""
    n = fact.groupBy((F.weekday(ts) + 1).alias("weekday"), F.hour(ts).alias("hour")).agg(_n().alias("views"))
    cells = fact.sparkSession.range(168).select((F.floor(F.col("id") / 24) + 1).cast("int").alias("weekday"), (F.col("id") % 24).cast("int").alias("hour"))
    return cells.join(n, ["weekday", "hour"], "left").na.fill(0, "views")


def engagement_flag(fact: DataFrame) -> DataFrame:
    """Pages with many views and little time, and with few views and much time."""
    p = fact.groupBy("page_id").agg(_n().alias("views"), mean("time_on_page_s").alias("avg_s"))
    v, a = F.col("views"), F.col("avg_s")
    return p.withColumn("flag", F.when((v > 100) & (a < 10), "low_engagement").when((v < 20) & (a > 120), "hidden_gem").otherwise("normal"))


def bounce_by_division(sessions: DataFrame) -> DataFrame:
    return kpi_sessions(sessions, [F.coalesce("hr_division", F.lit("(Unknown)")).alias("division")])


def visitors_by(fact: DataFrame, column: str) -> DataFrame:
    return fact.groupBy(F.coalesce(column, F.lit("(Unknown)")).alias(column)).agg(F.count_distinct("user_id").alias("visitors"), _n().alias("views"))


def division_theme_matrix(fact: DataFrame, themes: list[str]) -> DataFrame:
    """Views by division, one column per theme."""
    return fact.groupBy(F.coalesce("hr_division", F.lit("(Unknown)")).alias("division")).pivot("theme", themes).agg(F.count(F.lit(1))).na.fill(0)


def session_depth(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("n_views").agg(_n().alias("sessions"))


def top_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.groupBy(key).agg(_n().alias("views")).orderBy(F.desc("views"), key).limit(n)


def page_detail(fact: DataFrame, pages: DataFrame) -> DataFrame:
    """Per page: names, views, visitors and time; also the points of a views-by-time scatter."""
    f = fact.groupBy("page_id").agg(_n().alias("views"), F.count_distinct("user_id").alias("visitors"), mean("time_on_page_s").alias("avg_s"))
    return pages.select("page_id", "page_name", "site_name").join(f, "page_id")


SPANS = (1, 7, 14, 21, 28)


def datewise_overview(views: DataFrame, keys: list[str], day: str = "day") -> DataFrame:
    """Views of the last 1, 7, 14, 21 and 28 days, for each key and day with views."""
    d = views.groupBy(*keys, day).agg(_n().alias("n"))
    num = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy(*keys).orderBy(num)
    return d.select(*keys, day, *(F.sum("n").over(w.rangeBetween(1 - s, 0)).alias(f"views_{s}d") for s in SPANS))


def rolling_unique(views: DataFrame, keys: list[str], user: str, day: str = "day") -> DataFrame:
    """Distinct users of the last 1, 7, 14, 21 and 28 days, for each key and day with views.

    A user counts from a day of visit on until a span is over without another visit.  So only changes are
    passed on, +1 where a user begins to count and -1 where it ends, and are added up by day."""
    d = views.filter(F.col(day).isNotNull()).select(*keys, user, day).distinct()
    w = Window.partitionBy(*keys, user).orderBy(day)
    since, until = F.datediff(F.col(day), F.lag(day).over(w)), F.datediff(F.lead(day).over(w), F.col(day))
    d = d.withColumns({"__since": since, "__until": until})

    def change(at: Column, visit: int, **counts: Column) -> Column:
        return F.struct(at.alias("day"), F.lit(visit).alias("visit"), *(counts.get(f"c{s}", F.lit(0)).cast("int").alias(f"c{s}") for s in SPANS))

    starts = change(F.col(day), 1, **{f"c{s}": F.when(F.col("__since").isNull() | (F.col("__since") >= s), 1).otherwise(0) for s in SPANS})
    ends = [F.when(F.col("__until").isNull() | (F.col("__until") >= s), change(F.date_add(day, s), 0, **{f"c{s}": F.lit(-1)})) for s in SPANS]
    e = d.select(*keys, F.explode(F.array_compact(F.array(starts, *ends))).alias("e")).select(*keys, "e.*")
    e = e.groupBy(*keys, "day").agg(F.max("visit").alias("visit"), *(F.sum(f"c{s}").alias(f"c{s}") for s in SPANS))
    upto = Window.partitionBy(*keys).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)  # a row for each day
    e = e.select(*keys, F.col("day").alias(day), "visit", *(F.sum(f"c{s}").over(upto).alias(f"users_{s}d") for s in SPANS))
    return e.filter("visit = 1").drop("visit")


def pareto_sites(pages: DataFrame) -> DataFrame:
    """Sites by tracked pages, cumulative share, and which of them reach 80 % first."""
    s = pages.filter("tracking_id IS NOT NULL").groupBy("site_id").agg(_n().alias("n"))
    w = Window.orderBy(F.desc("n"), "site_id").rowsBetween(Window.unboundedPreceding, 0)  # one row per site
    s = s.withColumns({"running": F.sum("n").over(w), "total": F.sum("n").over(Window.partitionBy())})
    return s.select("site_id", "n", F.round(F.col("running") * 100.0 / F.col("total"), 2).alias("cumulative_pct"), ((F.col("running") - F.col("n")) * 100 < 80 * F.col("total")).alias("in_first_80"))
