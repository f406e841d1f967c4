"""The star schema of page views: fact, sessions, pages, dates, and the monthly as-of join with HR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.values import apart, normalize_gpn
from pulsegrid.operators.quantiles import exact_percentiles

GAP_SECONDS = 1800


def _seconds(later: Column, earlier: Column) -> Column:
    """Seconds with their fraction."""
    return F.timestamp_diff("MICROSECOND", earlier, later) / 1_000_000


def time_on_page(df: DataFrame, *, ts: str = "ts", view: str = "view_id", across_files: bool = False, gap: int = GAP_SECONDS) -> DataFrame:
    """Adds time_on_page_s (to the next view of the session; null after the last and over a longer gap) and
    is_last_in_session.  Views without a session never pair.  Sessions are per source file unless across_files."""
    # a view without a session is a window of its own, so that such views do not meet in one task
    alone = F.when(F.col("session_id").isNull(), F.col(view))
    w = Window.partitionBy(*([] if across_files else ["source_file"]), "session_id", alone).orderBy(ts, view)
    following = F.lead(ts).over(w)
    s = _seconds(following, F.col(ts))
    return df.withColumns({"time_on_page_s": F.when(s <= gap, s.cast("double")), "is_last_in_session": following.isNull()})


def join_hr_asof(views: DataFrame, hr: DataFrame, *, ts: str = "ts", key: str = "view_id") -> DataFrame:
    """Adds hr_* columns: from the newest snapshot not after the view's month, each null field filled from the oldest
    snapshot after it.  Both sides' person numbers are normalised.

    Snapshots are cut into intervals, so that each view meets at most one earlier and one later snapshot.  Views
    without a person number are spread by their key."""
    fields = [c for c in hr.columns if c not in ("gpn", "snapshot_year", "snapshot_month")]
    ym = (F.col("snapshot_year") * 12 + F.col("snapshot_month")).cast("int")
    h = hr.select(normalize_gpn("gpn").alias("__g"), ym.alias("__ym"), F.struct(*fields).alias("__row")).filter("__g IS NOT NULL")
    h = h.groupBy("__g", "__ym").agg(F.min("__row").alias("__row"))
    w = Window.partitionBy("__g").orderBy("__ym")
    spans = h.select("__g", F.col("__ym").alias("__from"), F.lead("__ym").over(w).alias("__to"), F.col("__row").alias("__now"), F.lead("__row").over(w).alias("__next"))
    first = h.groupBy("__g").agg(F.min("__ym").alias("__to"), F.min_by("__row", "__ym").alias("__next"))
    spans = spans.unionByName(first.select("__g", F.lit(-(1 << 30)).alias("__from"), "__to", F.lit(None).cast(h.schema["__row"].dataType).alias("__now"), "__next"))
    v = views.withColumns({"__v": apart(normalize_gpn("gpn"), key), "__m": (F.year(ts) * 12 + F.month(ts)).cast("int")})
    on = (F.col("__v") == F.col("__g")) & (F.col("__m") >= F.col("__from")) & (F.col("__to").isNull() | (F.col("__m") < F.col("__to")))
    joined = v.join(spans, on, "left")
    return joined.select(*views.columns, *(F.coalesce(F.col(f"__now.{c}"), F.col(f"__next.{c}")).alias(f"hr_{c}") for c in fields))


def hr_match_stats(views: DataFrame, hr: DataFrame) -> DataFrame:
    """One row: views, views with a person number, distinct persons, and those of them that HR knows."""
    v = views.select(normalize_gpn("gpn").alias("g"))
    known = hr.select(normalize_gpn("gpn").alias("g"), F.lit(1).alias("known")).filter("g IS NOT NULL").distinct()
    per = v.groupBy("g").agg(F.count("*").alias("n")).join(known, "g", "left")
    return per.agg(F.sum("n").alias("n_views"), F.sum(F.when(F.col("g").isNotNull(), F.col("n")).otherwise(0)).alias("n_with_gpn"), F.count("g").alias("n_persons"), F.count("known").alias("n_matched"))


def fact_page_view(views: DataFrame, hr: DataFrame | None = None, **options) -> DataFrame:
    """Views with time on page and, with hr, the organisation of the viewer."""
    fact = time_on_page(views, **options)
    return fact if hr is None else join_hr_asof(fact, hr)


def agg_session(fact: DataFrame, *, ts: str = "ts", view: str = "view_id", first: tuple[str, ...] = ("user_id", "gpn")) -> DataFrame:
    """One row per session: first non-null identity, start, end, length, summed time on page (0 without a measured view), mean time on
    page of measured views (null without), views, entry and exit page (non-null), bounce and date."""
    at = F.struct(ts, view)
    firsts = [F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in first if c in fact.columns]
    firsts += [F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in fact.columns if c.startswith("hr_")]
    page = F.when(F.col("page_id").isNotNull(), at)
    micro = F.round(F.col("time_on_page_s") * 1_000_000).cast("long")  # whole numbers, so that sums do not depend on their order
    g = fact.filter("session_id IS NOT NULL").groupBy("session_id").agg(
        *firsts, F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.coalesce(F.sum(micro), F.lit(0)).alias("total"), F.count("time_on_page_s").alias("measured"),
        F.count("*").alias("n_views"), F.min_by("page_id", page).alias("entry_page"), F.max_by("page_id", page).alias("exit_page"),
    )
    return g.select("session_id", *(c for c in first if c in fact.columns), *(c for c in fact.columns if c.startswith("hr_")), "session_start", "session_end", F.bround(_seconds(F.col("session_end"), F.col("session_start")), 0).alias("duration_s"),
        (F.col("total") / 1_000_000).alias("engagement_s"), F.bround(F.try_divide(F.col("total") / 1_000_000, F.col("measured")), 1).alias("avg_time_on_page_s"), "n_views", "entry_page", "exit_page", (F.col("n_views") == 1).alias("is_bounce"), F.to_date("session_start").alias("session_date"))


def latest_per_key(df: DataFrame, key: str | list[str], *order: Column, keep: int = 1) -> DataFrame:
    """The first `keep` rows of each key in the given order."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__r") <= keep).drop("__r")


def first_last(df: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """The first and last non-null value of each key."""
    at = F.when(F.col(value).isNotNull(), F.struct(*order))
    return df.groupBy(key).agg(F.min_by(value, at).alias(f"first_{value}"), F.max_by(value, at).alias(f"last_{value}"))


def dim_page(views: DataFrame, columns: tuple[str, ...] = ("page_name", "url", "site_id", "site_name", "theme", "content_type"), *, ts: str = "ts", view: str = "view_id") -> DataFrame:
    """The first row of each page, by time of the file (where source_time is there), file, time and view."""
    have = [c for c in columns if c in views.columns]
    order = [c for c in ("source_time", "source_file", ts, view) if c in views.columns]
    return views.groupBy("page_id").agg(F.min_by(F.struct(*have), F.struct(*order)).alias("r")).select("page_id", *(F.col(f"r.{c}") for c in have))


def dim_date(views: DataFrame, ts: str = "ts") -> DataFrame:
    d = views.select(F.to_date(ts).alias("date")).distinct().filter("date IS NOT NULL")
    fmt = lambda f: F.date_format("date", f)
    return d.select(fmt("yyyyMMdd").cast("int").alias("date_key"), "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"), fmt("MMMM").alias("month_name"), F.weekofyear("date").alias("iso_week"), (F.weekday("date") + 1).alias("weekday"), fmt("EEEE").alias("weekday_name"))


def star_join(fact: DataFrame, pages: DataFrame, dates: DataFrame, ts: str = "ts") -> DataFrame:
    """The fact with page and date attributes; Spark broadcasts dimensions that it sees to be small."""
    f = fact.drop(*(c for c in pages.columns if c != "page_id" and c in fact.columns))
    return f.join(pages, "page_id", "left").withColumn("date_key", F.date_format(ts, "yyyyMMdd").cast("int")).join(dates, "date_key", "left")


def pipeline_summary(fact: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: views, measured views, median (exact, by rounds of counts), 90th percentile and mean time on page, sessions,
    bounces, mean views a session."""
    median, p90 = exact_percentiles(fact, "time_on_page_s", [0.5, 0.9])
    f = fact.agg(F.count("*").alias("n_views"), F.count("time_on_page_s").alias("n_measured"), F.lit(median).cast("double").alias("median_top"), F.round(F.lit(p90).cast("double"), 6).alias("p90_top"), F.round(F.avg("time_on_page_s"), 4).alias("mean_top"))
    s = sessions.agg(F.count("*").alias("n_sessions"), F.count_if("is_bounce").alias("n_bounces"), F.round(F.avg("n_views"), 4).alias("mean_pages"))
    return f.join(s, F.lit(True))
