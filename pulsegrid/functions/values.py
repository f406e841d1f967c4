"""Cleaning of single values, and small predicates, as column expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/Berlin"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def apart(key: Column, *row: str | Column) -> Column:
    """A join key (text) whose nulls, which match nothing, are spread over the tasks by a hash of the row."""
    return F.coalesce(key, F.concat(F.lit("no key "), F.xxhash64(*row).cast("string")))


def normalize_gpn(c: str | Column) -> Column:
    """A person number as eight digits: without `.0`, trimmed, padded when shorter; nothing and zeros are null."""
    t = F.trim(F.regexp_replace(F.trim(_c(c).cast("string")), r"\.0$", ""))
    gone = t.isin("", "nan", "None", "none", "NaN", "null") | t.rlike("^0+$")
    return F.when(~gone, F.when(F.length(t) < 8, F.lpad(t, 8, "0")).otherwise(t))


def to_local_ts(c: str | Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC text or timestamp to wall time of the zone; what cannot be parsed is null."""
    utc = F.try_to_timestamp(_c(c).cast("string")).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def lenient_ts(c: str | Column) -> Column:
    return F.try_to_timestamp(_c(c).cast("string")).cast("timestamp_ntz")


def parse_date_key(c: str | Column) -> Column:
    """A day key YYYYMMDD; null if it is none."""
    return F.try_to_timestamp(_c(c), F.lit("yyyyMMdd")).cast("date")


def label_null(c: str | Column, label: str = "(Unknown)") -> Column:
    return F.coalesce(_c(c), F.lit(label))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(_c(c), F.lit(0))


def format_mmss(c: str | Column) -> Column:
    """Seconds as m:ss; null stays null."""
    s = F.floor(F.round(_c(c))).cast("long")
    return F.when(_c(c).isNotNull(), F.format_string("%d:%02d", F.floor(s / 60), s % 60))


def timespan_hours(send: str, event: str) -> Column:
    """Whole hours from sending to the event."""
    return F.floor(F.timestamp_diff("SECOND", F.col(send), F.col(event)) / 3600).cast("int")


def seconds_to_event(send: str, event: str) -> Column:
    return F.timestamp_diff("SECOND", F.col(send), F.col(event))


def device_type(agent: str | Column) -> Column:
    low = F.lower(_c(agent))
    return F.when(low.rlike("mobile|iphone|android|ipad"), "mobile").when(low.isNotNull(), "desktop")


def final_device_type(agent: str | Column, multi: Column) -> Column:
    """The device label; one device alone says `Only`."""
    d = F.coalesce(device_type(agent), F.lit("unknown"))
    return F.when(multi, "desktop & mobile").otherwise(F.concat(d, F.lit(" Only")))


def in_window(c: str | Column, start: str | dt.date | None = None, end: str | dt.date | None = None) -> Column:
    """Inclusive on both ends; a missing end is open."""
    out = F.lit(True)
    if start is not None:
        out = out & (_c(c) >= F.lit(start))
    if end is not None:
        out = out & (_c(c) <= F.lit(end))
    return out


def optional_eq(c: str | Column, value: str | None) -> Column:
    """Equality without regard to case; an empty parameter matches all."""
    return F.lower(_c(c)) == value.lower() if value else F.lit(True)


def url_contains(df: DataFrame, pattern: str, col: str = "url", regex: bool = False) -> DataFrame:
    """Rows whose URL contains (or matches) the pattern without regard to case; put it before any JSON parsing."""
    return df.filter(F.col(col).rlike(f"(?i){pattern}") if regex else F.lower(col).contains(pattern.lower()))


def active_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_active") == 1)


def tracked_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("tracking_id").isNotNull())


def scope_articles(pages: DataFrame, sites: DataFrame, site_name: str, floor: str) -> DataFrame:
    """Pages of one site with an article date from the floor on."""
    return pages.filter(F.col("article_date") >= F.lit(floor).cast("date")).join(sites.filter(F.col("site_name") == site_name).select("site_id"), "site_id")


def drop_sentinel_dates(df: DataFrame, col: str = "event_date") -> DataFrame:
    """Without the open-ended dates of the far future."""
    return df.filter(F.col(col) < F.lit("2100-01-01").cast("date"))


def event_family(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("name") == name)


def filter_members(df: DataFrame, keys: DataFrame, on: str, negate: bool = False) -> DataFrame:
    """IN (subquery), or NOT IN by an anti join that a null key cannot empty."""
    return df.join(keys.select(on), on, "left_anti" if negate else "left_semi")


def k_anonymous(df: DataFrame, keys: list[str], user: str, k: int = 5) -> DataFrame:
    """Rows of groups with at least k distinct users."""
    return df.join(df.groupBy(*keys).agg(F.count_distinct(user).alias("n")).filter(F.col("n") >= k).select(*keys), keys, "left_semi")


def share(x: Column, y: Column, digits: int = 4) -> Column:
    """x / y rounded; 0 / 0 and anything by 0 are null."""
    return F.round(F.try_divide(x.cast("double"), y.cast("double")), digits)
