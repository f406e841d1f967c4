"""Tracking ids CLUSTER-PACK-YYMMDD-ACTIVITY-CHANNEL (5-7-6-7-3 characters) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENTS = ("cluster", "pack", "activity_date", "activity", "channel")
# Spellings of a missing id, and the channel suffixes of each system.
JUNK = ("", "nan", "None", "none", "null", "NULL")
CHANNELS = {"mail": ("EMI",), "pages": ("IAN", "ITS", "OPN", "ANC")}
CONFORMANT = r"^[A-Z0-9]{5}-[0-9]{7}-[0-9]{6}-[0-9]{7}-[A-Z]{3}$"


def first_id(*cols: str | Column) -> Column:
    """The first value that is neither null, blank nor a spelling of nothing, trimmed."""
    tidy = [F.trim(F.col(c) if isinstance(c, str) else c) for c in cols]
    return F.coalesce(*(F.when(~c.isin(*JUNK), c) for c in tidy))


def parse_tracking_id(df: DataFrame, *cols: str) -> DataFrame:
    """Adds tracking_id, its five segments (the fifth keeps the rest) and pack_id (null unless two segments are there)."""
    df = df.withColumn("tracking_id", first_id(*cols))
    parts = F.split("tracking_id", "-", 5)
    seg = [F.nullif(F.get(parts, i), F.lit("")) for i in range(5)]
    return df.withColumns({n: c for n, c in zip(SEGMENTS, seg, strict=True)} | {"pack_id": F.concat(seg[0], F.lit("-"), seg[1])})


def split_tracking(df: DataFrame, col: str = "tracking_id") -> DataFrame:
    """The query form: exact fifth part, a missing part is empty; campaign is the first two parts."""
    seg = [F.coalesce(F.get(F.split(col, "-"), i), F.lit("")) for i in range(5)]
    return df.withColumns({n: c for n, c in zip(SEGMENTS, seg, strict=True)} | {"pack_id": F.concat(seg[0], F.lit("-"), seg[1])})


def _segments(c: str | Column, n: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.slice(F.split(F.upper(F.trim(c)), "-"), 1, n), "-")


def pack_key(c: str | Column) -> Column:
    """The first two segments, upper-cased and trimmed; null stays null.  The only key across systems."""
    return _segments(c, 2)


def pack_key_split_part(c: str) -> Column:
    """The same by split_part, null where the id is null."""
    up = F.upper(F.trim(F.col(c)))
    return F.when(F.col(c).isNotNull(), F.concat_ws("-", F.split_part(up, F.lit("-"), F.lit(1)), F.split_part(up, F.lit("-"), F.lit(2))))


def activity_date_key(c: str | Column) -> Column:
    """The first three segments, for joins inside one system."""
    return _segments(c, 3)


def channel_suffix(c: str | Column) -> Column:
    return F.right(F.col(c) if isinstance(c, str) else c, F.lit(3))


def is_channel_of(c: str | Column, system: str) -> Column:
    return channel_suffix(c).isin(*CHANNELS[system])


def compose_tracking_id(cluster: Column, pack: Column, day: Column, activity: Column, channel: Column) -> Column:
    """A tracking id from its parts, padded to their widths."""
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat_ws("-", F.rpad(cluster, 5, "0"), pad(pack, 7), F.date_format(day, "yyMMdd"), pad(activity, 7), channel)


def is_conformant(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).rlike(CONFORMANT)
