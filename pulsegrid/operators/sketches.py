"""Distinct counts from stored sketches: one mergeable sketch for each key and day, united over any span.

A sketch has a fixed size (2**log_k registers at most), whatever it counts, so that a day is read once, and spans, urls, sites
or the whole are unions of what is stored.  The relative standard error is about 1.04 / sqrt(2**log_k): 1.6 % for 12; few values are
counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K = 12


def tolerance(log_k: int = LOG_K, sigmas: float = 5.0) -> float:
    """The relative error that a union of sketches stays within, but for about one case in two million."""
    return sigmas * 1.04 / (1 << log_k) ** 0.5


def daily(df: DataFrame, keys: list[str], day: str | Column, log_k: int = LOG_K, **values: str) -> DataFrame:
    """(keys, day, rows, a sketch for each named value): what to store.  Null values and days do not count."""
    d = df.withColumn("day", F.to_date(day)).filter("day IS NOT NULL")
    return d.groupBy(*keys, "day").agg(F.count("*").alias("rows"), *(F.hll_sketch_agg(c, log_k).alias(n) for n, c in values.items()))


def united(stored: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Rows and estimates by fewer keys (or none): sketches are merged inside each task first."""
    return stored.groupBy(*keys).agg(F.sum("rows").alias("rows"), *(F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names))


def rolling(stored: DataFrame, keys: list[str], name: str, spans: tuple[int, ...] = (1, 7, 14, 21, 28)) -> DataFrame:
    """Estimates over the last days of each span, for each key and day that is stored: a day's sketch goes to the at most
    max(spans) days that it counts for, once, and is united there for each span."""
    days = stored.select(*keys, "day").withColumn("__on", F.lit(True))
    ahead = F.explode(F.sequence(F.lit(0), F.lit(max(spans) - 1))).alias("age")
    moved = stored.select(*keys, "day", name, ahead).withColumn("day", F.date_add("day", F.col("age")))
    moved = moved.alias("m").join(days.alias("d"), [F.col(f"m.{k}").eqNullSafe(F.col(f"d.{k}")) for k in (*keys, "day")]).select("m.*")  # only days that are asked for
    est = [F.hll_sketch_estimate(F.hll_union_agg(F.when(F.col("age") < s, F.col(name)))).alias(f"{name}_{s}d") for s in spans]
    return moved.groupBy(*keys, "day").agg(*est)


def close(estimate: str | Column, exact: str | Column, log_k: int = LOG_K) -> Column:
    """Whether an estimate is within the tolerance of the exact number, or within 1."""
    e, x = (F.col(c) if isinstance(c, str) else c for c in (estimate, exact))
    return F.abs(e - x) <= F.greatest(F.lit(1.0), x * tolerance(log_k))
