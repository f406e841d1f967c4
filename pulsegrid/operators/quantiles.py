"""Exact percentiles without gathering or sorting all values.

The values of a rank are closed in on: an approximate percentile gives bounds around it, counts of what is below and inside prove
the bounds, and the next round looks inside them only, until few enough different values are left, which are counted and put in
order.  Each round is a pass that every task adds up by itself; a task never holds more than a sketch or `few` different values,
however many ties there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 2000
FEW = 10_000
MARGIN = 2.0 / ACCURACY


@dataclass
class _Rank:
    """The k-th value (from 0) is in [low, high]; `below` values are less than low, `inside` are in the range."""

    k: int
    low: float | None
    high: float | None
    below: int
    inside: int

    @property
    def known(self) -> bool:
        return self.low == self.high

    def holds(self, c):
        return (c >= F.lit(self.low)) & (c <= F.lit(self.high))


def _narrow(v: DataFrame, ranks: list[_Rank], few: int) -> None:
    """One round for all open ranks: bounds by sketches, then counts that prove them."""
    c, open_ = F.col("v"), [r for r in ranks if not r.known and r.inside > few]
    inner = [F.when(r.holds(c), c) for r in open_]
    cuts = [[max(0.0, min(1.0, (r.k - r.below) / r.inside + d)) for d in (-MARGIN, MARGIN)] for r in open_]
    row = v.agg(*(F.percentile_approx(x, [*cut], ACCURACY).alias(f"q{i}") for i, (x, cut) in enumerate(zip(inner, cuts, strict=True)))).first()
    bounds = [(row[f"q{i}"][0], row[f"q{i}"][1]) for i in range(len(open_))]
    counts = []
    for i, (x, (lo, hi)) in enumerate(zip(inner, bounds, strict=True)):
        within = F.when((x > lo) & (x < hi), x)
        counts += [F.count_if(x < lo).alias(f"less{i}"), F.count_if(x == lo).alias(f"lo{i}"), F.count(within).alias(f"within{i}"), F.count_if(x == hi).alias(f"hi{i}")]
        counts += [F.max(F.when(x < lo, x)).alias(f"under{i}"), F.min(within).alias(f"least{i}"), F.max(within).alias(f"most{i}"), F.min(F.when(x > hi, x)).alias(f"over{i}")]
    row = v.agg(*counts).first()
    for i, (r, (lo, hi)) in enumerate(zip(open_, bounds, strict=True)):
        less, at_lo, within, at_hi, place = row[f"less{i}"], row[f"lo{i}"], row[f"within{i}"], row[f"hi{i}"] if lo != hi else 0, r.k - r.below
        if place < less:  # the sketch was off: what is below its bounds
            r.high, r.inside = row[f"under{i}"], less
        elif place < less + at_lo:
            r.low = r.high = lo
        elif place < less + at_lo + within:
            r.low, r.high, r.below, r.inside = row[f"least{i}"], row[f"most{i}"], r.below + less + at_lo, within
        elif place < less + at_lo + within + at_hi:
            r.low = r.high = hi
        else:
            upto = less + at_lo + within + at_hi
            r.low, r.below, r.inside = row[f"over{i}"], r.below + upto, r.inside - upto


def _finish(v: DataFrame, ranks: list[_Rank]) -> dict[int, float]:
    """The values of the ranks, from counts of the at most FEW values of each rank that is open."""
    c, out, still = F.col("v"), {r.k: r.low for r in ranks if r.known}, [r for r in ranks if not r.known]
    for r in still:
        seen, at = r.below, None
        for row in v.filter(r.holds(c)).groupBy("v").agg(F.count("*").alias("n")).orderBy("v").collect():  # at most FEW rows
            seen += row.n
            if seen > r.k:
                at = row.v
                break
        out[r.k] = at
    return out


def exact_percentiles(df: DataFrame, col: str, fractions: list[float], few: int = FEW) -> list[float | None]:
    """The percentiles of a numeric column, interpolated between neighbours as `percentile` and `median` do; null values do not
    count, NaN is greater than all others, and without values all are None."""
    v = df.select(F.col(col).cast("double").alias("v")).filter("v IS NOT NULL").persist()  # read by each round
    try:
        return _percentiles(v, fractions, few)
    finally:
        v.unpersist()


def _percentiles(v: DataFrame, fractions: list[float], few: int) -> list[float | None]:
    total, nans, low, high = v.agg(F.count("*"), F.count_if(F.isnan("v")), F.min(F.when(~F.isnan("v"), F.col("v"))), F.max(F.when(~F.isnan("v"), F.col("v")))).first()
    if not total:
        return [None] * len(fractions)
    n, numbers = total - nans, v.filter(~F.isnan("v"))
    places = [(total - 1) * f for f in fractions]
    ranks = {k: _Rank(k, low, high, 0, n) for p in places for k in (math.floor(p), math.ceil(p)) if k < n}
    while any(not r.known and r.inside > few for r in ranks.values()):  # each round takes the values at both bounds out, at least
        _narrow(numbers, list(ranks.values()), few)
    of = _finish(numbers, list(ranks.values()))
    value = lambda k: of.get(k, math.nan)
    return [value(math.floor(p)) + (value(math.ceil(p)) - value(math.floor(p))) * (p - math.floor(p)) if math.floor(p) != math.ceil(p) else value(int(p)) for p in places]
