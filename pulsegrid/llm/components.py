"""Connected components of a graph that is a table of links.

Alternating large-star and small-star steps (Kiveris et al., 2014): every step is an aggregation and
a join on one node, a star is never gathered in one task, and the links are written to the shared
folder between rounds.  The rounds needed grow with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.session import written


def _to_least(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) plus m: the least of u and all its v.  The least values are written first: Spark splits the rows of
    a node with very many links in a join of two tables, but not in a join with an aggregate."""
    least = written(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """links (u, v), of any order, to (node, root): each linked node and the least node of its component.
    Links with a null end or with two equal ends are left out."""
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    e = written(links.filter("u <> v").select(high, low).distinct())
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = _to_least(large.filter("u > v").distinct())
        small = star.select("u", F.col("m").alias("v")).unionByName(star.select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = written(small.filter("u > v").distinct())
