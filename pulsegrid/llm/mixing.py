"""Mixing sources to target weights by weighted fair queueing, in SQL functions only.

Every source is a queue of its documents in shuffled order, repeated up to `repeats` times.
A copy's virtual finish time is the number of its source's words up to it, divided by the source's target, where of the copy
itself half the words count: so a source's copy comes before time t just if taking it brings the source nearer to t times its
target.  (With all its words counted, every source would lose the copy that crosses the end, however long, and sources
of short documents would take the rest.)  The copies are globally range-sorted by finish time and truncated where their sum
would pass the total budget: the mix is the longest beginning of that order within the budget.  It ends near time 1, and a
source is then within half its crossing copy of its target, but for the target times the distance of the end from 1.

Targets share the budget by weight, none above `repeats` times its source's size; the excess goes
to the others by weight.  They come from one pass over the sources in order of size / weight.

Scale: word counts and the shuffle key are written once as a narrow table.  Running sums never
gather a source in one task: a source is cut by the first three digits of the shuffle key (4096
buckets), bucket sums are added up per source, and a window runs inside each bucket only.  The sorted copies
are a table of ranges; the sum of each range shows in which range the budget ends, and a running sum inside
that range alone gives the last copy of the mix.  One number for each range reaches the driver.  What is gathered in
one place are sums per source: sources are the mix's components and should number in the thousands.

Cases: a null text has size 0, and no copy of size 0 is in the mix (taken 0); a null source is a source, last in
order; a null key is allowed; repeated rows are each a document with copies of its own; rows that tie in the
shuffle key are ordered by key and size, and are otherwise alike; an empty table gives an empty mix; other
columns are ignored by `allocate` and `mix`; `mix_documents` keeps them, but puts its results in place of columns
named as these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.arrays import set_aside
from pulsegrid.llm.session import written

WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: int = 3) -> DataFrame:
    """(source) to (source, weight): 1, 2, .. cycle, repeating, by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", (place % cycle + 1).cast("long"))


def targets(totals: DataFrame, budget: int | None = None, repeats: int = 3) -> DataFrame:
    """(source, source_size, weight) plus target.  budget None: the sum of all sizes."""
    whole = Window.partitionBy()
    cap = F.col("source_size") * repeats
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.least(F.lit(budget), F.sum(cap).over(whole)) if budget is not None else F.sum("source_size").over(whole)
    t = totals.select("*", cap.alias("cap"), left.alias("all"), F.sum("weight").over(whole).alias("w_all"))
    t = t.select("*", (F.col("all") - F.coalesce(F.sum("cap").over(order), F.lit(0))).alias("left"), (F.col("w_all") - F.coalesce(F.sum("weight").over(order), F.lit(0))).alias("w_left"))
    full = F.col("cap") * F.col("w_left") <= F.col("left") * F.col("weight")
    level = F.min(F.when(~full, F.struct(F.col("cap") / F.col("weight"), F.struct("left", "w_left").alias("at")))).over(whole)["at"]
    t = t.select("source", "source_size", "weight", "cap", full.alias("full"), level.alias("at"))
    return t.select("source", "source_size", "weight", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("at.left") / F.col("at.w_left")).alias("target"))


def allocate(docs: DataFrame, size: Column, *, key: str = "doc_id", source: str = "source", weights: DataFrame | None = None, budget: int | None = None, repeats: int = 3, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: key, source, size, source_size, target, finish (of each copy taken), taken.

    weights: (source, weight), a source without one gets 0 words and has no source_size; None: cyclic_weights.  carry: columns that are kept."""
    run = _queued(docs, size, key, source, weights, budget, repeats, seed, carry)
    cut = _last(_sorted(run), run, budget)
    if cut is None:
        kept = F.array().cast("array<double>")
    else:
        at, last = cut["finish"], F.lit(cut["source"])
        # of equal times a null source comes last
        tied = F.lit(True) if cut["source"] is None else F.coalesce(F.col("source") <= last, F.lit(False))
        kept = F.filter("finish", lambda v: (v < at) | ((v == at) & tied))
    return run.select(F.col("k").alias(key), "source", "size", "source_size", "target", kept.alias("finish"), (F.col("size") * F.size(kept)).alias("taken"), *carry)


def _queued(docs: DataFrame, size: Column, key: str, source: str, weights: DataFrame | None, budget: int | None, repeats: int, seed: str, carry: tuple[str, ...]) -> DataFrame:
    """One row per document with the finish times of all its copies."""
    digest = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 16)
    rows = written(docs.select(F.col(key).alias("k"), F.col(source).alias("source"), size.alias("size"), digest.alias("h"), *carry).withColumn("bucket", F.substring("h", 1, 3)))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = cyclic_weights(totals) if weights is None else totals.join(weights.withColumnRenamed("source", "s"), totals["source"].eqNullSafe(F.col("s")), "inner").drop("s").filter("weight > 0")
    goal = targets(weighed, budget, repeats)
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = buckets.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    base = base.alias("b").join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source")), "left").select(F.col("b.source").alias("bs"), F.col("b.bucket").alias("bb"), "base", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "k", "size", *carry).rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("run", F.sum("size").over(inside))
    run = run.join(base, F.col("source").eqNullSafe(F.col("bs")) & (F.col("bucket") == F.col("bb")))
    times = F.expr(f"transform(sequence(0, {repeats - 1}), p -> (p * source_size + base + run - size / 2) / target)")
    run = run.withColumn("finish", F.when((F.col("target") > 0) & (F.col("size") > 0), times).otherwise(F.array().cast("array<double>")))
    return written(run.select("k", "source", "size", "source_size", "target", "finish", *carry))


def _sorted(run: DataFrame) -> DataFrame:
    """All copies (finish, source, size), globally sorted, with the number of their range; later ranges hold later times.
    Within a source no two copies share a time, so that (finish, source) is a full order."""
    copies = run.select(F.explode("finish").alias("finish"), "source", "size")
    order = [F.col("finish").asc(), F.col("source").asc_nulls_last()]
    ranges = int(run.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(copies.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()).sortWithinPartitions(*order))


def _last(copies: DataFrame, run: DataFrame, budget: int | None) -> Row | None:
    """The last copy (finish, source) of the longest beginning of the sorted copies whose sum is within the budget."""
    total = budget if budget is not None else run.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    used, last = 0, None
    for r in copies.groupBy("range").agg(F.sum("size").alias("n")).orderBy("range").collect():  # one row for each range
        last = r["range"]
        if used + r.n > total:
            break
        used += r.n
    else:
        used -= r.n if last is not None else 0  # all copies: the last one ends the mix
    if last is None:
        return None
    order = Window.orderBy("finish", F.col("source").asc_nulls_last())
    inside = copies.filter(F.col("range") == last).withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    found = inside.filter(F.col("sum") <= total - used).orderBy(F.desc("sum")).select("finish", "source").first()
    if found is None and last > 0:  # the first copy of this range is too much
        found = copies.filter(F.col("range") < last).orderBy(F.desc("finish"), F.col("source").desc_nulls_first()).select("finish", "source").first()
    return found


def mix(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The mix itself: one row per copy taken, globally sorted by finish time."""
    rows = allocate(docs, size, **options)
    copies = rows.select(*(c for c in rows.columns if c not in ("finish", "taken")), F.posexplode("finish").alias("copy", "finish"))
    return copies.orderBy("finish", F.col("source").asc_nulls_last())


def mix_documents(docs: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The documents that the mix takes, with their columns, size, target (of the source), copies and taken words.

    Documents get numbers in a table of their own, so that repeated rows keep apart."""
    named, back = set_aside(docs, "size", "target", "copies", "taken", "__row")
    away = {old: new for new, old in back.items()}
    named = written(named.withColumn("__row", F.monotonically_increasing_id()))
    rows = allocate(named, words(F.col(away.get(text, text))), key=away.get(key, key), source=away.get(source, source), carry=("__row",), **options)
    took = rows.filter("taken > 0").select("__row", "size", "target", F.size("finish").alias("copies"), "taken")
    kept = [c for c in docs.columns if c.lower() not in ("size", "target", "copies", "taken")]
    return named.join(took, "__row").drop("__row").withColumnsRenamed({n: c for n, c in back.items() if c in kept}).select(*(f"`{c}`" for c in kept), "size", "target", "copies", "taken")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return allocate(docs, words(F.col("text"))).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
a AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0) AS rest, sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS w_rest
      FROM s WINDOW o AS (ORDER BY 3 * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT rest, w_rest FROM a WHERE cap * w_rest > rest * weight ORDER BY cap / weight, source ASC NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN cap * w_rest <= rest * weight THEN CAST(cap AS DOUBLE) ELSE CAST(weight * (SELECT rest FROM f) AS DOUBLE) / CAST((SELECT w_rest FROM f) AS DOUBLE) END AS target FROM a),
r AS (SELECT d.doc_id, t.source, d.size, t.source_size, t.target, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS run
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT source, size, (CAST(p * source_size + run AS DOUBLE) - CAST(size AS DOUBLE) / 2) / target AS finish FROM r, (SELECT unnest([0, 1, 2]) AS p) WHERE target > 0 AND size > 0),
q AS (SELECT source, finish, row_number() OVER o AS place, sum(size) OVER o AS used FROM c WINDOW o AS (ORDER BY finish, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
v AS (SELECT finish AS cut, source AS cut_source FROM q WHERE used <= (SELECT sum(size) FROM d) ORDER BY place DESC LIMIT 1)
SELECT doc_id, size, source_size, target,
       CAST(size * CASE WHEN target > 0 AND size > 0 AND cut IS NOT NULL THEN len(list_filter([0, 1, 2], lambda p: (CAST(p * source_size + run AS DOUBLE) - CAST(size AS DOUBLE) / 2) / target < cut OR ((CAST(p * source_size + run AS DOUBLE) - CAST(size AS DOUBLE) / 2) / target = cut AND coalesce(source <= cut_source, cut_source IS NULL)))) ELSE 0 END AS BIGINT) AS taken
FROM r LEFT JOIN v ON true
"""
