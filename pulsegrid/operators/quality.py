"""Profiling, key discovery and reconciliation.  Each table is read once, whatever its number of columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.tracking import CONFORMANT
from pulsegrid.functions.values import active_only, share


_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def _stack(cols: list[tuple[str, Column]], names: tuple[str, ...]) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(n).alias(names[0]), c.alias(names[1])) for n, c in cols)))


def profile_columns(df: DataFrame, samples: int = 5) -> DataFrame:
    """(column, type, n, nulls, distinct, samples) of every column: all columns in one scan, as (column, value) pairs
    whose counts are added up before the shuffle.  Samples are the least values."""
    types = dict(df.dtypes)
    pairs = df.select(_stack([(c, F.col(c).cast("string")) for c in df.columns], ("column", "value")).alias("p")).select("p.*")
    per = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
    nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    out = per.groupBy("column").agg(F.sum("n").alias("n"), nulls.alias("nulls"), F.count("value").alias("distinct"))
    least = _least_values(per, samples)
    kind = F.create_map(*(F.lit(x) for kv in types.items() for x in kv))
    return out.join(least, "column", "left").select("column", kind[F.col("column")].alias("type"), "n", "nulls", "distinct", "samples")


def _least_values(per: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("column").orderBy("value")
    few = per.filter("value IS NOT NULL").withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)  # cut inside each task first
    return few.groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), ",").alias("samples"))


def candidate_keys(profiles: Mapping[str, DataFrame]) -> DataFrame:
    """Columns that two or more tables have, with their tables and distinct counts, widest first."""
    p = reduce(DataFrame.unionByName, (d.select(F.lit(n).alias("table"), "column", "distinct") for n, d in profiles.items()))
    t = F.array_sort(F.collect_list(F.struct("table", "distinct")))
    g = p.groupBy("column").agg(F.count("*").alias("n_tables"), t.alias("t")).filter("n_tables > 1")
    return g.select("column", "n_tables", F.array_join(F.transform("t", lambda x: F.concat_ws(":", x["table"], x["distinct"].cast("string"))), ",").alias("tables")).orderBy(F.desc("n_tables"), "column")


def key_overlap(tables: Mapping[str, DataFrame], keys: Mapping[str, str]) -> DataFrame:
    """For each pair of tables: distinct keys of both, shared keys, shares, and the class of the relation.

    One pass: the tables of each value are gathered, which are as few as the tables."""
    v = reduce(DataFrame.unionByName, (d.select(F.lit(n).alias("t"), F.col(keys[n]).cast("string").alias("v")).filter("v IS NOT NULL").distinct() for n, d in tables.items()))
    size = v.groupBy("t").agg(F.count("*").alias("n"))
    of = v.groupBy("v").agg(F.array_sort(F.collect_set("t")).alias("ts")).filter(F.size("ts") > 1)
    pair = of.select(F.explode(F.flatten(F.transform("ts", lambda a: F.transform(F.filter("ts", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("shared"))
    out = pair.join(size.select(F.col("t").alias("a"), F.col("n").alias("n_a")), "a").join(size.select(F.col("t").alias("b"), F.col("n").alias("n_b")), "b")
    sa, sb = share(F.col("shared"), F.col("n_a")), share(F.col("shared"), F.col("n_b"))
    kind = F.when((sa > 0.9) & (sb > 0.9), "1:1").when((sa > 0.9) & (sb < 0.5), "1:N").when((sb > 0.9) & (sa < 0.5), "N:1").otherwise("M:N")
    return out.select("a", "b", "n_a", "n_b", "shared", sa.alias("share_a"), sb.alias("share_b"), kind.alias("relation"))


_BITS = 62  # of a long


def _value_sets(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]], by_name: bool) -> DataFrame:
    """(column, names, n): how many different values occur in exactly these tables' columns of a name, or, without by_name, in
    exactly these `table.column`s.  One pass and one shuffle: each row sets the bit of its table or column, and the bits of a
    value are joined inside each task before values meet."""
    names = [t for t in tables if columns[t]] if by_name else [f"{t}.{c}" for t in tables for c in columns[t]]
    if not names:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "column string, names array<string>, n long")
    words = range((len(names) - 1) // _BITS + 1)
    bits = lambda name: [F.lit(1 << at % _BITS if at // _BITS == w else 0).cast("long").alias(f"bits{w}") for at in [names.index(name)] for w in words]
    pairs = []
    for t, d in tables.items():
        if columns[t]:
            what = [F.struct(F.lit(c if by_name else "").alias("column"), F.col(c).cast("string").alias("v"), *bits(t if by_name else f"{t}.{c}")) for c in columns[t]]
            pairs.append(d.select(F.explode(F.array(*what)).alias("p")).select("p.*").filter("v IS NOT NULL"))
    sets = reduce(DataFrame.unionByName, pairs).groupBy("column", "v").agg(*(F.bit_or(f"bits{w}").alias(f"bits{w}") for w in words))
    sets = sets.groupBy("column", *(f"bits{w}" for w in words)).agg(F.count("*").alias("n"))
    of = [F.when(F.col(f"bits{at // _BITS}").bitwiseAND(F.lit(1 << at % _BITS)) != 0, F.lit(name)) for at, name in enumerate(names)]
    return sets.select("column", F.array_sort(F.array_compact(F.array(*of))).alias("names"), "n")


def _pairs_of(names: str, ordered: bool) -> Column:
    others = lambda a: F.filter(names, lambda b: b > a if ordered else b != a)
    return F.explode(F.flatten(F.transform(names, lambda a: F.transform(others(a), lambda b: F.struct(a.alias("a"), b.alias("b"))))))


def column_overlaps(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every column that two tables share by name, for every pair of tables with a value in common: distinct values of both, common
    ones, both percentages, and the class of the relation."""
    names = [c for d in tables.values() for c in d.columns]
    shared = {t: [c for c in d.columns if names.count(c) > 1 and not isinstance(d.schema[c].dataType, _NESTED)] for t, d in tables.items()}
    sets = _value_sets(tables, shared, by_name=True)
    size = sets.select("column", F.explode("names").alias("t"), "n").groupBy("column", "t").agg(F.sum("n").alias("size"))
    both = sets.select("column", _pairs_of("names", ordered=True).alias("p"), "n").groupBy("column", F.col("p.a").alias("table_1"), F.col("p.b").alias("table_2")).agg(F.sum("n").alias("overlap"))
    out = both.join(size.select("column", F.col("t").alias("table_1"), F.col("size").alias("distinct_1")), ["column", "table_1"]).join(size.select("column", F.col("t").alias("table_2"), F.col("size").alias("distinct_2")), ["column", "table_2"])
    p1, p2 = (F.round(F.col("overlap") * 100.0 / F.col(f"distinct_{i}"), 1) for i in (1, 2))
    out = out.withColumns({"pct_1_in_2": p1.cast("double"), "pct_2_in_1": p2.cast("double")})
    one, two, a, b = F.col("table_1"), F.col("table_2"), F.col("pct_1_in_2"), F.col("pct_2_in_1")
    kind = F.when((a > 90) & (b < 50), F.concat(one, F.lit(" N:1 "), two)).when((b > 90) & (a < 50), F.concat(two, F.lit(" N:1 "), one)).when((a > 90) & (b > 90), "1:1").otherwise("M:N or partial")
    return out.select("column", "table_1", "table_2", "distinct_1", "distinct_2", "overlap", "pct_1_in_2", "pct_2_in_1", kind.alias("relationship"))


def inclusions(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]]) -> DataFrame:
    """Inclusion dependencies: pairs of `table.column`s, of any names, where every value of the first occurs in the second."""
    sets = _value_sets(tables, columns, by_name=False)
    size = sets.select(F.explode("names").alias("name"), "n").groupBy("name").agg(F.sum("n").alias("n"))
    both = sets.select(_pairs_of("names", ordered=False).alias("p"), "n").groupBy(F.col("p.a").alias("name"), F.col("p.b").alias("within")).agg(F.sum("n").alias("common"))
    return both.join(size, "name").filter("common = n").select("name", "within", "n")


def pattern_counts(df: DataFrame, regex: str) -> DataFrame:
    """(column, n, matches) of the string columns, in one pass."""
    cols = [c for c, k in df.dtypes if k == "string"]
    row = df.agg(*(F.count(c).alias(f"n_{c}") for c in cols), *(F.count_if(F.col(c).rlike(regex)).alias(f"m_{c}") for c in cols))
    return row.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n"), F.col(f"m_{c}").alias("matches")) for c in cols))).alias("p")).select("p.*")


def table_fingerprint(tables: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(table, n, keys, first, last): rows, distinct keys and time range of each (frame, key, time column)."""
    one = lambda n, d, k, t: d.agg(F.lit(n).alias("table"), F.count("*").alias("n"), F.count_distinct(k).alias("keys"), F.min(t).cast("date").alias("first"), F.max(t).cast("date").alias("last"))
    return reduce(DataFrame.unionByName, (one(n, *x) for n, x in tables.items()))


def enum_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, n) of columns with few values."""
    return df.select(_stack([(c, F.col(c).cast("string")) for c in cols], ("column", "value")).alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def dedup_profile(engagement: DataFrame) -> DataFrame:
    """Per link type: rows, distinct (mailing, recipient) pairs, and rows per pair."""
    g = engagement.groupBy("link_type", "mailing_id", "person_key").agg(F.count("*").alias("n")).groupBy("link_type")
    return g.agg(F.sum("n").alias("rows"), F.count("*").alias("pairs"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.sum("n") / F.count("*"), 4).alias("mean"))


def most_repeated(engagement: DataFrame, n: int = 10) -> DataFrame:
    """The mailings with most rows beyond one per recipient and type."""
    g = engagement.groupBy("mailing_id", "link_type", "person_key").agg((F.count("*") - 1).alias("more")).groupBy("mailing_id")
    return g.agg(F.sum("more").alias("extra")).orderBy(F.desc("extra"), "mailing_id").limit(n)


def temporal_coverage(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table, year, n, first, last)."""
    one = lambda name, d, c: d.groupBy(F.lit(name).alias("table"), F.year(c).alias("year")).agg(F.count("*").alias("n"), F.min(c).cast("date").alias("first"), F.max(c).cast("date").alias("last"))
    return reduce(DataFrame.unionByName, (one(n, *x) for n, x in tables.items()))


def id_conformance(df: DataFrame, col: str = "tracking_id") -> DataFrame:
    """Ids that are null, empty, conformant, malformed, and in mixed case."""
    c = F.col(col)
    there = c.isNotNull() & (F.trim(c) != "")
    return df.agg(F.count("*").alias("n"), F.count_if(c.isNull()).alias("nulls"), F.count_if(F.trim(c) == "").alias("empty"), F.count_if(c.rlike(CONFORMANT)).alias("conformant"), F.count_if(there & ~c.rlike(CONFORMANT)).alias("malformed"), F.count_if(c != F.upper(c)).alias("mixed_case"))


def duplicate_keys(df: DataFrame, key: str, value: str, keep: int = 20) -> DataFrame:
    """Keys that occur more than once: their rows, how many different values they have, and the least `keep` of these, so that a
    junk key with most of the rows is one short row.  A null key is a key."""
    many = df.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("n")).filter("n > 1")
    pairs = df.select(F.col(key).alias(key), F.col(value).cast("string").alias("v")).distinct()
    found = pairs.groupBy(key).agg(F.count("v").alias("n_values"))
    few = pairs.filter("v IS NOT NULL").withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("v"))).filter(F.col("r") <= keep)
    few = few.groupBy(F.col(key).alias("__f")).agg(F.array_join(F.array_sort(F.collect_list("v")), ",").alias("values"))
    out = found.join(many, F.col(key).eqNullSafe(F.col("__k"))).join(few, F.col(key).eqNullSafe(F.col("__f")), "left")
    return out.select(key, "n", "n_values", F.coalesce("values", F.lit("")).alias("values"))


def match_strategies(ids: DataFrame, id_col: str, hr: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """(strategy, hits): how many distinct ids each way of writing the HR key finds."""
    want = ids.select(F.col(id_col).cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    tried = hr.select(_stack([(n, c.cast("string")) for n, c in columns.items()], ("strategy", "value")).alias("p")).select("p.*").distinct()
    names = hr.sparkSession.createDataFrame([(n,) for n in columns], "strategy string")
    hits = tried.join(want, "value", "left_semi").groupBy("strategy").agg(F.count("*").alias("hits"))
    return names.join(hits, "strategy", "left").na.fill(0, "hits")


def sample_values(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """The n least distinct values."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def intersect_values(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def new_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of a whose key b does not have; a null key counts as new."""
    return a.join(b.select(key).distinct(), key, "left_anti")


def order_result(df: DataFrame, keys: list[tuple[str, bool]]) -> DataFrame:
    """Sorts by (column, descending); nulls last."""
    return df.orderBy(*(F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_last() for c, d in keys))


def top_k(df: DataFrame, keys: list[tuple[str, bool]], k: int) -> DataFrame:
    return order_result(df, keys).limit(k)


def active_share(engagement: DataFrame) -> DataFrame:
    return engagement.agg(F.count("*").alias("n")).join(active_only(engagement).agg(F.count("*").alias("active")), F.lit(True))
