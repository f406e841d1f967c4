"""Key inventory of events with properties nested at any level, by VARIANT values.

A property cell is parsed once.  Strings that hold an object or an array as JSON are opened like nested values, so that
properties which were encoded once more are found too.  Each level is one generator over the level before, in one scan: a value that
cannot be opened stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 6


def parsed(c: str | Column) -> Column:
    """A text as a variant; broken or empty JSON is null."""
    return F.try_parse_json(F.col(c) if isinstance(c, str) else c)


def _kind(v: Column) -> Column:
    """The type of a variant, without what it holds: object, array, string, number, boolean or null."""
    k = F.schema_of_variant(v)
    return F.when(k.startswith("OBJECT"), "object").when(k.startswith("ARRAY"), "array").when(k == "STRING", "string").when(k == "BOOLEAN", "boolean").when(k == "VOID", "null").otherwise("number")


def _opened(v: Column) -> Column:
    """A string that holds JSON of an object or an array as that; other values as they are."""
    text = F.try_variant_get(v, "$", "string")
    inner = F.when((F.schema_of_variant(v) == "STRING") & F.ltrim(text).rlike(r"^[\[{]"), F.try_parse_json(text))
    return F.coalesce(inner, v)


def _entries(v: Column) -> Column:
    """What a variant holds: (step, value) of an object's keys and an array's elements (`[]`); null for other values and empty ones."""
    kind = _kind(v)
    fields = F.transform(F.map_entries(F.variant_get(v, "$", "map<string,variant>")), lambda e: F.struct(F.concat(F.lit("."), e["key"]).alias("step"), e["value"].alias("value")))
    items = F.transform(F.variant_get(v, "$", "array<variant>"), lambda e: F.struct(F.lit("[]").alias("step"), e.alias("value")))
    found = F.when(kind == "object", fields).when(kind == "array", items)
    return F.when(F.size(found) > 0, found)


def paths(df: DataFrame, col: str, depth: int = DEPTH) -> DataFrame:
    """(path, value) of all innermost values of a JSON column, down to `depth` levels: `.a.b` for keys, `[]` for any element."""
    rows = df.select(F.lit("$").alias("path"), _opened(parsed(col)).alias("value")).filter("value IS NOT NULL")
    for _ in range(depth):
        rows = rows.withColumn("e", F.explode_outer(_entries(F.col("value"))))
        step, value = F.col("e.step"), F.col("e.value")
        rows = rows.select(F.when(step.isNull(), F.col("path")).otherwise(F.concat("path", step)).alias("path"), F.when(step.isNull(), F.col("value")).otherwise(_opened(value)).alias("value"))
    return rows


def path_inventory(df: DataFrame, col: str, depth: int = DEPTH) -> DataFrame:
    """For each path: rows, its types (a path may have several), distinct values, and the least value, all as text."""
    p = paths(df, col, depth).select("path", _kind(F.col("value")).alias("kind"), F.coalesce(F.try_variant_get("value", "$", "string"), F.to_json("value")).alias("text"))
    few = p.groupBy("path", "kind", "text").agg(F.count("*").alias("n"))  # each different value once, before they are counted
    return few.groupBy("path").agg(F.sum("n").alias("n"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), F.count_distinct("text").alias("n_values"), F.min("text").alias("sample"))
