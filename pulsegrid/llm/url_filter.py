"""URL filters as of the time of fetching, in SQL functions only.

Dated list entries (list, pattern, action `add` or `remove`, day) become validity intervals.  A pattern is a
host name, which covers its subdomains, or a host name and a path prefix that ends at a slash.  A capture's
keys are the suffixes of its host and the prefixes of its path, so that an entry applies where a key equals
its pattern; the as-of join is an equality on the key with the day inside the interval.  The longest active
pattern decides, `allow` before `block`.

Scale: keys are joined as distinct (key, day) pairs, so that a host with a third of all captures costs one
row for each day; results return to the captures by (url, day).  What is known of a (key, day) or a (url, day) is
a table of its own before captures meet it, as Spark splits the rows of a frequent key in a join of two tables, but not
in a join with an aggregate.  No side is broadcast unless Spark sees that it is small.

Cases: a null URL, one without a host, or a null day has no active entry and is kept; entries with a null
field are ignored; on one day a removal counts after an addition; repeated entries count once; repeated
captures are each returned; other columns of the captures are kept, but the results take the place of columns named
as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.llm.arrays import set_aside
from pulsegrid.llm.session import written

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)"


def host(url: Column) -> Column:
    """The lower-cased host name; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, start, stop): the days on which an entry is active; stop is exclusive, null while it lasts."""
    e = entries.select("list", "pattern", "day", "action").dropna().distinct()
    e = e.groupBy("list", "pattern", "day").agg(F.max("action").alias("action"))  # remove sorts after add
    ahead = F.lead("day").over(Window.partitionBy("list", "pattern").orderBy("day"))
    return e.withColumn("stop", ahead).filter("action = 'add'").select("list", "pattern", F.col("day").alias("start"), "stop")


def keys(url: Column) -> Column:
    """What an entry may name to cover this URL."""
    h, path = host(url), F.regexp_extract(url, PATH, 1)
    labels = F.split(h, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))), lambda i: F.concat(h, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/")))
    return F.concat(suffixes, F.when(F.size(parts) > 2, prefixes).otherwise(F.array().cast("array<string>")))


def judge(captures: DataFrame, entries: DataFrame, *, url: str = "url", day: str = "day") -> DataFrame:
    """captures plus n_active, pattern, list (of the deciding entry, or null) and verdict, `keep` or `drop`."""
    results = ("n_active", "pattern", "list", "verdict")
    named, back = set_aside(captures, *results, "__u", "__d", "__n", "__best")
    away = {old: new for new, old in back.items()}
    at_url, at_day = F.col(away.get(url, url)), F.col(away.get(day, day))
    u = written(named.select(at_url.alias("__u"), at_day.alias("__d")).dropna().distinct())
    u = u.filter(host(F.col("__u")).isNotNull()).select("__u", "__d", F.explode(keys(F.col("__u"))).alias("key"))
    span = intervals(entries)
    inside = (F.col("key") == F.col("pattern")) & (F.col("__d") >= F.col("start")) & (F.col("stop").isNull() | (F.col("__d") < F.col("stop")))
    active = written(u.select("key", "__d").distinct().join(span, inside).groupBy("key", "__d").agg(F.count("*").alias("n"), F.min("list").alias("list")))  # allow sorts before block
    best = F.max(F.struct(F.length("key").alias("size"), "key", "list")).alias("__best")
    told = written(u.join(active, ["key", "__d"]).groupBy("__u", "__d").agg(F.sum("n").alias("__n"), best))
    out = named.join(told, (at_url == F.col("__u")) & (at_day == F.col("__d")), "left").drop("__u", "__d")
    kept = [c for c in captures.columns if c.lower() not in results]
    out = out.withColumns({"n_active": F.coalesce("__n", F.lit(0)), "pattern": F.col("__best.key"), "list": F.col("__best.list"), "verdict": F.when(F.col("__best.list") == "block", "drop").otherwise("keep")})
    return out.drop("__n", "__best").withColumnsRenamed({n: c for n, c in back.items() if c in kept}).select(*(f"`{c}`" for c in kept), *results)


FIRST_DAY = "2024-01-01"


def _digit(c: Column, at: int, n: int = 2) -> Column:
    return F.conv(F.substring(F.md5(c), at, n), 16, 10).cast("int")


def list_history(pages: DataFrame) -> DataFrame:
    """A dated block list of sites and an allow list of path prefixes, drawn by hash from the URLs seen."""
    first = F.lit(FIRST_DAY).cast("date")
    site = pages.select(F.regexp_replace(host(F.col("url")), r"^(www|m|blog)\.", "").alias("pattern")).distinct().filter("pattern IS NOT NULL")
    start = _digit(F.col("pattern"), 1) % 180
    dated = lambda d, action: F.struct(F.date_add(first, d).alias("day"), F.lit(action).alias("action"))
    site = site.filter(_digit(F.col("pattern"), 3) < 96).select(F.lit("block").alias("list"), "pattern", F.explode(F.array(dated(start, "add"), dated(start + 40 + _digit(F.col("pattern"), 5) % 60, "remove"), dated(start + 120 + _digit(F.col("pattern"), 7) % 60, "add"))).alias("e"))
    area = pages.select(F.element_at(keys(F.col("url")), -1).alias("pattern")).distinct().filter("pattern LIKE '%/'")
    area = area.filter(_digit(F.col("pattern"), 3) < 64).select(F.lit("allow").alias("list"), "pattern", dated(_digit(F.col("pattern"), 1) % 240, "add").alias("e"))
    return site.unionByName(area).select("list", "pattern", "e.*")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of `pages`, fetched on days drawn from their ids, against a list history drawn from their URLs."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("page_id") * 37 % 366).cast("int"))
    return judge(pages.withColumn("day", day), list_history(pages)).select("page_id", "day", "n_active", "pattern", "list", "verdict")


def _sql_digit(c: str, at: int) -> str:
    return f"CAST('0x' || substr(md5({c}), {at}, 2) AS INTEGER)"


OP6_SQL = rf"""
WITH p AS (SELECT page_id, url, DATE '{FIRST_DAY}' + CAST(page_id * 37 % 366 AS INTEGER) AS day, lower(regexp_extract(url, '{HOST}', 1)) AS h, string_split(regexp_extract(url, '{PATH}', 1), '/') AS parts FROM pages),
k AS (
  SELECT page_id, url, day, unnest(list_transform(generate_series(1, len(string_split(h, '.'))), lambda i: array_to_string(string_split(h, '.')[i:], '.'))) AS key FROM p WHERE h <> ''
  UNION ALL
  SELECT page_id, url, day, unnest(list_transform(generate_series(2, len(parts) - 1), lambda i: h || array_to_string(parts[1:i], '/') || '/')) FROM p WHERE h <> '' AND len(parts) > 2),
site AS (SELECT DISTINCT regexp_replace(h, '^(www|m|blog)\.', '') AS pattern FROM p WHERE h <> ''),
area AS (SELECT DISTINCT h || array_to_string(parts[1:len(parts) - 1], '/') || '/' AS pattern FROM p WHERE h <> '' AND len(parts) > 2),
s AS (SELECT pattern, {_sql_digit("pattern", 1)} % 180 AS a, {_sql_digit("pattern", 5)} % 60 AS b, {_sql_digit("pattern", 7)} % 60 AS c FROM site WHERE {_sql_digit("pattern", 3)} < 96),
e AS (
  SELECT 'block' AS list, pattern, DATE '{FIRST_DAY}' + a AS start, DATE '{FIRST_DAY}' + (a + 40 + b) AS stop FROM s
  UNION ALL SELECT 'block', pattern, DATE '{FIRST_DAY}' + (a + 120 + c), NULL FROM s
  UNION ALL SELECT 'allow', pattern, DATE '{FIRST_DAY}' + ({_sql_digit("pattern", 1)} % 240), NULL FROM area WHERE {_sql_digit("pattern", 3)} < 64),
m AS (SELECT k.page_id, k.key, e.list FROM k JOIN e ON k.key = e.pattern AND k.day >= e.start AND (e.stop IS NULL OR k.day < e.stop)),
b AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (PARTITION BY page_id ORDER BY length(key) DESC, key DESC, list) AS r FROM m)
SELECT p.page_id, p.day, coalesce(b.n, 0) AS n_active, b.key AS pattern, b.list, CASE WHEN b.list = 'block' THEN 'drop' ELSE 'keep' END AS verdict
FROM p LEFT JOIN b ON p.page_id = b.page_id AND b.r = 1
"""
