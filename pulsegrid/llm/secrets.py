"""Secret scanning: base patterns, and character Markov models, in SQL functions only.

Base patterns give spans of three kinds.  On top, runs of key-like characters are scored under
two first-order Markov models, one of random strings and one of ordinary identifiers; where the
log-likelihood ratio per transition is high enough, the run becomes a `markov` span, unless one base span
holds all of it.  Runs shorter than SURE characters have fewer transitions and need a higher ratio.  Both models
are trained from labelled samples (string, is_random).

The models are one table of 66 x 66 log ratios, whatever the corpus; it is put into the plan as a
literal.  Training samples come from at most about `max_docs` documents (by a hash of the key);
every text is scanned whole.

Offsets are code points, ends exclusive.  A pattern's places come from the lengths of its matches
and of the text between them, added up by blocks (arrays.py), so that the work grows with the matches.

Cases: a null text is empty; texts without a match have no spans; without samples the models are
uniform and add nothing; repeated rows are each scanned; other columns are kept, but `scan` puts its results in
place of columns named `base_spans` and `spans`, which `clean` leaves as they are.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.arrays import let, running_max, running_sum, set_aside

# The base patterns, their order, and the least length of what they must hold.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = [("assign", ASSIGN, 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]{16,}", 0, 16)]
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_"
RATIO = 4.0
SURE = 20
CUT = 4096
BACK_OFF = 0.005
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _found(text: Column, pattern: str) -> Column:
    """start, end and text of a pattern's leftmost non-overlapping matches."""

    def place(pairs: Column) -> Column:
        begins = running_sum(F.transform(pairs, lambda p: (F.length(p["gap"]) + F.length(p["found"])).cast("long")))

        def one(p: Column, at: Column) -> Column:
            begin = at + F.length(p["gap"])
            return F.struct(begin.cast("int").alias("start"), (begin + F.length(p["found"])).cast("int").alias("end"), p["found"].alias("text"))

        return F.zip_with(pairs, begins, one)

    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = let(F.struct(found.alias("found"), gaps.alias("gaps")), lambda x: F.transform(x["found"], lambda m, i: F.struct(F.get(x["gaps"], i).alias("gap"), m.alias("found"))))
    return F.when(text.rlike(pattern), let(pairs, place)).otherwise(F.array().cast("array<struct<start:int,end:int,text:string>>"))


def _spans(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def _matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """The matches whose group has the least length."""
    inner = lambda m: F.length(F.regexp_extract(m["text"], pattern, group)) if group else F.length(m["text"])
    return F.filter(_found(text, pattern), lambda m: inner(m) >= least)


def base_spans(text: Column) -> Column:
    """The spans of the three base kinds, by start, then by kind as listed."""
    return F.array_sort(F.concat(*(_spans(_matches(text, p, g, n), kind, i) for i, (kind, p, g, n) in enumerate(PATTERNS))))


def train(samples: DataFrame) -> list[float]:
    """samples (token string, is_random boolean) to the 66 x 66 log ratios, row by former character.

    Counts pairs of neighbouring characters; each row of counts is joined by a share BACK_OFF of its sum spread like
    single characters, and these by the same share spread evenly, so that ratios do not grow with the samples."""
    k = len(ALPHABET) + 1
    pairs = samples.filter("token IS NOT NULL AND is_random IS NOT NULL").select("is_random", F.explode(F.expr("transform(sequence(2, greatest(2, length(token))), i -> substring(token, i - 1, 2))")).alias("pair")).filter("length(pair) = 2")
    a, b = F.instr(F.lit(ALPHABET), F.substring("pair", 1, 1)), F.instr(F.lit(ALPHABET), F.substring("pair", 2, 1))
    counts = pairs.groupBy("is_random", "pair").count().select("is_random", a.alias("a"), b.alias("b"), "count")
    n = {(r.is_random, r.a, r.b): r.n for r in counts.groupBy("is_random", "a", "b").agg(F.sum("count").alias("n")).collect()}  # at most 2 x 66 x 66 rows

    def shares(row: list[float], others: list[float]) -> list[float]:
        total = sum(row)
        return [(x / total + BACK_OFF * u) / (1 + BACK_OFF) if total else u for x, u in zip(row, others, strict=True)]

    def logs(kind: bool) -> list[list[float]]:
        seen = [[n.get((kind, a, b), 0) for b in range(k)] for a in range(k)]
        single = shares([sum(row[b] for row in seen) for b in range(k)], [1 / k] * k)
        return [[log(x) for x in shares(row, single)] for row in seen]

    random, ordinary = logs(True), logs(False)
    return [round(p - q, 6) for a in range(k) for p, q in zip(random[a], ordinary[a], strict=True)]


def ratio(token: Column, table: list[float]) -> Column:
    """The mean log-likelihood ratio (random to ordinary) of a token's transitions."""
    k = len(ALPHABET) + 1
    logs = F.lit(table)
    place = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = F.zip_with(F.slice(place, F.lit(1), F.greatest(F.size(place) - 1, F.lit(0))), F.slice(place, F.lit(2), F.greatest(F.size(place) - 1, F.lit(0))), lambda a, b: F.get(logs, a * k + b))
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + x) / F.greatest(F.size(pairs), F.lit(1))


def _loose(candidates: Column, base: Column) -> Column:
    """The candidates that no base span holds whole."""
    kind = lambda m, of_base, text: F.struct(m["start"].alias("start"), F.lit(0 if of_base else 1).alias("later"), m["end"].alias("end"), text.alias("text"))
    both = F.array_sort(F.concat(F.transform(base, lambda m: kind(m, True, F.lit(None).cast("string"))), F.transform(candidates, lambda m: kind(m, False, m["text"]))))

    def apart(x: Column) -> Column:
        reach = running_max(F.transform(x, lambda m: F.when(m["later"] == 0, m["end"]).otherwise(-1).cast("long")))
        return F.filter(F.zip_with(x, reach, lambda m, r: F.when((m["later"] == 1) & (r < m["end"]), m)), lambda m: m.isNotNull())

    return let(both, apart)


def _markov_spans(text: Column, base: Column, table: list[float], least: float) -> Column:
    loose = F.when(F.size(base) > 0, _loose(_found(text, CANDIDATE), base)).otherwise(F.transform(_found(text, CANDIDATE), lambda m: F.struct(m["start"].alias("start"), F.lit(1).alias("later"), m["end"].alias("end"), m["text"].alias("text"))))
    sure = lambda m: F.least(F.lit(1.0), (F.length(m["text"]) - 1) / (SURE - 1))
    return _spans(F.filter(loose, lambda m: ratio(m["text"], table) * sure(m) >= least), "markov", len(PATTERNS))


def numbered(key: Column, text: Column) -> Column:
    """Ordinary identifiers with digits, made of a text's words and of numbers drawn by a hash of its key:
    dated and numbered names, versions, paths, and numbers in groups."""
    word = lambda i: F.lower(F.coalesce(F.get(F.regexp_extract_all(F.substring(text, 1, 400), F.lit("[A-Za-z]{3,}"), F.lit(0)), F.lit(i)), F.lit("name")))

    def number(i: int, least: int, most: int, digits: int = 1) -> Column:
        drawn = (F.pmod(F.xxhash64(F.lit(i), key), F.lit(most - least + 1)) + least).cast("string")
        return F.lpad(drawn, digits, "0") if digits > 1 else drawn

    year, month, day, hour, minute = number(1, 1990, 2039), number(2, 1, 12, 2), number(3, 1, 28, 2), number(4, 0, 23, 2), number(5, 0, 59, 2)
    return F.array(
        F.concat_ws("_", word(0), year, month, day, word(1), number(6, 0, 9999, 4)),
        F.concat_ws("_", word(2), word(3), year, number(7, 0, 9999, 4)),
        F.concat(word(4), F.lit("_"), year, month, day, F.lit("_"), hour, minute, number(8, 0, 59, 2), F.lit("_"), word(5)),
        F.concat_ws("-", word(6), F.concat(F.lit("v"), number(9, 0, 20)), number(10, 0, 40), number(11, 0, 99), word(7)),
        F.concat(F.lit("/"), F.concat_ws("/", word(8), year, month, day, F.concat(word(9), F.lit("-"), number(12, 1, 999_999)))),
        F.concat_ws("-", F.upper(word(1)), number(13, 1, 999), number(14, 0, 9), number(15, 10, 99), number(16, 0, 999_999, 6), number(17, 0, 9)),
        F.concat(F.initcap(word(0)), F.initcap(word(2)), number(18, 0, 99_999), F.lit("="), number(19, 0, 99_999)),
    )


def samples(docs: DataFrame, key: str = "doc_id", text: str = "text", max_docs: int = 20_000) -> DataFrame:
    """Labelled samples from the corpus itself: values of base matches, and strings drawn by a hash, are
    random; runs of 8 and more letters and underscores, and names with numbers made from the words, are ordinary."""
    n = docs.count()
    part = min(1.0, max_docs / max(n, 1))
    some = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).filter(F.pmod(F.xxhash64(F.lit(5), "k"), F.lit(1_000_000)) < round(part * 1_000_000))
    token = F.filter(F.regexp_extract_all("t", F.lit(r"[A-Za-z_]{8,}"), F.lit(0)), lambda w: ~w.rlike("[0-9]"))
    ordinary = some.select(F.explode(token).alias("token"), F.lit(False).alias("is_random"))
    named = some.filter("k IS NOT NULL").select(F.explode(numbered(F.col("k"), F.col("t"))).alias("token"), F.lit(False).alias("is_random"))
    drawn = F.explode(F.array(F.base64(F.unhex(F.sha2(F.concat(F.lit("s"), F.col("k").cast("string")), 256))), F.upper(F.sha2(F.concat(F.lit("u"), F.col("k").cast("string")), 256)), F.sha2(F.concat(F.lit("h"), F.col("k").cast("string")), 256)))
    made = some.filter("k IS NOT NULL").select(drawn.alias("token"), F.lit(True).alias("is_random"))
    value = F.concat(*(F.transform(_matches(F.col("t"), p, g, n), lambda m: m["text"]) for _, p, g, n in PATTERNS))
    held = some.select(F.explode(value).alias("v")).select(F.regexp_extract("v", r"([A-Za-z0-9+/_-]+)[^A-Za-z0-9+/_-]*$", 1).alias("token"), F.lit(True).alias("is_random"))
    return ordinary.unionByName(named).unionByName(made).unionByName(held.filter("token <> ''"))


def scan(docs: DataFrame, table: list[float] | None, *, text: str = "text", least: float = RATIO) -> DataFrame:
    """docs plus base_spans and spans (base and markov), each sorted by start, then kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.drop("base_spans", "spans").withColumn("base_spans", base_spans(t))
    if table is None:
        return out.withColumn("spans", F.col("base_spans"))
    more = F.when(t.rlike(CANDIDATE), _markov_spans(t, F.col("base_spans"), table, least)).otherwise(F.array().cast(SPAN))
    return out.withColumn("spans", F.array_sort(F.concat("base_spans", more)))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with a mark in place of each stretch covered by spans (sorted by start).

    Pieces are cut out of blocks of CUT characters, as Spark reads a text from its start to find a place in it."""

    def piece(blocks: Column, a: Column, b: Column) -> Column:
        i, j = F.floor(a / CUT).cast("int"), F.floor(b / CUT).cast("int")
        block = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
        first, last = F.substring(block(i), a - i * CUT + 1, F.lit(CUT)), F.substring(block(j), F.lit(1), b - j * CUT)
        whole = F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), "")
        return F.when(i == j, F.substring(block(i), a - i * CUT + 1, b - a)).otherwise(F.concat(first, whole, last))

    def cut(x: Column) -> Column:
        reach = running_max(F.transform(x["spans"], lambda s: s["end"].cast("long")))

        def one(s: Column, before: Column) -> Column:
            begin = F.greatest(before, F.lit(0)).cast("int")
            return F.when(s["start"] >= begin, F.concat(piece(x["blocks"], begin, s["start"]), F.lit(mark))).otherwise("")

        end = F.array_max(F.transform(x["spans"], lambda s: s["end"]))
        return F.concat(F.array_join(F.zip_with(x["spans"], reach, one), ""), piece(x["blocks"], end, F.length(text)))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(F.struct(blocks.alias("blocks"), spans.alias("spans")), cut)).otherwise(text)


def redact(scanned: DataFrame, *, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """What `scan` gives, with secrets replaced and without the two span columns.  A null text stays null."""
    return scanned.withColumn(text, redacted(F.col(text), F.col("spans"), mark)).drop("base_spans", "spans")


def clean(docs: DataFrame, table: list[float] | None, *, text: str = "text", least: float = RATIO, mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """docs with secrets replaced, all columns kept; where a text has changed, the column `length` gets its new length."""
    named, back = set_aside(docs, "base_spans", "spans")
    found = scan(named, table, text=text, least=least)
    out = found.withColumn(text, redacted(F.col(text), F.col("spans"), mark))
    if length:
        out = out.withColumn(length, F.when(F.size("spans") > 0, F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return out.drop("base_spans", "spans").withColumnsRenamed(back).select(*(f"`{c}`" for c in docs.columns))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, train(samples(docs)))
    told = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(kind).alias(f"n_{kind}") for kind, *_ in PATTERNS), F.sha2(told("base_spans"), 256).alias("base_sha256"), told("spans").alias("spans"))
