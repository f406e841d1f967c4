"""Running folds over array columns, in SQL functions only, and columns that clash.

An array that grows inside `aggregate` is copied at every step, which is quadratic in its length.  A running
fold here goes by blocks: each block is folded on its own, then the blocks' totals, whose running values start the
blocks.  That is BLOCK / 2 copies an element, and one for each pair of blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64


def _before(values: Column, zero: Column, fold: Callable[[Column, Column], Column], kind: str) -> Column:
    """The fold of what is before each value; copies the result at each step."""
    start = F.struct(zero.alias("now"), F.array().cast(f"array<{kind}>").alias("out"))
    step = lambda acc, x: F.struct(fold(acc["now"], x).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out"))
    return F.aggregate(values, start, step, lambda acc: acc["out"])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once: inside lambdas Spark computes an expression wherever it stands."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, zero: Column, fold: Callable[[Column, Column], Column], kind: str = "long") -> Column:
    """For each value of an array, the fold (associative, from `zero`) of the values before it."""

    def of(v: Column) -> Column:
        n_blocks = F.ceil(F.size(v) / BLOCK).cast("int")
        blocks = F.transform(F.filter(F.sequence(F.lit(0), n_blocks), lambda b: b < n_blocks), lambda b: F.slice(v, b * BLOCK + 1, BLOCK))
        return let(F.transform(blocks, lambda x: F.struct(x.alias("values"), F.aggregate(x, zero, fold).alias("total"))), join)

    def join(blocks: Column) -> Column:
        begins = _before(F.transform(blocks, lambda b: b["total"]), zero, fold, kind)
        return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), begins.alias("begin")), lambda x: _before(x["b"]["values"], x["begin"], fold, kind)))

    return let(values, of)


def running_sum(values: Column) -> Column:
    return running(values, F.lit(0).cast("long"), lambda a, x: a + x)


def running_max(values: Column) -> Column:
    """-1 where nothing is before."""
    return running(values, F.lit(-1).cast("long"), lambda a, x: F.greatest(a, x))


CUT = 4096


def cut_out(text: Column, spans: Column) -> Column:
    """The stretches (start, end, in characters) of a text, as an array.  They are cut out of blocks of CUT characters, as
    Spark reads a text from its start to find a place in it."""

    def of(x: Column) -> Column:
        block = lambda k: F.coalesce(F.get(x["blocks"], k), F.lit(""))

        def piece(s: Column) -> Column:
            i, j = F.floor(s["start"] / CUT).cast("int"), F.floor(s["end"] / CUT).cast("int")
            begin, end = (s["start"] - i * CUT).cast("int"), (s["end"] - j * CUT).cast("int")
            whole = F.array_join(F.slice(x["blocks"], i + 2, F.greatest(j - i - 1, F.lit(0))), "")
            return F.when(i == j, F.substring(block(i), begin + 1, end - begin)).otherwise(F.concat(F.substring(block(i), begin + 1, F.lit(CUT)), whole, F.substring(block(j), F.lit(1), end)))

        return F.transform(x["spans"], piece)

    return let(F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)).alias("blocks"), spans.alias("spans")), of)


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """df with those columns that have one of the names (in any case) renamed, and how to rename them back."""
    taken, used, back = {n.lower() for n in names}, {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.lower() in taken:
            new = f"__{c}"
            while new.lower() in used | taken:
                new = f"_{new}"
            used.add(new.lower())
            back[new] = c
    return df.withColumnsRenamed({c: n for n, c in back.items()}), back
