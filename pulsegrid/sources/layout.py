"""Facts clustered on two columns within day partitions, and read through an index of their files.

Within each day, rows are ordered by a key that interleaves the bits of both columns' ranks, so that a file covers a small
range of either one, and a filter on any of them needs few files.  The index has a row for each file: its day, and the least and
greatest value of both columns.  Reading takes the files that the filters can meet, and filters their rows; a filter on the day
or on a column is mandatory.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.sources import sinks

BITS = 8
DAY = "_day"


def _rank(c: str, cuts: list[Any]) -> Column:
    """How many of the cuts a value is above: its place among 2**BITS stretches of about as many rows; nulls are first."""
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < F.col(c))) if cuts else F.lit(0), F.lit(0))


def interleaved(a: Column, b: Column, bits: int = BITS) -> Column:
    """The bits of a and b in turn, the highest first."""
    out = F.lit(0)
    for i in range(bits):
        out = out + F.shiftleft(F.shiftright(a, i).bitwiseAND(1), 2 * i + 1) + F.shiftleft(F.shiftright(b, i).bitwiseAND(1), 2 * i)
    return out


def _cuts(df: DataFrame, cols: tuple[str, str]) -> list[list[Any]]:
    """About 2**BITS - 1 values of each column that cut a hash sample of its different values into like stretches."""
    n, out = 1 << BITS, []
    for c in cols:
        kept = df.select(c).filter(F.col(c).isNotNull()).distinct().orderBy(F.xxhash64(c)).limit(64 * n)  # a bounded sample: it only sets the order
        ranked = kept.select(c, F.ntile(n).over(Window.orderBy(c)).alias("t"))
        out.append([r.x for r in ranked.groupBy("t").agg(F.max(c).alias("x")).orderBy("t").collect()][:-1])
    return out


@dataclass(frozen=True)
class Clustered:
    """A clustered table: where it is, the timestamp or date whose day is the partition, the two columns, and rows of a file."""

    path: str
    time: str
    columns: tuple[str, str]
    file_rows: int = 1_000_000

    @property
    def _index(self) -> str:
        return f"{self.path}.index"

    def write(self, df: DataFrame) -> None:
        """Writes or replaces the table and its index."""
        cuts = _cuts(df, self.columns)
        a, b = (_rank(c, x) for c, x in zip(self.columns, cuts, strict=True))
        df = df.withColumns({DAY: F.to_date(self.time), "_z": interleaved(a, b)})
        files = max(1, -(-df.count() // self.file_rows))
        sorted_ = df.repartitionByRange(files, DAY, "_z", F.xxhash64(*self.columns)).sortWithinPartitions(DAY, "_z").drop("_z")
        sinks.rebuild_with(df.sparkSession, self.path, lambda at: sorted_.write.partitionBy(DAY).option("maxRecordsPerFile", self.file_rows).parquet(at))
        stored = df.sparkSession.read.parquet(self.path)
        ends = [f(c).alias(f"{n}_{i}") for i, c in enumerate(self.columns) for n, f in (("least", F.min), ("most", F.max))]
        found = stored.groupBy(F.col("_metadata.file_path").alias("file"), F.col(DAY).alias("day")).agg(F.count("*").alias("n"), *ends)
        sinks.rebuild(found, self._index)

    def files(self, spark: SparkSession, days: tuple[str, str] | None = None, **ranges: tuple[Any, Any]) -> list[str]:
        """The files that may hold rows of these days and ranges (ends included)."""
        index = spark.read.parquet(self._index)
        if days:
            index = index.filter(F.col("day").between(F.lit(days[0]).cast("date"), F.lit(days[1]).cast("date")))
        for c, (low, high) in ranges.items():
            i = self.columns.index(c)
            index = index.filter((F.col(f"most_{i}") >= F.lit(low)) & (F.col(f"least_{i}") <= F.lit(high)))
        return sorted(r.file for r in index.select("file").collect())  # names of files

    def read(self, spark: SparkSession, days: tuple[str, str] | None = None, **ranges: tuple[Any, Any]) -> DataFrame:
        """Rows of these days and ranges, from the files that may hold them; at least one filter must be given."""
        if not days and not ranges:
            raise ValueError(f"{self.path} is read by a range of days or of {' or '.join(self.columns)}, not as a whole")
        if unknown := set(ranges) - set(self.columns):
            raise ValueError(f"{self.path} is not clustered by {', '.join(sorted(unknown))}")
        schema = spark.read.parquet(self.path).schema
        files = self.files(spark, days, **ranges)
        df = spark.read.schema(schema).option("basePath", self.path).parquet(*files) if files else spark.createDataFrame([], schema)
        if days:
            df = df.filter(F.col(DAY).between(F.lit(days[0]).cast("date"), F.lit(days[1]).cast("date")))
        for c, (low, high) in ranges.items():
            df = df.filter(F.col(c).between(F.lit(low), F.lit(high)))
        return df.drop(DAY)
