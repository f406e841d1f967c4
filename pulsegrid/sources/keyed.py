"""Tables kept in hash partitions of some of their key's columns, merged by touching only the partitions that changes fall into.

A keyed table is a Parquet folder with a partition column `_part`, the hash of the columns `by` modulo `parts`.  A
change names groups (values of `by`, or of more columns) and gives the rows that take the place of these groups' rows.  Only the
partitions of these groups are read and replaced; all other files stay as they are.

A change is first written beside the table (`<path>.change`), whole or not at all, and then moved in by a dynamic
partition overwrite.  Both steps can be repeated: a run that is cut short in the second is finished by the next
`replace`, `merge` or `recover`, and one that is cut short in the first leaves the table as it was.  One writer at a time.
The columns are kept beside the table (`<path>.schema`), so that a table may be empty, from the start or after a change.

Nulls in `by` or in the key are values like others: they match each other.  Keys that many rows share lie in one
partition each; within it, rows are dealt out by all their columns, so that no task writes a hot key alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrid.sources.sinks import _fs, shuffles_dropped, staged

PART = "_part"


def _matches(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A semi or anti join by equal or null values, also of the partition."""
    r = right.select(*(F.col(c).alias(f"__{c}") for c in on)).distinct()
    condition = F.lit(True)
    for c in on:
        condition &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(r, condition, how)


@dataclass(frozen=True)
class Keyed:
    """A keyed table: where it is, the columns whose hash is the partition, the number of partitions, and about how many
    files a partition is written in."""

    path: str
    by: tuple[str, ...]
    parts: int = 64
    files: int = 1

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, F.pmod(F.xxhash64(*self.by), F.lit(self.parts)).cast("int"))

    def _dealt(self, df: DataFrame, parts: int) -> DataFrame:
        by = [PART] if self.files == 1 else [PART, F.pmod(F.xxhash64(*(c for c in df.columns if c != PART)), F.lit(self.files))]
        return df.repartition(max(1, parts * self.files), *by)

    @property
    def _change(self) -> str:
        return f"{self.path}.change"

    def _schema(self, spark: SparkSession) -> StructType:
        """The stored columns, the partition last; of a table without a folder of its columns, what its files say."""
        kept = f"{self.path}.schema"
        fs, p = _fs(spark, f"{kept}/_SUCCESS")
        return spark.read.parquet(kept if fs.exists(p) else self.path).schema

    def _stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self._schema(spark)).parquet(self.path)

    def create(self, df: DataFrame) -> None:
        """Writes a new table, or replaces one as a whole."""
        self.recover(df.sparkSession)
        placed = self._placed(df)
        placed.limit(0).write.mode("overwrite").parquet(f"{self.path}.schema")
        with shuffles_dropped(df.sparkSession):
            self._dealt(placed, self.parts).write.partitionBy(PART).mode("overwrite").parquet(self.path)

    def read(self, spark: SparkSession, parts: list[int] | None = None) -> DataFrame:
        """The table, or some of its partitions."""
        df = self._stored(spark)
        return (df if parts is None else df.filter(F.col(PART).isin(parts))).drop(PART)

    def touched(self, groups: DataFrame) -> list[int]:
        """The partitions of these groups: at most `parts` numbers."""
        return sorted(r[PART] for r in self._placed(groups.select(*self.by)).select(PART).distinct().collect())

    def of(self, groups: DataFrame) -> DataFrame:
        """The stored rows of these groups (values of `by`), from their partitions only."""
        return _matches(self.read(groups.sparkSession, self.touched(groups)), groups, list(self.by), "left_semi")

    def recover(self, spark: SparkSession) -> None:
        """Finishes a change that is whole, and clears away one that is not."""
        fs, change = _fs(spark, self._change)
        if fs.exists(change):
            if fs.exists(_fs(spark, f"{self._change}/_SUCCESS")[1]):
                self._move_in(spark)
            else:
                fs.delete(change, True)

    def _move_in(self, spark: SparkSession) -> None:
        fs, change = _fs(spark, self._change)
        done = [s.getPath().getName() for s in fs.listStatus(change)]
        parts = [int(n.split("=")[1]) for n in done if n.startswith(f"{PART}=")]
        if parts:
            moved = spark.read.schema(self._schema(spark)).parquet(self._change)
            with shuffles_dropped(spark):
                self._dealt(moved, len(parts)).write.partitionBy(PART).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path)
        for n in done:  # partitions that have no rows any more
            if n.startswith("gone="):
                target, p = _fs(spark, f"{self.path}/{PART}={n.split('=')[1]}")
                target.delete(p, True)
        fs.delete(change, True)

    def replace(self, groups: DataFrame, rows: DataFrame, on: tuple[str, ...] | None = None) -> list[int]:
        """Puts `rows` in the place of all rows of `groups` (by the columns `on`, which include `by`); rows belong to these
        groups.  Gives the partitions that were replaced."""
        spark, on = groups.sparkSession, list(on or self.by)
        self.recover(spark)
        parts = self.touched(groups)
        if not parts:
            return parts
        stored = self._stored(spark)
        old = _matches(stored.filter(F.col(PART).isin(parts)), self._placed(groups.select(*on)), [PART, *on], "left_anti")
        new = self._placed(rows.select(*(c for c in stored.columns if c != PART))).select(*stored.columns)
        with shuffles_dropped(spark):
            self._dealt(old.unionByName(new), len(parts)).write.partitionBy(PART).parquet(self._change)
        fs, change = _fs(spark, self._change)
        there = {s.getPath().getName() for s in fs.listStatus(change)}
        for p in parts:
            if f"{PART}={p}" not in there:
                fs.mkdirs(_fs(spark, f"{self._change}/gone={p}")[1])
        self._move_in(spark)
        return parts

    def merge(self, updates: DataFrame, key: tuple[str, ...], order: Column | None = None, deleted: Column | None = None) -> list[int]:
        """MERGE: rows with a key that is stored are replaced, others are added; where `deleted` holds, the stored row goes.
        Of several updates of one key the last by `order` counts, then the greatest by all columns (the key has all of `by`).
        Gives the partitions that were replaced.  The last updates are written beside the table (`<path>.updates`) while they are used."""
        flag = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
        stored = [c for c in self.read(updates.sparkSession).columns]
        ranked = updates.withColumns({"__gone": flag, "__order": order if order is not None else F.lit(0)})
        last = Window.partitionBy(*key).orderBy(F.desc("__order"), *(F.desc_nulls_last(c) for c in stored), F.desc("__gone"))
        ranked = ranked.withColumn("__r", F.row_number().over(last)).filter("__r = 1").select(*stored, "__gone")
        with staged(ranked, f"{self.path}.updates") as ranked:
            return self.replace(ranked.select(*key), ranked.filter("NOT __gone").select(*stored), key)
