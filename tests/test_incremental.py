"""Keyed tables, gold by change, exact percentiles and content hashes on small literal tables."""

import math
import os
import statistics

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.quantiles import exact_percentiles
from pulsegrid.sources import exports
from pulsegrid.sources.keyed import Keyed


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_touches_only_the_partitions_of_changes(spark, tmp_path):
    table = Keyed(str(tmp_path / "t"), ("k",), 16)
    table.create(spark.range(200).select((F.col("id") % 50).alias("k"), F.col("id").alias("n"), F.lit("old").alias("v")))
    before = files(table.path)
    updates = spark.createDataFrame([(3, 3, "new", 1), (3, 3, "newer", 2), (3, 3, "newest", 2), (3, 999, "added", 1), (3, 53, "x", 9)], "k long, n long, v string, seq int")
    parts = table.merge(updates, ("k", "n"), order=F.col("seq"), deleted=F.col("seq") == 9)
    assert len(parts) == 1
    after = files(table.path)
    same = {p for p in before if f"_part={parts[0]}/" not in p}
    assert {p: after.get(p) for p in same} == {p: before[p] for p in same} and len(same) > 5
    got = {(r.k, r.n): r.v for r in table.read(spark).collect()}
    assert len(got) == 200 and got[3, 3] == "newest" and got[3, 999] == "added" and (3, 53) not in got and got[3, 103] == "old"
    assert table.merge(updates.limit(0), ("k", "n")) == [] and len(files(table.path)) == len(after)


def test_null_keys_repeated_merges_and_emptied_partitions(spark, tmp_path):
    table = Keyed(str(tmp_path / "t"), ("k",), 4)
    kind = "k string, n int, v string"
    table.create(spark.createDataFrame([(None, 1, "a"), ("x", None, "b"), ("y", 2, "c")], kind))
    for _ in range(2):
        table.merge(spark.createDataFrame([(None, 1, "A"), ("x", None, None)], kind), ("k", "n"))
        assert rows(table.read(spark)) == rows(spark.createDataFrame([(None, 1, "A"), ("x", None, None), ("y", 2, "c")], kind))
    table.replace(spark.createDataFrame([("y",), ("x",)], "k string"), spark.createDataFrame([], kind))
    assert rows(table.read(spark)) == [(None, 1, "A")]
    assert rows(table.of(spark.createDataFrame([(None,)], "k string"))) == [(None, 1, "A")]


def test_tables_that_are_empty_or_become_so(spark, tmp_path):
    kind, some = "k string, n int, v string", [("x", 1, "a"), (None, 2, "b")]
    none, full = spark.createDataFrame([], kind), spark.createDataFrame(some, kind)
    table = Keyed(str(tmp_path / "t"), ("k",), 4)
    table.create(none)
    assert table.read(spark).columns == ["k", "n", "v"] and table.read(spark).isEmpty() and table.of(full).isEmpty()
    for _ in range(2):
        table.merge(full, ("k", "n"))
        assert rows(table.read(spark)) == sorted(some, key=str)
        table.merge(full, ("k", "n"), deleted=F.lit(True))
        assert table.read(spark).columns == ["k", "n", "v"] and table.read(spark).isEmpty()
    table.create(full.withColumn("more", F.lit(1)))
    assert table.read(spark).columns == ["k", "n", "v", "more"] and table.read(spark).count() == 2


def test_a_change_that_was_cut_short(spark, tmp_path, monkeypatch):
    table = Keyed(str(tmp_path / "t"), ("k",), 4)
    table.create(spark.range(20).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    change = spark.createDataFrame([(1, "new"), (2, "new")], "k long, v string")
    with monkeypatch.context() as m:
        m.setattr(Keyed, "_move_in", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(change, ("k",))
    assert {r.v for r in table.read(spark).collect()} == {"old"}
    table.recover(spark)
    assert sorted(r.k for r in table.read(spark).filter("v = 'new'").collect()) == [1, 2] and table.read(spark).count() == 20
    os.makedirs(tmp_path / "t.change/_part=1")  # one that was cut short while it was written
    table.merge(change.withColumn("v", F.lit("last")), ("k",))
    assert sorted(r.k for r in table.read(spark).filter("v = 'last'").collect()) == [1, 2] and table.read(spark).count() == 20


@pytest.mark.parametrize("few", [1, 3, 10_000])
def test_percentiles(spark, few):
    cases = ([], [5.0], [1.0, 2.0], [0.0] * 50 + [1.0] * 50, [float(i % 7) for i in range(101)], [0.0] * 40 + [0.1 * i for i in range(20)] + [9.0] * 40, [-1e300, 1e300, 0.5])
    for values in cases:
        df = spark.createDataFrame([(x,) for x in [*values, None]], "x double").repartition(3)
        got = exact_percentiles(df, "x", [0.0, 0.5, 0.9, 1.0], few)
        want = df.agg(F.percentile("x", [0.0, 0.5, 0.9, 1.0]).alias("p")).first().p or [None] * 4
        assert got == pytest.approx(want) if values else got == want
        if values:
            assert got[1] == pytest.approx(statistics.median(values))
    got = exact_percentiles(spark.createDataFrame([(1.0,), (math.nan,), (math.nan,)], "x double"), "x", [0.0, 0.5], few)
    assert got[0] == 1.0 and math.isnan(got[1])


def test_many_values_take_few_rounds(spark):
    df = spark.range(200_000).select(F.pmod(F.xxhash64("id"), F.lit(100_003)).cast("double").alias("x"))
    assert exact_percentiles(df, "x", [0.5, 0.99], 50) == df.agg(F.percentile("x", [0.5, 0.99]).alias("p")).first().p


@pytest.mark.parametrize("size", ["1k", "128m"])
def test_content_hashes_at_every_split(spark, tmp_path, size):
    texts = {"plain": "".join(f"line {i}\n" for i in range(3000))}
    lines = texts["plain"].splitlines(keepends=True)
    texts["exchanged"] = "".join([lines[2000], *lines[1:2000], lines[0], *lines[2001:]])
    texts["flipped"] = texts["plain"].replace("line 2345", "line 2344")
    texts["crlf"] = texts["plain"].replace("line 7\n", "line 7\r\n")
    texts["unended"] = texts["plain"][:-1]
    texts["again"], texts["empty"], texts["blank"], texts["blanks"] = texts["plain"], "", "\n", "\n\n"
    for name, text in texts.items():
        (tmp_path / f"{name} 1.csv").write_bytes(text.encode())
    (tmp_path / "latin 1.csv").write_bytes(b"\xff\xfe\n")
    (tmp_path / "latin2 1.csv").write_bytes(b"\xff\xfd\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = {r.file_name.split(" ")[0]: r.sha256 for r in exports.file_hashes(spark, str(tmp_path)).collect()}
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")
        again = {r.file_name.split(" ")[0]: r.sha256 for r in exports.file_hashes(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == again and set(got) == {*texts, "latin", "latin2"} - {"empty"}
    assert got["again"] == got["plain"] and len(set(got.values())) == len(got) - 1
