"""As-of lags, overlaps, clustered facts, sketches, nested events and safe swaps on literal tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import coverage, mail, packs, quality, sketches, variants
from pulsegrid.sources import sinks
from pulsegrid.sources.layout import Clustered

START = dt.datetime(2024, 1, 1)


@pytest.mark.parametrize("hours", [1, 24, 10_000])
def test_next_view_against_all_pairs(spark, hours):
    rng = random.Random(hours)
    at = lambda: START + dt.timedelta(minutes=rng.randrange(0, 3000, 5))
    sends = [("hot" if rng.random() < 0.6 else rng.choice("abc"), at(), i) for i in range(200)] + [(None, START, 999), ("alone", START, 998)]
    views = [("hot" if rng.random() < 0.6 else rng.choice("abc"), at()) for _ in range(150)] + [("late", START)]
    got = packs.next_view(spark.createDataFrame(sends, "k string, at timestamp_ntz, n int"), spark.createDataFrame(views, "k string, at timestamp_ntz"), "k", hours)
    want = {n: min((v for j, v in views if j == k and v >= a), default=None) for k, a, n in sends}
    assert {r.n: r.next_at for r in got.collect()} == want and got.count() == len(sends)


def test_lag_window_and_sends_of_the_same_day(spark):
    h = lambda n: START + dt.timedelta(hours=n)
    t = {
        "mailings": spark.createDataFrame([("m1", "C-1-x"), ("m2", "C-2-x"), ("m3", None)], "mailing_id string, tracking_id string"),
        "receivers": spark.createDataFrame([("m1", h(10)), ("m1", h(10)), ("m1", h(1)), ("m2", h(0)), ("m3", h(0))], "mailing_id string, sent_at timestamp_ntz"),
        "page_views": spark.createDataFrame([("c-1-y", h(9)), ("c-1-y", h(12)), ("C-2-q", h(24 * 30 + 1)), (None, h(1))], "tracking_id string, ts timestamp_ntz"),
    }
    got = {r.mailing_id: (r.receivers, r.with_view, r.p50_hours, r.p99_hours) for r in packs.send_lags(t).collect()}
    assert got == {"m1": (3, 3, 2.0, 7.88), "m2": (1, 0, None, None), None: (4, 3, 2.0, 7.88)}
    assert {r.mailing_id for r in packs.send_lags(t, top=1).collect()} == {"m1", None}


def test_visits_by_session_windows(spark):
    m = lambda n: dt.datetime(2024, 1, 1, 23, 0) + dt.timedelta(minutes=n)
    rows = [("p", m(0), "c", 1, 1.5, False), ("p", m(29), "c", 1, None, True), ("p", m(70), "c", 1, 2.5, False), ("p", m(90), "c", 1, 3.0, False), ("p", m(0), "c", 2, 1.0, False), (None, m(0), "c", 2, 1.0, None)]
    got = coverage.interactions_fact(spark.createDataFrame(rows, "page_id string, ts timestamp_ntz, contact_id string, app int, duration double, is_comment boolean"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([("p", "20240101", "c", 1, 2, 1, 1.5, 1.5, 1), ("p", "20240102", "c", 1, 2, 1, 5.5, 2.75, 0), ("p", "20240101", "c", 2, 1, 1, 1.0, 1.0, 0), (None, "20240101", "c", 2, 1, 1, 1.0, 1.0, 0)], key=str)


def test_overlaps_against_all_pairs(spark):
    rng = random.Random(3)
    tables = {t: [(rng.randrange(a, b), rng.choice(["x", "y", None]), f"{t}{i}") for i in range(60)] for t, a, b in (("a", 0, 20), ("b", 10, 30), ("c", 100, 110), ("d", 0, 200))}
    frames = {t: spark.createDataFrame(r, f"k int, name string, {t}_id string") for t, r in tables.items()}
    got = {(r.column, r.table_1, r.table_2): r for r in quality.column_overlaps(frames).collect()}
    want = {}
    for i, c in enumerate(("k", "name")):
        for x in tables:
            for y in tables:
                p, q = ({r[i] for r in tables[t]} - {None} for t in (x, y))
                if x < y and p & q:
                    want[c, x, y] = (len(p), len(q), len(p & q), round(len(p & q) / len(p) * 100, 1), round(len(p & q) / len(q) * 100, 1))
    assert {k: (r.distinct_1, r.distinct_2, r.overlap, r.pct_1_in_2, r.pct_2_in_1) for k, r in got.items()} == want
    assert got["name", "a", "b"].relationship == "1:1"
    pairs = {(r.name, r.within) for r in quality.inclusions(frames, {t: ["k", "name"] for t in frames}).collect()}
    assert ("a.name", "b.name") in pairs and ("c.k", "a.k") not in pairs
    one = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(i,) for i in range(9)], "k int")
    assert quality.column_overlaps({"s": one[0], "l": one[1]}).first().relationship == "s N:1 l"
    assert quality.column_overlaps({"s": one[0].limit(0), "l": one[1]}).count() == 0


def test_a_third_of_null_keys(spark):
    left = spark.createDataFrame([(None if i % 3 == 0 else f"T{i % 5}", i) for i in range(90)], "key string, i int")
    right = spark.createDataFrame([("t1", "one"), ("T2", "two"), (None, "none")], "user_key string, town string")
    got = {r.i: r.town for r in mail.join_ci(left, right, "key", "user_key").collect()}
    assert len(got) == 90 and all(got[i] == ({1: "one", 2: "two"}.get(i % 5) if i % 3 else None) for i in range(90))
    t = {"receivers": left.select(F.col("key").alias("person_key"), F.col("i").cast("string").alias("receiver_id"), F.lit("m").alias("mailing_id"), F.lit(START).cast("timestamp_ntz").alias("sent_at")), "hr_employee": spark.createDataFrame([("T1", "u1"), ("T2", "u2"), ("T3", None)], "person_key string, org_unit string"), "hr_costcenter": spark.createDataFrame([("u1", "EMEA")], "org_unit string, region string"), "mailings": spark.createDataFrame([("m", START)], "mailing_id string, created_at timestamp_ntz")}
    assert tuple(mail.null_region(t).first()) == (2024, 90, 78, 30, 24, 12, 12)
    assert [(r.person_key, r.in_hr, r.org_unit, r.in_costcenter) for r in mail.null_region_persons(t).collect()] == [("T0", False, None, None), ("T2", True, "u2", False), ("T3", True, None, None), ("T4", False, None, None)]
    d = quality.duplicate_keys(left.withColumn("v", F.col("i")), "key", "v", keep=2)
    assert {r.key: (r.n, r.n_values, r["values"]) for r in d.collect()}[None] == (30, 30, "0,12")


def test_clustered_files_are_skipped_on_both_columns(spark, tmp_path):
    table = Clustered(str(tmp_path / "t"), "ts", ("a", "b"), 250)
    df = spark.range(8000).select((F.lit(START) + F.make_interval(hours=F.col("id") % 48)).cast("timestamp_ntz").alias("ts"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).cast("string"), 3, "0")).alias("b"), "id")
    table.write(df.union(df.limit(1).select("ts", F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(-1).cast("long"))))
    day = ("2024-01-01", "2024-01-01")
    everything = len(table.files(spark))
    assert everything >= 24
    for ranges, where in (({"days": day}, "ts < '2024-01-02'"), ({"a": (10, 40)}, "a BETWEEN 10 AND 40"), ({"b": ("k400", "k420")}, "b BETWEEN 'k400' AND 'k420'"), ({"days": day, "a": (0, 9), "b": ("k000", "k099")}, "ts < '2024-01-02' AND a <= 9 AND b < 'k1'"), ({"a": (5000, 6000)}, "a > 5000")):
        assert len(table.files(spark, **ranges)) <= everything * 0.6
        got = table.read(spark, **ranges)
        assert got.columns == df.columns and sorted(r.id for r in got.collect() if r.id >= 0) == sorted(r.id for r in df.filter(where).collect())
    with pytest.raises(ValueError):
        table.read(spark)
    with pytest.raises(ValueError):
        table.read(spark, c=(1, 2))


def test_sketches(spark):
    df = spark.range(30_000).select(F.expr("DATE'2024-01-01' + CAST(id % 40 AS INT)").alias("ts"), (F.col("id") % 7).alias("k"), F.pmod(F.xxhash64("id"), F.lit(9000)).alias("u"))
    stored = sketches.daily(df, ["k"], "ts", users="u")
    exact = df.groupBy("k").agg(F.count_distinct("u").alias("x"))
    assert all(r.ok for r in sketches.united(stored, ["k"], ["users"]).join(exact, "k").select(sketches.close("users", "x").alias("ok")).collect())
    assert sketches.united(stored, [], ["users"]).first().rows == 30_000
    assert 0 < sketches.tolerance() < 0.09


def test_nested_events(spark):
    rows = ['{"CustomProps":"{\\"q\\":{\\"text\\":\\"a\\",\\"n\\":1,\\"hits\\":[{\\"id\\":\\"x\\"},{\\"id\\":2}]}}","env":null}', '{"CustomProps":{"q":"plain","e":{},"l":[]}}', "broken{", None, "", "[1,true]", '{"t":"{not json"}']
    got = {r.path: (r.n, r.kinds, r.n_values, r["sample"]) for r in variants.path_inventory(spark.createDataFrame([(r,) for r in rows], "c string"), "c").collect()}
    assert got == {
        "$.CustomProps.e": (1, "object", 1, "{}"), "$.CustomProps.l": (1, "array", 1, "[]"), "$.CustomProps.q": (1, "string", 1, "plain"), "$.CustomProps.q.hits[].id": (2, "number,string", 2, "2"),
        "$.CustomProps.q.n": (1, "number", 1, "1"), "$.CustomProps.q.text": (1, "string", 1, "a"), "$.env": (1, "null", 1, "null"), "$[]": (2, "boolean,number", 2, "1"), "$.t": (1, "string", 1, "{not json"),
    }


def test_swaps_do_not_lose_tables(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.rebuild(spark.range(3), path)
    os.rename(path, f"{path}.before")  # a writer is in the middle of a swap
    assert not sinks.exists(spark, path) and sinks.current(spark, path) == f"{path}.before" and spark.read.parquet(sinks.current(spark, path)).count() == 3
    assert sinks.exists(spark, path, recover=True) and sinks.current(spark, path) == path
    real = sinks._rename

    def failing(s, a, b):
        if b == path and not a.endswith(".before"):
            raise OSError("no")
        real(s, a, b)

    with monkeypatch.context() as m:
        m.setattr(sinks, "_rename", failing)
        with pytest.raises(OSError):
            sinks.rebuild(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    sinks.rebuild(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9 and not os.path.exists(f"{path}.before")
