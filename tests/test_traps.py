"""Small literal cases for the rules that are easy to get wrong."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.functions import tracking as I
from pulsegrid.functions import values as V
from pulsegrid.operators import flatten, mail, measures, star
from pulsegrid.sources import sinks


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


def test_person_numbers(spark):
    cases = {"100200.0": "00100200", None: None, "": None, "nan": None, "None": None, "0": None, "00000000": None, "123456789": "123456789", " 42 ": "00000042"}
    for given, want in cases.items():
        assert one(spark, given, V.normalize_gpn("x")) == want


def test_properties(spark):
    cases = {
        '{"CustomProps":{"PageId":"p1"},"env":"a"}': {"cp_PageId": "p1", "env": "a"},
        '{"CustomProps":"{\\"PageId\\":\\"p1\\"}"}': {"cp_PageId": "p1"},
        '"{\\"CustomProps\\":{\\"PageId\\":\\"p1\\"}}"': {"cp_PageId": "p1"},
        '{"CustomProps":"broken{"}': {"cp_raw": "broken{"},
        "{broken": {}, "": {}, None: {}, '{"CustomProps":""}': {},
    }
    for given, want in cases.items():
        assert one(spark, given, flatten.parse_custom_dimensions("x")) == want, given


def test_tracking_ids(spark):
    full = "CLU01-0000002-240305-0000004-INT"
    df = spark.createDataFrame([(" ", full), (f" {full} ", None), ("A-B-C-D", None), ("A-B-C-D-E-F", None), ("nan", None), (None, None), ("A", None)], "a string, b string")
    got = [(r.tracking_id, r.cluster, r.channel, r.pack_id) for r in I.parse_tracking_id(df, "a", "b").collect()]
    assert got == [(full, "CLU01", "INT", "CLU01-0000002"), (full, "CLU01", "INT", "CLU01-0000002"), ("A-B-C-D", "A", None, "A-B"), ("A-B-C-D-E-F", "A", "E-F", "A-B"), (None, None, None, None), (None, None, None, None), ("A", "A", None, None)]
    assert one(spark, f" {full.lower()} ", I.pack_key("x")) == "CLU01-0000002"
    assert one(spark, None, I.pack_key("x")) is None and one(spark, None, I.pack_key_split_part("x")) is None
    assert one(spark, full, I.is_conformant("x")) and not one(spark, full.lower(), I.is_conformant("x"))


def test_local_time(spark):
    for given, want in {"2024-03-31 00:59:59": "2024-03-31 01:59:59", "2024-03-31 01:00:00": "2024-03-31 03:00:00", "no time": None}.items():
        got = one(spark, given, V.to_local_ts("x"))
        assert got == (want and dt.datetime.fromisoformat(want))


def test_small_values(spark):
    assert one(spark, 75.0, V.format_mmss("x"), "double") == "1:15" and one(spark, None, V.format_mmss("x"), "double") is None
    assert one(spark, "20250101", V.parse_date_key("x")) == dt.date(2025, 1, 1) and one(spark, "x", V.parse_date_key("x")) is None
    assert one(spark, None, V.final_device_type("x", F.lit(False))) == "unknown Only" and one(spark, "iPhone", V.final_device_type("x", F.lit(False))) == "mobile Only"


VIEW = "view_id string, session_id string, source_file string, ts timestamp_ntz, page_id string, user_id string, gpn string"


def views(spark, *rows):
    t0 = dt.datetime(2024, 1, 15, 10)
    return spark.createDataFrame([(v, s, f, t0 + dt.timedelta(seconds=x), p, "u", g) for v, s, f, x, p, g in rows], VIEW)


def test_time_on_page(spark):
    df = views(spark, ("a", "s", "f", 0, None, None), ("b", "s", "f", 1800, "p", None), ("c", "s", "f", 3601, "q", "1"), ("d", None, "f", 0, "p", None), ("e", None, "f", 9, "p", None), ("g", "s", "g", 3602, "p", None))
    got = {r.view_id: (r.time_on_page_s, r.is_last_in_session) for r in star.time_on_page(df).collect()}
    assert got == {"a": (1800.0, False), "b": (None, False), "c": (None, True), "d": (None, True), "e": (None, True), "g": (None, True)}
    assert {r.view_id: r.time_on_page_s for r in star.time_on_page(df, across_files=True).collect()}["c"] == 1.0


def test_sessions(spark):
    df = views(spark, ("a", "s", "f", 0, None, None), ("b", "s", "f", 0, "p", "7"), ("c", "s", "f", 10, "q", "8"), ("d", "one", "f", 0, "p", None), ("e", None, "f", 0, "p", None))
    got = {r.session_id: r for r in star.agg_session(star.time_on_page(df)).collect()}
    assert set(got) == {"s", "one"}
    s, b = got["s"], got["one"]
    assert (s.entry_page, s.exit_page, s.gpn, s.n_views, s.duration_s, s.engagement_s, s.is_bounce) == ("p", "q", "7", 3, 10.0, 10.0, False)
    assert (b.engagement_s, b.avg_time_on_page_s, b.is_bounce) == (0.0, None, True)


def test_hr_asof(spark):
    hr = spark.createDataFrame([("1", 2023, 12, None, "N1"), ("1", 2024, 2, "D2", "N2"), ("2", 2024, 3, "D3", "N3"), ("3", 2023, 1, "D0", "N0")], "gpn string, snapshot_year int, snapshot_month int, division string, country string")
    df = views(spark, ("a", "s", "f", 0, "p", "00000001"), ("b", "s", "f", 0, "p", "2.0"), ("c", "s", "f", 0, "p", "3"), ("d", "s", "f", 0, "p", "4"), ("e", "s", "f", 0, "p", None))
    got = {r.view_id: (r.hr_division, r.hr_country) for r in star.join_hr_asof(df, hr).collect()}
    assert got == {"a": ("D2", "N1"), "b": ("D3", "N3"), "c": ("D0", "N0"), "d": (None, None), "e": (None, None)}


def test_null_keys(spark):
    old = spark.createDataFrame([(None, "x"), ("a", "y")], "k string, v string")
    new = spark.createDataFrame([(None, "n"), ("a", "n"), ("b", "n"), ("b", "n")], "k string, v string")
    got = sorted((str(r.k), r.v) for r in sinks.append_new_keys(old, new, "k").collect())
    assert got == [("None", "x"), ("a", "y"), ("b", "n")]


def test_multi_device_per_mailing(spark):
    rows = [("m1", "t1", "A"), ("m1", "t1", "B"), ("m2", "t1", "A")]
    e = spark.createDataFrame([(m, p, a, "CLICK", 1) for m, p, a in rows], "mailing_id string, person_key string, agent string, link_type string, is_active int")
    assert [(r.mailing_id, r.agents) for r in mail.multi_device({"engagement": e}).collect()] == [("m1", "A & B")]
    assert [r.person_key for r in mail.multi_device({"engagement": e}, per_mailing=False).collect()] == ["t1"]


def test_period_gap(spark):
    df = spark.createDataFrame([(dt.datetime(2024, m, 1), "u") for m in (1, 1, 2, 4)], "ts timestamp_ntz, user_id string")
    got = {r.period.month: (r.views_before, r.views_change) for r in measures.period_change(df, "month").collect()}
    assert got == {1: (None, None), 2: (2, -0.5), 4: (None, None)}


def test_empty_tables(spark):
    df = views(spark)
    hr = spark.createDataFrame([], "gpn string, snapshot_year int, snapshot_month int, division string")
    fact = star.fact_page_view(df, hr)
    assert fact.count() == 0 and star.agg_session(fact).count() == 0 and star.dim_page(df).count() == 0 and star.dim_date(df).count() == 0


def test_tracking_ids_under_other_names(spark):
    rows = [('{"CustomProps":{"XyzTrackingID":" ","Xyz Tracking_ID":"C-2"}}', "C-2"), ('{"CustomProps":{"aTrackingID":"A-1","TrackingID":"T-1"}}', "T-1"), ('{"CustomProps":{"bTrackingID":"nan","aTrackingID":"B-1"}}', "B-1"), ('{"CustomProps":{"PageId":"p"}}', None), ('{"CustomProps":{"TrackingID":""}}', "")]
    raw = spark.createDataFrame([(str(i), "2024-01-05 10:00:00", r) for i, (r, _) in enumerate(rows)], ["id", "timestamp [UTC]", "customDimensions"])
    flat = flatten.flatten_page_views(raw, "2024-01-01", "2024-02-01")
    assert [r.cp_TrackingID for r in flat.orderBy("id").collect()] == [want for _, want in rows]
    clean = flatten.clean_page_views(flat)
    assert [r.tracking_id for r in clean.orderBy("view_id").collect()] == ["C-2", "T-1", "B-1", None, None]
    found = flatten.clean_page_views(flatten.flatten_props(raw.withColumn("props", flatten.parse_custom_dimensions("customDimensions")).drop("customDimensions")))
    assert {r.tracking_id for r in found.collect()} >= {"C-2", None}
