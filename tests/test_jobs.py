"""The batch pipeline, its sinks and the streaming load on files."""

import csv
import json
import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import flatten, star
from pulsegrid.plans import jobs
from pulsegrid.sources import exports, sinks
from pulsegrid.streaming import ingest

COLUMNS = ["timestamp [UTC]", "id", "name", "url", "session_Id", "user_Id", "customDimensions", "itemCount"]


def write(path, rows, more=()):
    with path.open("w", newline="") as f:
        w = csv.writer(f)
        w.writerow([*COLUMNS, *more])
        for at, i, session, page in rows:
            w.writerow([at, i, "pageView", f"https://x/{page}", session, "u1", json.dumps({"CustomProps": json.dumps({"PageId": page, "PageName": f'The "{page}"\nof all', "GPN": "7.0"})}), "1", *("m" for _ in more)])


def test_incremental_run(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write(source / "a.csv", [("2024-01-01 10:00:00.5", "v1", "s1", "p1"), ("2024-01-01 10:00:10", "v2", "s1", "p2")])
    write(source / "b.csv", [("2024-01-02 10:00:00", "v3", "s2", "p1")], more=("client_City",))
    hr = spark.createDataFrame([("7", 2023, 12, "D")], "gpn string, snapshot_year int, snapshot_month int, division string")
    t = jobs.run(spark, str(source), target, hr)
    fact = {r.view_id: r for r in t["fact_page_view"].collect()}
    assert set(fact) == {"v1", "v2", "v3"} and fact["v1"].time_on_page_s == 9.5 and fact["v1"].hr_division == "D" and fact["v1"].gpn == "00000007"
    assert {r.page_id: r.page_name for r in t["dim_page"].collect()}["p1"] == 'The "p1"\nof all'
    assert t["agg_session"].count() == 2 and t["dim_date"].count() == 2 and t["processed_files"].count() == 2
    write(source / "b.csv", [("2024-01-03 10:00:00", "v4", "s2", "p3")])
    for _ in range(2):  # a second run changes nothing
        t = jobs.run(spark, str(source), target, hr)
        assert {r.view_id for r in t["fact_page_view"].collect()} == {"v1", "v2", "v4"}
        assert t["dim_date"].count() == 3 and {r.page_id for r in t["dim_page"].collect()} == {"p1", "p2", "p3"}
        assert {r.file_name: r.row_count for r in t["processed_files"].collect()} == {"a.csv": 2, "b.csv": 1}
    t = jobs.run(spark, str(source), target, hr, full_refresh=True)
    assert t["dim_date"].count() == 2 and {r.view_id for r in t["fact_page_view"].collect()} == {"v1", "v2", "v4"}


def test_files_that_become_empty_and_runs_cut_short(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    write(source / "a=1.csv", [("2024-01-01 10:00:00", "v1", "s1", "p1")])
    write(source / "b.csv", [("2024-01-02 10:00:00", "v2", "s2", "p2")])
    jobs.run(spark, str(source), target)
    write(source / "a=1.csv", [])
    with monkeypatch.context() as m:
        m.setattr(jobs.star, "agg_session", lambda *a, **b: 1 / 0)
        try:
            jobs.run(spark, str(source), target)
        except ZeroDivisionError:
            pass
    t = jobs.run(spark, str(source), target)
    assert [r.view_id for r in t["fact_page_view"].collect()] == ["v2"] and [r.session_id for r in t["agg_session"].collect()] == ["s2"]
    assert {r.file_name: r.row_count for r in t["processed_files"].collect()} == {"a=1.csv": 0, "b.csv": 1}
    (tmp_path / "out/dim_page").rename(tmp_path / "out/dim_page.before")  # a swap that was cut short
    write(source / "b.csv", [("2024-01-02 10:00:00", "v3", "s2", "p3")])
    assert {r.page_id for r in jobs.run(spark, str(source), target)["dim_page"].collect()} == {"p1", "p2", "p3"}
    one = jobs.run(spark, str(source / "b.csv"), str(tmp_path / "one"))
    assert [r.view_id for r in one["fact_page_view"].collect()] == ["v3"]


def test_earlier_files_first(spark, tmp_path):
    for name, page, at in (("z.csv", "old name", 1_700_000_000), ("a.csv", "new name", 1_700_000_100)):
        with (tmp_path / name).open("w", newline="") as f:
            w = csv.writer(f)
            w.writerow([*COLUMNS, *(["client_City"] if name == "a.csv" else [])])
            w.writerow(["2024-01-01 10:00:00", "v" + name, "pageView", "u", "s", "u1", json.dumps({"CustomProps": {"PageId": "p", "PageName": page, "TargetRegion": "EMEA", "targetorganisation": "Org"}}), "1", *(["x"] if name == "a.csv" else [])])
        os.utime(tmp_path / name, (at, at))
    raw = exports.read_page_view_export(spark, *(str(tmp_path / n) for n in ("a.csv", "z.csv")))
    assert raw.filter("client_City = 'x'").count() == 1
    page = jobs.build(raw)[1].first()
    assert (page.page_name, page.target_region, page.target_org) == ("old name", "EMEA", "Org")


def test_raw_names(spark, tmp_path):
    raw = ["gcrs_division_desc", "gcrs_unit_desc", "gcrs_area_desc", "gcrs_sector_desc", "gcrs_segment_desc", "work_location_country", "work_location_region", "job_title", "management_level"]
    spark.createDataFrame([("1", 2024, 1, *"abcdefghi")], ["gpn", "snapshot_year", "snapshot_month", *raw]).write.parquet(str(tmp_path / "hr"))
    hr = exports.read_hr_history(spark, str(tmp_path / "hr"))
    view = spark.createDataFrame([("v1", "1.0", "2024-01-05 10:00:00")], "view_id string, gpn string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = star.join_hr_asof(view, hr).first()
    assert [got[f"hr_{n}"] for n in ("division", "unit", "area", "sector", "segment", "country", "region", "job_title", "management_level")] == list("abcdefghi")
    noise = "appId iKey sdkVersion itemCount itemType operation_Id operation_ParentId operation_Name client_IP client_Type client_Model performanceBucket name url client_City client_StateOrProvince cp_NewsCategory".split()
    df = spark.createDataFrame([("2024-01-01 10:00:00", "v1", "tr", *noise)], ["timestamp [UTC]", "id", "cp_TargetRegion", *noise])
    assert flatten.clean_page_views(df).columns == ["timestamp", "view_id", "target_region"]


def test_file_status(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    known = exports.file_hashes(spark, str(tmp_path)).select("file_name", "sha256").collect()
    manifest = spark.createDataFrame(known)
    (tmp_path / "a.csv").write_text("x\n2\n")
    (tmp_path / "b.csv").write_text("x\n1\n")
    got = {r.file_name: r.status for r in exports.classify_input_files(exports.file_hashes(spark, str(tmp_path)), manifest).collect()}
    assert got == {"a.csv": "changed", "b.csv": "new"}


def test_streaming_load(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "a.csv", [("2024-01-01 10:00:00", "v1", "s1", "p1"), ("2024-01-01 10:00:10", "v2", "s1", "p2")])
    schema = ", ".join(f"`{c}` string" for c in COLUMNS)
    for extra in ("b", "c"):
        q = ingest.ingest(ingest.stream_exports(spark, str(source), schema), str(tmp_path / "out"), str(tmp_path / "mark"))
        q.awaitTermination(120)
        write(source / f"{extra}.csv", [("2024-01-02 10:00:00", f"v{extra}", "s2", "p1")])
    assert {r.view_id for r in spark.read.parquet(str(tmp_path / "out/fact_page_view")).collect()} == {"v1", "v2", "vb"}


def test_windowed_counts(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01 10:05:00", "s", "u1"), ("2024-01-01 10:45:00", "s", "u2"), ("2024-01-01 11:01:00", "s", "u1")], "timestamp string, site_id string, user_id string")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = ingest.views_per_window(stream).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.views for r in spark.table("windows").collect()) == [1, 2]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "column string, samples string")
    sinks.write_profile({"t": df}, str(tmp_path))
    assert spark.read.json(str(tmp_path / "t")).columns == ["column"]
    sinks.snapshot_replace(df, str(tmp_path / "s"))
    sinks.append(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 6
    sinks.snapshot_replace(df.limit(1), str(tmp_path / "s"))
    assert exports.load_table(spark, str(tmp_path), "s", ["column"], "column = 'a'").count() == 1
    assert exports.load_table(spark, str(tmp_path), "s", whole=True).count() == 1
    with pytest.raises(ValueError):
        exports.load_table(spark, str(tmp_path), "s")
    sinks.export_dashboard({"packs": df}, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d/packs")).count() == 3


def test_job_keeps_tracking_ids_of_prefixed_names(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    with (source / "a.csv").open("w", newline="") as f:
        w = csv.writer(f)
        w.writerow(COLUMNS)
        for i, props in enumerate(({"AbcTrackingID": "CLU01-0000007-240101-0000001-IAN"}, {"AbcTrackingID": "", "AbdTrackingID": "CLU02-0000008-240101-0000001-ITS"})):
            w.writerow([f"2024-01-01 10:00:0{i}", f"v{i}", "pageView", "u", "s", "u1", json.dumps({"CustomProps": json.dumps({"PageId": "p", **props})}), "1"])
    fact = jobs.run(spark, str(source), str(tmp_path / "out"))["fact_page_view"]
    assert {r.view_id: r.pack_id for r in fact.collect()} == {"v0": "CLU01-0000007", "v1": "CLU02-0000008"}


def test_files_without_line_breaks_in_cells_are_split(spark, tmp_path):
    body = "".join(f'v{i},"a ""quoted"" cell, {i}"\n' for i in range(3000))
    (tmp_path / "split.csv").write_text("id,text\n" + body)
    (tmp_path / "whole.csv").write_text("id,text\n" + body + 'w,"two\nlines"\n')
    files = {r.path: r.splittable for r in exports.file_hashes(spark, str(tmp_path)).collect()}
    assert {p.rsplit("/", 1)[1]: yes for p, yes in files.items()} == {"split.csv": True, "whole.csv": False}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        df = exports.read_page_view_export(spark, *files, splittable={p for p, yes in files.items() if yes})
        got = df.withColumn("task", F.spark_partition_id()).groupBy("source_file").agg(F.count("*").alias("n"), F.count_distinct("id", "text").alias("d"), F.count_distinct("task").alias("tasks")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.source_file: r for r in got}
    assert (got["split.csv"].n, got["split.csv"].d, got["whole.csv"].n, got["whole.csv"].d, got["whole.csv"].tasks) == (3000, 3000, 3001, 3001, 1) and got["split.csv"].tasks > 3
