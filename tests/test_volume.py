"""How much queries move: keys that many rows of a master share, files that steps leave behind, lookups that grow."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import mail, packs, quality
from pulsegrid.operators.incremental import MailStore
from pulsegrid.plans import model
from pulsegrid.sources.keyed import Keyed


def files(spark):
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {n.rsplit("/", 1)[-1] for n in names.split("\n") if "shuffle_" in n}


def moved(spark, df):
    """Rows that a query shuffles where no table is small enough to be broadcast."""
    sc = spark.sparkContext._jsc.sc()

    def total():
        sc.listenerBus().waitUntilEmpty()
        stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return {(x.stageId(), x.attemptId()): x.shuffleWriteRecords() for x in map(stages.apply, range(stages.size()))}

    before, key = total(), "spark.sql.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.set(key, threshold)
    return sum(n for at, n in total().items() if at not in before)


def test_keyed_steps_leave_no_shuffle_files(spark, tmp_path):
    """F1"""
    table, before = Keyed(str(tmp_path / "k"), ("k",), 4), files(spark)
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("n"))
    table.create(df.groupBy("k").agg(F.sum("n").alias("n")))
    table.merge(df.groupBy("k").agg(F.count("*").alias("n")).filter("k < 5"), ("k",))
    left = files(spark) - before
    assert len([n for n in left if n.endswith(".data")]) <= 4  # of the few numbers that are collected, not of what is written
    assert sorted((r.k, r.n) for r in table.read(spark).filter("k < 7").collect()) == [(k, 10 if k < 5 else 4500 + 10 * k) for k in range(7)]
    assert not (tmp_path / "k.updates").exists()


def test_changes_are_computed_once(spark, tmp_path):
    """each change of a store's hub is read by one step, which writes it for the others."""
    t = {n: model.table(spark, "/root/testdata/sf0.001", n) for n in ("mailings", "receivers", "engagement", "hr_employee", "hr_costcenter", "hr_user")}
    store, n = MailStore(str(tmp_path), 2), spark.sparkContext.accumulator(0)
    few = {name: t[name].filter("mailing_id in ('m1', 'm2')").localCheckpoint() for name in ("receivers", "engagement")}
    store.load({**t, **few})

    def counted(rows):
        for r in rows:
            n.add(1)
            yield r

    change = few["receivers"].withColumn("log_status", F.lit("Bounce"))
    store.apply(t, {"receivers": spark.createDataFrame(change.rdd.mapPartitions(counted), change.schema)})
    assert n.value == change.count() > 0
    assert store.gold(spark).filter("event = 'bounced'").agg(F.sum("n")).first()[0] == change.count()
    assert not [p.name for p in tmp_path.iterdir() if "staged" in p.name]


def test_updates_of_a_merge_are_computed_once(spark, tmp_path):
    """F10"""
    table, n = Keyed(str(tmp_path / "k"), ("k",), 4), spark.sparkContext.accumulator(0)
    table.create(spark.range(40).select((F.col("id") % 10).alias("k"), F.col("id").alias("n")))

    def counted(rows):
        for r in rows:
            n.add(1)
            yield r

    updates = spark.range(30, 60).select((F.col("id") % 10).alias("k"), F.col("id").alias("n"))
    table.merge(spark.createDataFrame(updates.rdd.mapPartitions(counted), updates.schema), ("k", "n"))
    assert n.value == 30
    assert sorted(r.n for r in table.read(spark).collect()) == list(range(60))


def test_engagement_moves_its_lines_once(spark):
    """the rows of its SQL, from one shuffle of the lines besides the join."""
    made = model.table(spark, "/root/testdata/sf0.001", "engagement")
    plain = model.SPARK.pop("engagement")
    try:
        sql = model.table(spark, "/root/testdata/sf0.001", "engagement")
    finally:
        model.SPARK["engagement"] = plain
    assert made.dtypes == sql.dtypes
    assert made.exceptAll(sql).isEmpty() and sql.exceptAll(made).isEmpty()
    made = model.table(spark, "/root/testdata/sf0.001", "engagement")
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def attribution(spark, mailings):
    m = spark.createDataFrame([(i, "CLU01-0000001-240101-0000001-EMI", d) for i, d in mailings], "mailing_id string, tracking_id string, d string").select("mailing_id", "tracking_id", F.to_date("d").alias("created_at"))
    v = spark.createDataFrame([("CLU01-0000001-240101-0000002-INT", at) for at in ("2024-01-01 12:00:00", "2024-02-01 00:00:00")], "tracking_id string, at string").select("tracking_id", F.col("at").cast("timestamp_ntz").alias("ts"))
    return packs.attribution_lag({"mailings": m, "page_views": v}, days=30)


def test_attribution_meets_views_without_a_row_for_each_day(spark):
    """mailings are not multiplied by the days of their window, which Spark's estimates of size do not see."""
    df = attribution(spark, [("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-01-01"), ("c", "2024-01-01"), ("d", "2024-02-02"), ("e", None)])
    r = df.first()
    assert (r.mailings, r.p50_hours) == (4, 12.0)  # a counts for each of its days, as in SQL
    assert r.p99_hours == round(12 + 0.97 * (30 * 24 - 12), 4)
    assert "Generate" not in df._jdf.queryExecution().executedPlan().toString()


def test_overlaps_read_tables_once(spark):
    """nothing runs before the result is asked for, and any number of tables is told apart."""
    jobs, n = spark.sparkContext.statusTracker(), 70
    ran = set(jobs.getJobIdsForGroup(None))
    tables = {f"t{i:02}": spark.range(i, i + 2).select(F.when(F.col("id") % 9 > 0, F.col("id")).alias("k")) for i in range(n)}
    df = quality.column_overlaps(tables)
    assert set(jobs.getJobIdsForGroup(None)) == ran
    value = lambda i: {k for k in (i, i + 1) if k % 9}
    want = {(f"t{i:02}", f"t{j:02}", len(value(i) & value(j))) for i in range(n) for j in range(i + 1, n) if value(i) & value(j)}
    assert {(r.table_1, r.table_2, r.overlap) for r in df.collect()} == want


def shared(spark, times):
    """Mail tables where each of 20 persons has `times` employees and users, some spelt otherwise."""
    r = spark.range(200).select(F.concat(F.lit("m"), F.col("id") % 10).alias("mailing_id"), F.concat(F.lit("r"), "id").alias("receiver_id"), F.when(F.col("id") % 19 > 0, F.concat(F.lit("t"), F.col("id") % 21)).alias("person_key"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 9 as int))").alias("sent_at"), F.when(F.col("id") % 7 > 0, "Sent").otherwise("Bounce").alias("log_status"))
    e = r.select("mailing_id", "receiver_id", "person_key", F.explode(F.array(F.lit("OPEN"), F.lit("CLICK"))).alias("link_type"), F.lit("agent").alias("agent"), F.lit(1).alias("is_active"), F.expr("sent_at + interval 30 hours").alias("event_at"))
    e = e.withColumn("id", F.concat("receiver_id", "link_type"))
    n = spark.range(20).select(F.concat(F.lit("t"), "id").alias("person_key"), F.explode(F.sequence(F.lit(1), F.lit(times))).alias("i"))
    employees = n.select(F.when(F.col("i") == 3, F.upper("person_key")).otherwise(F.col("person_key")).alias("person_key"), F.concat(F.lit("o"), F.col("i") % 8).alias("org_unit"))
    o = spark.range(7).select(F.concat(F.lit("o"), "id").alias("org_unit"), *(F.concat(F.lit(c), F.col("id") % 4).alias(c) for c in mail.ORG))
    users = n.filter("person_key <> 't4'").select(F.when(F.col("i") % 2 == 0, F.upper("person_key")).otherwise(F.col("person_key")).alias("user_key"), F.concat(F.lit("T"), F.col("i") % 3).alias("town"))
    m = spark.range(9).select(F.concat(F.lit("m"), "id").alias("mailing_id"), F.when(F.col("id") > 1, F.concat(F.lit("CLU-"), F.col("id") % 3)).alias("tracking_id"), F.lit("title").alias("title"))
    m = m.unionByName(m.filter("mailing_id = 'm5'"))
    views = spark.createDataFrame([], "ts timestamp_ntz")
    days = spark.createDataFrame([], "registered_on date")
    return {k: v.localCheckpoint() for k, v in {"receivers": r, "engagement": e, "hr_employee": employees, "hr_costcenter": o, "hr_user": users, "mailings": m, "page_views": views, "registrations": days}.items()}


WHO = "(SELECT person_key p, region, country, division, area FROM {hr_employee} LEFT JOIN {hr_costcenter} USING (org_unit))"
FACT = f"""(SELECT mailing_id, receiver_id, person_key, event, event_at, agent, tracking_id, region, division, town FROM
  (SELECT mailing_id, receiver_id, person_key, if(log_status = 'Bounce', 'bounced', 'sent') event, sent_at event_at, null agent FROM {{receivers}}
  UNION ALL SELECT mailing_id, receiver_id, person_key, if(link_type = 'OPEN', 'opened', 'clicked'), event_at, agent FROM {{engagement}})
  LEFT JOIN (SELECT mailing_id, tracking_id FROM {{mailings}}) USING (mailing_id) LEFT JOIN {WHO} ON p = person_key LEFT JOIN {{hr_user}} ON lower(user_key) = lower(person_key))"""
SPANS = f"(SELECT e.*, '72h' timespan, to_date(event_at) event_date, hour(event_at) event_hour, w.* FROM {{engagement}} e LEFT JOIN {WHO} w ON p = person_key)"
CASES = {
    "F11": (mail.fact_email, f"SELECT * FROM {FACT}"),
    "F5": (mail.gold_email_fact, f"SELECT mailing_id, tracking_id, person_key, event, date_trunc('hour', event_at) hour, region, division, count(*) n FROM {FACT} GROUP BY ALL"),
    "F7": (mail.gold_email_by_dim, f"SELECT tracking_id, region, division, event, count(*) n FROM {FACT} GROUP BY ALL"),
    "F9": (packs.dash_weekly, f"SELECT to_date(date_trunc('week', event_at)) week, event series, count(*) n FROM {FACT} GROUP BY ALL"),
    "F6": (mail.email_event_chain, f"SELECT person_key, mailing_id, receiver_id, tracking_id, title, sent_at, log_status, e.id event_row, link_type, e.agent, event_at, region, division FROM {{mailings}} JOIN {{receivers}} USING (mailing_id) LEFT JOIN (SELECT mailing_id, receiver_id, id, link_type, agent, event_at FROM {{engagement}}) e USING (mailing_id, receiver_id) LEFT JOIN {WHO} ON p = person_key"),
    "F8": (mail.timespan_rollups, " UNION ALL ".join(f"SELECT timespan, link_type, {', '.join(d if d in s else f'null {d}' for d in ('event_date', 'event_hour', 'division', 'area', 'region', 'country'))}, '{'_'.join(s)}' by, count(*) n, count(DISTINCT receiver_id) receivers FROM {SPANS} GROUP BY timespan, link_type, {', '.join(s)}" for s in mail.DIMENSIONS)),
}


@pytest.mark.parametrize("name", CASES)
def test_persons_that_many_rows_share(spark, name):
    """The rows of plain joins, while what is moved does not grow with the product of a key's employees and users."""
    make, sql = CASES[name]
    t = shared(spark, 12)
    got, want = make(t), spark.sql(sql, **t)
    rows = lambda df: Counter(tuple(r) for r in df.select(*got.columns).collect())
    assert rows(got) == rows(want)
    few, many = (moved(spark, make(shared(spark, n))) for n in (1, 120))
    assert many < 4 * few + 10_000, (few, many)
