"""The model tables (mailings, receivers, pages, views, ...) derived from the given Parquet tables.

Each is one SQL text in functions that Spark and DuckDB share; the few that differ are named in DIALECTS.
`table` gives a DataFrame, `cte` the WITH clause for an oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")

DIALECTS = {
    "spark": {"daykey": "date_format({0}, 'yyyyMMdd')", "plus_hours": "timestampadd(HOUR, cast({1} as int), {0})", "ntz": "cast({0} as timestamp_ntz)"},
    "duckdb": {"daykey": "strftime({0}, '%Y%m%d')", "plus_hours": "({0} + to_hours(cast({1} as int)))", "ntz": "cast({0} as timestamp)"},
}


def _lp(x: str, n: int) -> str:
    return f"lpad(cast({x} as string), {n}, '0')"


def tid(n: str, p: str, channel: str) -> str:
    return f"concat('CLU0', ({p}) % 5, '-', {_lp(p, 7)}, '-24', {_lp(f'1 + ({n}) % 12', 2)}, {_lp(f'1 + ({n}) % 28', 2)}, '-', {_lp(n, 7)}, '-', {channel})"


_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
_SITE_NAMES = ("News and events", "Projects", "People", "Services", "Archive")

# name: (tables it reads, SQL); <f:a;b> calls a function of the dialect
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "sites": ((), " union all ".join(f"select 's{i}' as site_id, '{n}' as site_name, 'https://intra.example.org/s{i}' as site_url" for i, n in enumerate(_SITE_NAMES))),
    "page_inventory": (
        ("pages",),
        f"""select concat('p', page_id) as page_id,
          case when page_id % 4 = 0 then {tid("page_id", "5 + page_id % 20", "case cast(floor(page_id / 4) as int) % 7 when 0 then 'IAN' when 4 then 'IAN' when 1 then 'ITS' when 5 then 'ITS' when 2 then 'OPN' when 3 then 'ANC' else 'INT' end")} end as tracking_id,
          case when page_id % 5 = 4 and page_id % 4 <> 0 then null else date '2024-06-01' + cast((page_id * 7) % 700 as int) end as article_date,
          url, concat('Title ', page_id) as title,
          case when page_id % 4 = 0 and page_id % 20 <> 0 then 's0' else concat('s', page_id % 5) end as site_id,
          case when page_id % 6 = 5 then null else concat('type', page_id % 3) end as page_type
        from pages""",
    ),
    "metrics": (
        ("events",),
        f"""select concat('p', {_K} % 50) as page_id, <daykey:ts> as day_key, concat('c', user_id) as contact_id, event_id % 2 + 1 as app,
          count(*) as views, count(distinct date_trunc('hour', ts)) as visits, cast(sum(cast(value as decimal(18, 2))) as double) as duration_sum,
          cast(sum(cast(value as decimal(18, 2))) as double) / count(*) as duration_avg, sum(case when event_type = 'purchase' then 1 else 0 end) as comments
        from events group by 1, 2, 3, 4""",
    ),
    "page_views": (
        ("events",),
        f"""select concat('v', event_id) as view_id, ts, concat('u', user_id) as user_id,
          case when event_id % 97 <> 0 then concat('s', user_id, '-', <daykey:ts>) end as session_id,
          concat('p', {_K} % 50) as page_id, case when user_id % 20 <> 0 then {_lp("user_id", 8)} end as gpn,
          case when event_id % 5 <> 0 then {tid(_K + " % 50", "5 + (" + _K + " % 50) % 20", "'INT'")} end as tracking_id,
          case when day(ts) <= 15 then 'export_a.csv' else 'export_b.csv' end as source_file,
          concat('https://intra.example.org/s', {_K} % 5, '/p', {_K} % 50) as url, concat('s', {_K} % 5) as site_id, concat('Site ', {_K} % 5) as site_name,
          concat('theme', {_K} % 6) as theme, concat('type', {_K} % 3) as content_type, concat('Title ', {_K} % 50) as page_name, value as load_ms
        from events""",
    ),
    "custom_events": (
        ("events",),
        f"""select concat('e', event_id) as event_id, ts, concat('u', user_id) as user_id, concat('s', user_id, '-', <daykey:ts>) as session_id,
          case event_type when 'click' then 'click_event' when 'error' then 'SEARCH_TRIGGERED' when 'purchase' then 'SEARCH_RESULT_CLICK' else 'video_event' end as name,
          concat('L', {_K} % 4) as link_type, concat('C', {_K} % 7) as component, concat('p', {_K} % 50) as page_id,
          case when user_id % 20 <> 0 then {_lp("user_id", 8)} end as gpn, concat('u', user_id, '@example.org') as email
        from events""",
    ),
    "hr_employee": (("customer",), f"select concat('t', {_lp('c_custkey', 6)}) as person_key, {_lp('c_custkey', 8)} as gpn, concat('OU-', c_nationkey) as org_unit from customer"),
    "hr_names": (("customer",), f"select concat('t', {_lp('c_custkey', 6)}) as person_key, c_name as full_name from customer"),
    "hr_costcenter": (
        ("nation", "region"),
        "select concat('OU-', n_nationkey) as org_unit, r_name as region, n_name as country, concat('D', n_nationkey % 4) as division, concat('A', n_nationkey % 8) as area from nation join region on n_regionkey = r_regionkey where n_nationkey % 6 <> 5",
    ),
    "hr_user": (("customer",), f"select concat('T', {_lp('c_custkey', 6)}) as user_key, concat('T', c_nationkey % 9) as town from customer where c_custkey % 10 <> 0"),
    "hr_history": (
        ("customer",),
        f"""select {_lp("c_custkey", 8)} as gpn, cast(floor(ym / 100) as int) as snapshot_year, cast(ym % 100 as int) as snapshot_month,
          case when ym = 202312 and c_custkey % 5 = 0 then null else concat(c_mktsegment, '-', ym) end as division, concat('N', c_nationkey) as country
        from customer cross join (select 202311 as ym union all select 202312 union all select 202402) m
        where c_custkey % 11 <> 10 and (c_custkey % 3 = 0 and ym = 202402 or c_custkey % 3 = 1 or c_custkey % 3 = 2 and ym = 202312)""",
    ),
    "mailings": (
        ("part",),
        f"""select concat('m', p_partkey) as mailing_id, case when p_partkey % 3 = 0 then {tid("p_partkey", "p_partkey % 20", "case when p_partkey % 9 = 0 then 'NLI' else 'EMI' end")} end as tracking_id,
          p_name as title, concat('t', {_lp("p_size", 6)}) as created_by, date '2024-07-01' + cast((p_partkey * 3) % 600 as int) as created_at,
          concat('ev', p_partkey % 30) as event_id
        from part""",
    ),
    "receivers": (
        ("lineitem", "orders"),
        f"""select concat('r', l_partkey, '-', o_custkey) as receiver_id, concat('m', l_partkey) as mailing_id, concat('t', {_lp("o_custkey", 6)}) as person_key,
          min(l_shipdate) as sent_at, case min(l_returnflag) when 'A' then 'Open' when 'N' then 'Sent' else 'Bounce' end as log_status,
          case o_custkey % 3 when 0 then 'DE' when 1 then 'EN' else 'FR' end as language, 1 as is_active
        from lineitem join orders on l_orderkey = o_orderkey group by l_partkey, o_custkey""",
    ),
    "engagement": (
        ("lineitem", "orders", "receivers"),
        f"""select g.kind as link_type, concat('g', l_partkey, '-', o_custkey, '-', l_linenumber, '-', g.n) as id, r.mailing_id, r.receiver_id, r.person_key,
          case when g.n = 2 or g.n = 0 and l_linenumber % 2 = 1 then 'iPhone Mobile Safari' else 'Windows Desktop Edge' end as agent, r.language,
          case when d = 0 then 0 else 1 end as is_active, <plus_hours:r.sent_at;7 * l_linenumber + case when g.n > 0 then 1 else 0 end> as event_at, l_linenumber % 4 as link_no
        from (select l_partkey, o_custkey, l_linenumber, max(l_quantity) as q, min(l_discount) as d from lineitem join orders on l_orderkey = o_orderkey group by l_partkey, o_custkey, l_linenumber) e
        join receivers r on r.receiver_id = concat('r', l_partkey, '-', o_custkey)
        join (select 0 as n, 'OPEN' as kind, 20 as floor_q union all select 1, 'CLICK', 35 union all select 2, 'CLICK', 45) g on e.q > g.floor_q""",
    ),
    "template_links": (("part",), "select concat('l', p_partkey, '-', i) as link_id, concat('m', p_partkey) as mailing_id, concat('v', i) as value_id, concat('u', p_partkey, '-', i) as url, concat('Label ', i) as label, i as link_no from part cross join (select 0 as i union all select 1 union all select 2) n"),
    "element_values": ((), "select concat('v', i) as value_id, concat('el', i) as element_id, concat('key', i) as key_name from (select 0 as i union all select 1 union all select 2) n"),
    "elements": ((), "select concat('el', i) as element_id, concat('co', i % 2) as component_id, i as element_order from (select 0 as i union all select 1 union all select 2) n"),
    "components": ((), "select concat('co', i) as component_id, concat('Component ', i) as component_name from (select 0 as i union all select 1) n"),
    "event_master": (("nation",), f"select concat('ev', n_nationkey) as event_id, {tid('n_nationkey', 'n_nationkey', chr(39) + 'EVT' + chr(39))} as tracking_id, n_name as title, case when n_nationkey % 8 = 7 then date '2124-01-01' else date '2024-01-10' + cast(20 * n_nationkey as int) end as event_date, concat('t', {_lp('n_nationkey', 6)}) as created_by from nation"),
    "registrations": (("orders",), f"select concat('ev', o_orderkey % 25) as event_id, concat('t', {_lp('o_custkey', 6)}) as person_key, case o_orderstatus when 'O' then 'registered' when 'F' then 'attended' else 'no_show' end as status, cast(o_orderdate as date) as registered_on from orders"),
    "plan_clusters": (("region",), "select concat('CLU0', r_regionkey) as cluster_id, r_name as cluster_name from region"),
    "plan_packs": (("nation",), f"select concat('CLU0', (n_nationkey + 3) % 5, '-', {_lp('n_nationkey + 3', 7)}) as pack_id, concat('CLU0', n_regionkey) as cluster_id, n_name as pack_name, concat('theme', n_nationkey % 6) as theme, concat('R', n_regionkey) as target_region from nation"),
    "plan_activities": (("nation",), f"select {tid('n_nationkey', 'n_nationkey + 3', 'c.channel')} as tracking_id, concat('CLU0', (n_nationkey + 3) % 5, '-', {_lp('n_nationkey + 3', 7)}) as pack_id, date '2024-03-01' + cast(n_nationkey * 3 as int) as publish_date from nation cross join (select 'EMI' as channel union all select 'INT' union all select 'EVT') c"),
}

#: How Spark makes a table of which the text above would shuffle its inputs several times; the rows are the same.
SPARK: dict[str, tuple[tuple[str, ...], str]] = {
    "engagement": (
        ("lineitem", "orders"),
        f"""with x as (select l_partkey as p, o_custkey as c, l_linenumber as n, l_quantity, l_discount, l_shipdate from lineitem join orders on l_orderkey = o_orderkey where l_partkey is not null and o_custkey is not null distribute by p, c),
        e as (select p, c, n, max(l_quantity) as q, min(l_discount) as d, min(l_shipdate) as s from x group by p, c, n),
        r as (select *, min(s) over (partition by p, c) as sent_at from e)
        select g.kind as link_type, concat('g', p, '-', c, '-', r.n, '-', g.n) as id, concat('m', p) as mailing_id, concat('r', p, '-', c) as receiver_id, concat('t', {_lp("c", 6)}) as person_key,
          case when g.n = 2 or g.n = 0 and r.n % 2 = 1 then 'iPhone Mobile Safari' else 'Windows Desktop Edge' end as agent, case c % 3 when 0 then 'DE' when 1 then 'EN' else 'FR' end as language,
          case when d = 0 then 0 else 1 end as is_active, <plus_hours:r.sent_at;7 * r.n + case when g.n > 0 then 1 else 0 end> as event_at, r.n % 4 as link_no
        from r lateral view inline(filter(array(struct(0 as n, 'OPEN' as kind, 20 as floor_q), struct(1 as n, 'CLICK' as kind, 35 as floor_q), struct(2 as n, 'CLICK' as kind, 45 as floor_q)), g -> q > g.floor_q)) g""",
    ),
}


def _text(name: str, dialect: str) -> str:
    made = SPARK.get(name, TABLES[name]) if dialect == "spark" else TABLES[name]
    return re.sub(r"<(\w+):([^<>;]*)(?:;([^<>]*(?:>[^<>;]*)?[^<>]*?))?>(?=\s|,|\))", lambda m: DIALECTS[dialect][m[1]].format(m[2], m[3]), made[1])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by its name, or a model table."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs = SPARK.get(name, TABLES[name])[0]
    text = _text(name, "spark")
    for n in needs:
        text = re.sub(rf"\b(from|join) {n}\b", rf"\1 {{{n}}}", text)
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in needs})


class Tables(dict):
    """Model tables, made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._from = (spark, sf_dir)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = table(*self._from, name)
        return self[name]


def _closure(names: tuple[str, ...], out: dict[str, None]) -> dict[str, None]:
    for n in names:
        if n in TABLES and n not in out:
            _closure(TABLES[n][0], out)
            out[n] = None
    return out


def cte(*names: str) -> str:
    """`WITH ...` for an oracle that uses these model tables; other CTEs may follow after a comma."""
    return "WITH " + ",\n".join(f"{n} AS ({_text(n, 'duckdb')})" for n in _closure(names, {}))
