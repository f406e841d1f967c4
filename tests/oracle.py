"""Runs a query on Spark and its SQL on DuckDB and compares the rows."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: tuple((x is None, str(x)) for x in r)
    return sorted(columns), sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=key)


def same(df, con, sql):
    r = con.sql(sql)
    want_columns, want = rows_of(r.columns, r.fetchall())
    columns, got = rows_of(df.columns, [tuple(x) for x in df.collect()])
    assert columns == want_columns
    assert len(got) == len(want)
    assert got == want
