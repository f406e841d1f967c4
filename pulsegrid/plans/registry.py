"""The table of queries: name, function over model tables, and SQL for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.plans.model import Tables, cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, make: Callable[[Tables], DataFrame], tables: str = "", sql: str | None = None) -> None:
    """Registers make(tables).  sql reads the model tables named in `tables`; a leading comma adds CTEs."""
    QUERIES[name] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
    if sql is not None:
        head = cte(*tables.split()) if tables else "WITH none AS (SELECT 1)"
        ORACLE[name] = head + ("" if sql.lstrip().startswith(",") else "\n") + sql
