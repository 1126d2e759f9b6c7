"""The registered queries and their SQL, gathered from one module per area."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import bar_queries, flow_queries, series_queries, table_queries, vendor_queries

AREAS = (bar_queries, flow_queries, series_queries, table_queries, vendor_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for area in AREAS for name, f in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in AREAS for name, sql in area.ORACLE_SQL.items()}
