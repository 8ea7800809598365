"""Registered queries: each an operator on its whole tables, with SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmill.plans.fixtures import Tables, with_derived

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *derived: str):
    """Register a function of tables under ``name``; ``derived`` are the derived tables that
    its SQL reads."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLE_SQL[name] = with_derived(sql, derived)
        return f

    return register
