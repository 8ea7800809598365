"""Every registered query runs on the smallest tables and equals its SQL."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gridmill.plans.fixtures import BASE
from gridmill.plans.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return f"{float(v):.9g}" if type(v).__name__ in ("float", "Decimal") else str(v)


def rows(columns, values):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(v[k]) for k in order) for v in values), sorted(columns)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLE_SQL:
        found = duck.execute(ORACLE_SQL[name])
        assert got == rows([c[0] for c in found.description], found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["usage_date", "meter_id", "source", "time_interval_minutes", "energy_kwh"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
