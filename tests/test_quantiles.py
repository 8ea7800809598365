"""Exact quantiles and modes against numpy, with fences so narrow that they matter."""

import random
from collections import Counter

import numpy as np
import pytest

from gridmill.operators import aggregates, quantiles, segment

SHARES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_quantiles_are_exact(spark, accuracy):
    random.seed(accuracy)
    rows = [("long", random.choice([random.gauss(0, 1e6), random.random(), 7.0])) for _ in range(6000)] + [("ties", float(random.choice([1, 2, 2, 2, 3]))) for _ in range(3000)]
    rows += [(f"n{n}", float(random.randint(0, 9))) for n in range(1, 12) for _ in range(n)] + [("none", None), ("none", None), (None, 4.0), (None, None), (None, 6.0)]
    df = spark.createDataFrame([(g, v, None if v is None else -v) for g, v in rows], "g string, a double, b double")
    got = {(r.g, r.column, r.share): r.value for r in quantiles.quantiles(df, ["a", "b"], SHARES, ["g"], accuracy).collect()}
    for g in {g for g, _ in rows}:
        held = [v for of, v in rows if of == g and v is not None]
        for s in SHARES:
            for column, sign in (("a", 1), ("b", -1)):
                want = np.quantile(np.array(held) * sign, s) if held else None
                assert got.pop((g, column, s)) == (pytest.approx(want, abs=1e-9) if held else None)
    assert not got
    whole = [v for _, v in rows if v is not None]
    one = quantiles.wide_quantiles(df, {"m": ("a", 0.5), "q": ("b", 0.25)}, accuracy=accuracy).collect()
    assert [(r.m, r.q) for r in one] == [(pytest.approx(np.median(whole)), pytest.approx(np.quantile([-v for v in whole], 0.25)))]


def test_modes(spark):
    rows = [("b", 2, None), ("a", 10, None), ("b", 10, None), ("a", 2, None), (None, None, None), ("c", 7, None)]
    df = spark.createDataFrame(rows, "t string, n int, e string")
    got = {r.column: (r.n_distinct, r.top, r.frequency) for r in quantiles.modes(quantiles.value_counts(df, df.columns)).collect()}
    assert got == {"t": (3, "a", 2), "n": (3, "2", 2)}  # 2 before 10: numbers go by size
    assert Counter(r.column_name for r in aggregates.describe(df).collect()) == Counter(df.columns)
    described = {r.column_name: r for r in aggregates.describe(df).collect()}
    assert (described["n"].n, described["n"].median, described["n"].top, described["e"].n, described["e"].n_distinct, described["e"].top, described["t"].q1) == (5, 7.0, "2", 0, 0, None, None)
    assert [tuple(r) for r in aggregates.describe(df.select("t")).collect()] == [("t", 5, 3, "a", None, None, None, None, None, None, None)]


def test_impute_runs_nothing_while_it_is_planned(spark):
    rows = [(1, "x", 1, 2.0), (2, None, None, None), (3, "y", 4, 4.0), (4, "x", 4, None), (5, "y", None, 9.0)]
    df = spark.createDataFrame(rows, "id int, t string, n int, v double")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    planned = segment.impute(df, "id")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before
    assert planned.dtypes == df.dtypes
    assert sorted(map(tuple, planned.collect())) == [(1, "x", 1, 2.0), (2, "x", 4, 4.0), (3, "y", 4, 4.0), (4, "x", 4, 4.0), (5, "y", 4, 9.0)]
