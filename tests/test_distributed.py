"""Reconciliation by digests, key filters, ranks by counts, threshold draws and the quadtree:
each against the plain way, with groups that would not fit a task."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmill.operators import dedupe, diff, digests, geo, sampling
from gridmill.plans import transform


def test_equal_tables_join_no_rows(spark):
    a = spark.range(5000).selectExpr("id", "IF(id % 7 = 0, NULL, id % 11) AS x", "IF(id % 5 = 0, NULL, 'n') AS y")
    same = a.orderBy(F.col("id").desc())
    for side in digests.where_differing(a, same, ["id"], bits=6):
        assert side.count() == 0
    swapped = a.withColumn("x", F.when(F.col("id") == 14, 3).otherwise(F.col("x"))).where("id <> 99").unionByName(spark.sql("SELECT 9999L id, 1L x, 'z' y"))
    s, t = digests.where_differing(a, swapped, ["id"], bits=6)
    assert {14, 99} <= {r.id for r in s.collect()} and s.count() < 30 and t.count() < 30
    assert [tuple(r) for r in diff.differing(a, swapped, ["id"]).collect()] == [(14, None, 3, None if 14 % 5 == 0 else "n", "n")]
    assert sorted(map(tuple, diff.one_sided(a, swapped, ["id"]).collect())) == [(99, "only_source"), (9999, "only_target")]


def test_digests_tell_repeated_rows_and_moved_nulls(spark):
    a = spark.createDataFrame([(1, "x", None), (1, "x", None), (None, "p", "q")], "k int, a string, b string")
    for rows in ([(1, "x", None), (None, "p", "q")], [(1, "x", "x"), (1, "x", "x"), (None, "p", "q")], [(1, None, "x"), (1, None, "x"), (None, "p", "q")], [(1, "x", None), (1, "x", None), (None, "q", "p")]):
        b = spark.createDataFrame(rows, a.schema)
        assert digests.where_differing(a, b, ["k"])[0].count() > 0


@pytest.mark.parametrize("log_bits", [15, 24])
def test_key_filter_loses_nothing(spark, log_bits):
    small = spark.range(0, 3000, 3).selectExpr("IF(id % 30 = 0, NULL, id) AS k", "concat('t', id) AS t")
    large = spark.range(50_000).selectExpr("id AS k", "concat('t', id) AS t", "id AS v")
    for keys in (["k"], ["k", "t"]):
        kept = dedupe.possible(large, small, keys, log_bits)
        assert kept.columns == large.columns
        found = {r.k for r in kept.collect()}
        assert {i for i in range(0, 3000, 3) if i % 30} <= found
        assert len(found) < (9000 if log_bits == 15 else 1100)
    assert dedupe.possible(large, small.withColumn("k", F.col("k").cast("int")), ["k"]).count() == 50_000  # other type: not filtered
    left = dedupe.not_loaded(small, large.where("k % 2 = 0"), ["k"])
    assert sorted(str(r.k) for r in left.collect()) == sorted(str(None if i % 30 == 0 else i) for i in range(0, 3000, 3) if i % 30 == 0 or i % 2)


def test_average_ranks(spark):
    random.seed(6)
    rows = [(i, random.choice([None, 1.5, 2.5, 2.5, 2.5, random.gauss(0, 50)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, v double")
    over = Window.orderBy(F.col("v").desc_nulls_last())
    ties = F.count("*").over(Window.partitionBy("v"))
    want = df.select("id", (F.rank().over(over) + (ties - 1) / 2).cast("int").alias("r"))
    assert sorted(map(tuple, dedupe.average_ranks(df, "v", "r").select("id", "r").collect())) == sorted(map(tuple, want.collect()))
    assert dedupe.average_ranks(df.limit(0), "v", "r").count() == 0


@pytest.mark.parametrize("digits", [1, 4])
def test_draw_takes_the_least_hashes(spark, monkeypatch, digits):
    monkeypatch.setattr(sampling, "STEP_DIGITS", digits)
    rows = [(i, ("a", "b", None)[i % 3] if i < 900 else "few") for i in range(904)] + [(None, "few"), (5000, "zero")]
    frame = spark.createDataFrame(rows, "id int, s string")
    given = spark.createDataFrame([("a", 17), ("b", 300), (None, 299), ("few", 9), ("zero", 0)], "s string, allocated long")
    got = sampling.draw(frame, given, ["s"], "id", 7)
    nth = F.row_number().over(Window.partitionBy("s").orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(":7"))), "id"))
    want = frame.withColumn("n", nth).join(given.withColumnRenamed("s", "_s"), F.col("s").eqNullSafe(F.col("_s"))).where("n <= allocated").select("id", "s")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 17 + 300 + 299 + 5


def test_a_cell_with_half_of_all_points_is_split(spark):
    random.seed(8)
    points = [(f"p{i}", *((1.0, 36.0) if i % 2 else (random.uniform(-4, 4), random.uniform(29, 41)))) for i in range(2000)] + [(f"q{i}", 1.0 + random.gauss(0, 0.01), 36.0 + random.gauss(0, 0.01)) for i in range(1000)]
    centres = [(f"c{i}", random.uniform(-4, 4), random.uniform(29, 41)) for i in range(40)] + [("at", 1.0, 36.0), ("edge", 1.0 + 50 / 111, 36.0), ("west", -1.0, 29.0)]
    p, c = spark.createDataFrame(points, "name string, lat double, lon double"), spark.createDataFrame(centres, "name string, lat double, lon double")
    size = 50 / 111 / 4
    cells = p.select(geo._smallest("lat", size, 90.0).alias("row"), geo._smallest("lon", size, 180.0).alias("col"))
    tree = geo.quadtree(cells, size, 100).collect()
    held = cells.groupBy("row", "col").count().collect()
    most = max(held, key=lambda r: r["count"])
    leaf = next(r for r in tree if (r.row, r.col) == (most.row, most.col))
    assert len(tree) == len(held) and leaf.level == 0 and leaf.slices == math.ceil(most["count"] / 100) > 10
    assert {r.level for r in tree} - {0}  # elsewhere cells are larger
    want = sorted((cn, pn) for cn, a, b in centres for pn, x, y in points if math.sqrt((y - b) ** 2 + (x - a) ** 2) * 111.0 <= 50)
    for leaf_points in (100, 7, geo.LEAF_POINTS):
        got = geo.within_distance(p, c, 50.0, "name", "name", leaf_points)
        assert sorted((r.centre, r.point) for r in got.collect()) == want
    assert geo.within_distance(p.limit(0), c, 50.0, "name", "name").count() == 0


def test_places_are_compared_once(spark, monkeypatch):
    """Many rows at few places: the distances, coverage and hulls of the plain way, and no more
    rows are compared than there are pairs of places."""
    random.seed(9)
    spots = [(random.uniform(-2, 2), random.uniform(30, 34)) for _ in range(60)]
    p = spark.createDataFrame([(f"C{i}", *random.choice(spots)) for i in range(900)], "name string, lat double, lon double")
    c = spark.createDataFrame([(f"D{i % 37}", *random.choice(spots[:20])) for i in range(40)], "name string, lat double, lon double")  # three names stand twice
    near = geo.near_places(p, c, 50.0)
    assert near.count() == near.select("p_lat", "p_lon", "c_lat", "c_lon").distinct().count() <= 60 * 20
    plain = c.selectExpr("name AS centre", "lat AS a", "lon AS b").crossJoin(p).where(F.sqrt(F.pow(F.col("lat") - F.col("a"), 2) + F.pow(F.col("lon") - F.col("b"), 2)) * 111.0 <= 50)
    rows = [(r.centre, r.name, r.lon, r.lat) for r in plain.collect()]
    assert sorted((r.centre, r.point) for r in geo.within_distance(p, c, 50.0, "name", "name", 7).collect()) == sorted(r[:2] for r in rows)
    counts = {k: sum(r[0] == k for r in rows) for k in {r[0] for r in rows}}
    assert {r.centre: r.n_points for r in geo.coverage(p, c, 50.0, "name").collect()} == counts
    want = {k: geo.hull_of([r[2:] for r in rows if r[0] == k]) for k in counts}
    assert {r.centre: [(x.lon, x.lat) for x in r.ring] for r in geo.hulls(p, c, 50.0, "name").collect()} == {k: v for k, v in want.items() if v}


def test_distance_join_has_many_tasks(spark):
    p = spark.range(1, 500, 1, 1).selectExpr("concat('C', id) AS name", "CAST(id % 3 AS DOUBLE) AS lat", "30.0D AS lon")
    joined = geo.within_distance(p, p, 50.0, "name", "name", 10)
    assert joined.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_filter_keeps_a_hash_table(spark):
    """Sorting the places of all keys took memory with the number of keys."""
    small, large = spark.range(3000).withColumnRenamed("id", "k"), spark.range(50_000).withColumnRenamed("id", "k")
    plan = _plan(dedupe.possible(large, small, ["k"]))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_not_loaded_in_parts(spark, monkeypatch):
    """Short keys are dealt by their number, and a filter that is too full is not made."""
    batch = spark.range(9000).selectExpr("IF(id % 30 = 0, NULL, id % 5000) AS k", "concat('t', id % 5000) AS t")
    target = spark.range(0, 10_000, 3).selectExpr("id AS k", "concat('t', id) AS t")
    want = sorted(map(str, dedupe.not_loaded(batch, target, ["k", "t"]).collect()))
    monkeypatch.setattr(dedupe, "TASK_ROWS", 1000)
    assert dedupe.dealt(batch, ["k", "t"], 9000).rdd.getNumPartitions() == 9
    assert dedupe.dealt(batch.limit(0), ["k"], 0).count() == 0
    assert sorted(map(str, dedupe.not_loaded(dedupe.dealt(batch, ["k", "t"], 9000), target, ["k", "t"], rows=9000).collect())) == want
    monkeypatch.setattr(dedupe, "FILTER_BITS", 10)
    unfiltered = dedupe.not_loaded(batch, target, ["k", "t"], rows=9000)
    assert "_word" not in _plan(unfiltered) and sorted(map(str, unfiltered.collect())) == want


@pytest.mark.parametrize("rows", [0, 500_000])
def test_lookups_by_hash(spark, monkeypatch, rows):
    """A small dimension is broadcast, whatever its collation; before, each lookup shuffled
    and sorted the rows looked up for. Large ones give the same."""
    monkeypatch.setattr(transform, "LOOKUP_ROWS", rows)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([("é1", 1), ("E1", 2), ("u2", 3), (None, 4), ("u9", 5)], "user string, n int")
        users = spark.createDataFrame([("e1", 10), ("E1", 10), ("e1", 11), ("U2", 12), (None, 13)], "id string, v int")
        out = transform.looked_up(df, "user", users, "id", "v", "found")
        assert ("SortMergeJoin" in _plan(out)) == (rows == 0) and out.columns == ["user", "n", "found"]
        assert sorted((r.n, r.found or 0) for r in out.collect()) == [(1, 10), (1, 11), (2, 10), (2, 11), (3, 12), (4, 0), (5, 0)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_leads_move_once_for_surveys_and_referrals(spark):
    """Of the exchanges of the mashup only one holds the leads' wide rows, with every dimension small."""
    leads = spark.createDataFrame([("L1", "A1", "u1", "u2", "I1", None, "Web", None, "Ann"), ("L1", "A1", "u1", "u2", "I1", None, "Web", None, "Ann"), ("l1", "a1", "U1", None, None, "X", None, 7, "Bo"), (None, None, None, None, "I9", "x", "SALESAPP", None, "Cy")],
                                  "lead_id string, agent_id string, created_by_id string, modified_by_id string, id_number string, lead_source string, channel string, employee_id bigint, wide_name string")
    surveys = spark.createDataFrame([("L1", 1, 1, 1, 0, "u2", None, "k", None, "p"), ("L1", 2, 1, 1, 0, "U1", None, "m", None, "q")], "lead_id string, modified_at int, seq int, part_ref int, created_at int, created_by_id string, relation string, kin_name string, kin_surname string, kin_phone string")
    pairs = lambda k, v, *rows: spark.createDataFrame(list(rows), f"{k} string, {v} bigint")
    d = transform.Dimensions(pairs("user_id", "employee_id", ("U1", 1), ("U2", 2)), pairs("agent_id", "employee_id", ("a1", 5)), pairs("lead_id", "referral_id", ("l1", 30), ("L1", 31), ("zz", 32)), pairs("id_number", "customer_id", ("I1", 40)), pairs("name", "source_id", ("OTHERS", 50), ("x", 51)), pairs("name", "channel_id", ("web", 60), ("others", 61)))
    out = transform.mashup(leads, surveys, d)
    got = sorted((str(r.lead_id), r.wide_name, r.referral_id, r.created_by, r.modified_by, r.kin_created_by, r.kin_modified_by, r.kin_name, r.customer_id, r.source_id, r.channel_id, r.agent) for r in out.collect())
    assert got == [("L1", "Ann", 30, 1, 2, 1, 1, "m", 40, 50, 60, 5), ("L1", "Ann", 31, 1, 2, 1, 1, "m", 40, 50, 60, 5), ("None", "Cy", None, None, None, None, None, None, None, 51, 8, None), ("l1", "Bo", 30, 1, None, None, None, None, None, 51, 61, 7), ("l1", "Bo", 31, 1, None, None, None, None, None, 51, 61, 7)]
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(transform.mashup(leads, surveys, d))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert plan.count("SortMergeJoin") == 2 and plan.count("BroadcastHashJoin") == 9
