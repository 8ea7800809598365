from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.operators import dedupe, diff, sampling, schema
from gridmill.sources import files, tables
from gridmill.streaming import incremental


def test_upsert_is_idempotent_and_takes_nulls(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, x string")
    new = spark.createDataFrame([(2, None), (3, "c")], "id int, x string")
    once = diff.upsert(old, new, ["id"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted([(1, "a"), (2, None), (3, "c")], key=str)
    assert sorted(map(tuple, diff.upsert(once, new, ["id"]).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_differences_see_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "p", "y"), (4, "q", "z")], "id int, u string, v string")
    b = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, "q", "z")], "id int, u string, v string")
    assert [(r.id, r.column) for r in diff.differing_long(a, b, ["id"]).collect()] == [(2, "u")]
    s = diff.summary(a, b, ["id"]).first()
    assert (s.only_source, s.only_target, s.common, s.differing) == (1, 1, 2, 1)


def test_duplicates_keep_rows_without_key(spark):
    df = spark.createDataFrame([(1, "p"), (2, "p"), (3, None), (4, None), (5, " ")], "k int, phone string")
    first, rest = dedupe.split_duplicates(df, "phone", [F.col("k")])
    assert sorted(r.k for r in first.collect()) == [1, 3, 4, 5] and [(r.k, r.occurrence) for r in rest.collect()] == [(2, 2)]


def test_allocation_adds_up(spark):
    rows = [(f"s{i}",) for i, n in enumerate((50, 30, 3, 1, 1)) for _ in range(n)]
    got = {r.s: r.allocated for r in sampling.allocate(spark.createDataFrame(rows, "s string"), ["s"], 20, least=2).collect()}
    assert sum(got.values()) == 20 and min(got.values()) >= 2
    frame = spark.createDataFrame([(i, s) for i, (s,) in enumerate(rows)], "id int, s string")
    drawn = sampling.draw(frame, sampling.allocate(frame, ["s"], 20, least=2), ["s"], "id").collect()
    assert len({r.id for r in drawn}) == len(drawn) == sum(min(n, got[f"s{i}"]) for i, n in enumerate((50, 30, 3, 1, 1)))


def test_coercion_and_aliases(spark):
    raw = spark.createDataFrame([("7", "yes", "", "1.5")], "A string, B string, C string, D string")
    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.BooleanType()), T.StructField("c", T.DoubleType()), T.StructField("d", T.IntegerType())])
    assert tuple(schema.coerce_to(raw, target).first()) == (7, True, None, 1)
    two = spark.createDataFrame([(None, "x"), ("y", "z")], "Card string, `Card num` string")
    assert [r.card for r in schema.rename_aliases(two, {"Card": "card", "Card num": "card"}).collect()] == ["x", "y"]


def test_csv_dialects_and_newest_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name;town\nJosé;Bö\n".encode("latin-1"))
    df = files.read_csv_any(spark, str(tmp_path / "a.csv"), ["name", "town"])
    assert df.columns == ["name", "town"]
    assert files.newest_file(spark, str(tmp_path), "*.csv").endswith("a.csv")
    assert files.newest_file(spark, str(tmp_path), "*.xls") is None


def test_export_splits_files_and_months_append(spark, tmp_path):
    df = spark.range(12000).withColumn("ts", F.timestamp_seconds(F.col("id") * 3600))
    tables.export_snapshot(df.coalesce(1), str(tmp_path / "x"))
    assert len(list((tmp_path / "x").glob("*.parquet"))) == 3
    tables.append_monthly(df, str(tmp_path / "m"), "ts", "id")
    assert spark.read.parquet(str(tmp_path / "m")).where("yyyymm = 197001").count() == 31 * 24
    assert tables.read_bookmark(spark, str(tmp_path / "b"), "j") is None


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    rows = spark.range(10).withColumn("outcome", F.when(F.col("id") % 3 == 0, "bad").otherwise("good"))
    rows.select("id").coalesce(1).write.parquet(source)
    kind = T.StructType([T.StructField("id", T.LongType())])
    classify = lambda df: df.withColumn("outcome", F.when(F.col("id") % 3 == 0, "bad").otherwise("good"))
    incremental.resume_load(spark, source, kind, target, check, classify)
    spark.range(10, 14).coalesce(1).write.mode("append").parquet(source)
    incremental.resume_load(spark, source, kind, target, check, classify)
    got = [(r.batch, r.outcome, r.n) for r in incremental.batch_statistics(spark, target).collect()]
    assert got == [(0, "bad", 4), (0, "good", 6), (1, "bad", 1), (1, "good", 3)]


def test_stream_applies_only_newer_changes(spark, tmp_path):
    kind = "id int, x string, updated timestamp_ntz"
    spark.sql("SELECT 1 id, 'a' x, TIMESTAMP_NTZ '2024-01-01' updated UNION ALL SELECT 2, 'b', TIMESTAMP_NTZ '2024-01-01'").write.parquet(str(tmp_path / "v/version=0"))
    spark.sql("SELECT 1 id, 'A' x, TIMESTAMP_NTZ '2024-02-01' updated UNION ALL SELECT 2, 'B', TIMESTAMP_NTZ '2023-02-01' UNION ALL SELECT 9, 'n', TIMESTAMP_NTZ '2024-02-01'").coalesce(1).write.parquet(str(tmp_path / "in"))
    incremental.sync_updates(spark, str(tmp_path / "in"), T._parse_datatype_string(kind), str(tmp_path / "v"), str(tmp_path / "c"), "id", "updated")
    got = spark.read.parquet(str(tmp_path / "v/version=1")).orderBy("id").collect()
    assert [(r.id, r.x, r.is_migrated) for r in got] == [(1, "A", 1), (2, "b", 0)]
