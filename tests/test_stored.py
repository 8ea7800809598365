"""Stored tables that merges touch in part, and streams whose state outlives a restart."""

import pytest
from pyspark.sql import functions as F

from gridmill.operators import diff
from gridmill.plans import migration
from gridmill.sources import merged
from gridmill.sources.merged import MergedTable
from gridmill.streaming import first_seen, incremental

KIND = "id long, name string, updated_at timestamp_ntz"


def rows_of(spark, *rows):
    from datetime import datetime

    return spark.createDataFrame([(i, n, datetime(2024, 1, d)) for i, n, d in rows], KIND)


def plain(df):
    return sorted(tuple(r) for r in df.select("id", "name").collect())


def upsert(held, new):
    return diff.upsert(held, new, ["id"], "updated_at")


def test_untouched_files_keep_their_names(spark, tmp_path):
    table = MergedTable.create(spark, str(tmp_path / "t"), rows_of(spark, *[(i, f"n{i}", 1) for i in range(400)]), ["id"], buckets=16)
    before = table.manifest()
    after = table.merge(rows_of(spark, (7, "new", 2), (1000, "added", 2), (1000, "older", 1)), upsert, {"bookmark": "x"})
    changed = {b for b in before.files if before.files[b] != after.files.get(b)}
    assert 1 <= len(changed) <= 2 and len(before.files) == 16
    assert all(before.files[b] == after.files[b] for b in before.files if b not in changed)
    want = {i: f"n{i}" for i in range(400)} | {7: "new", 1000: "added"}
    assert dict(plain(table.read())) == want and table.manifest().notes == {"bookmark": "x"}
    assert dict(plain(table.read(version=0)))[7] == "n7"
    assert table.merge(rows_of(spark), upsert).files == after.files  # nothing comes in: a version of the same files
    assert table.vacuum(versions=1) == len(changed) and dict(plain(table.read())) == want


def test_two_writers_of_one_version(spark, tmp_path):
    one = MergedTable.create(spark, str(tmp_path / "t"), rows_of(spark, (1, "a", 1)), ["id"], buckets=2)
    other = MergedTable(spark, str(tmp_path / "t"))

    def slow(held, new):
        other.merge(rows_of(spark, (2, "b", 1)), upsert)  # commits first
        return upsert(held, new)

    with pytest.raises(merged.Conflict):
        one.merge(rows_of(spark, (3, "c", 1)), slow)
    assert plain(one.read()) == [(1, "a"), (2, "b")]
    one.merge(rows_of(spark, (3, "c", 1)), upsert)
    assert plain(one.read()) == [(1, "a"), (2, "b"), (3, "c")]


def test_empty_table_and_null_keys(spark, tmp_path):
    table = MergedTable.create(spark, str(tmp_path / "t"), rows_of(spark), ["id"], buckets=4)
    assert table.read().count() == 0 and table.manifest().files == {}
    table.merge(rows_of(spark, (None, "none", 1), (1, "a", 1)), upsert)
    table.merge(rows_of(spark, (None, "other", 2)), upsert)
    assert sorted(map(str, table.read().select("id", "name").collect())) == sorted(["Row(id=None, name='other')", "Row(id=1, name='a')"])


def test_sync_takes_each_batch_once(spark, tmp_path):
    base, new = str(tmp_path), rows_of(spark, (1, "x", 5), (1, "y", 4), (2, "b", 9), (3, "z", 1), (9, "none", 9))
    table = MergedTable.create(spark, f"{base}/t", rows_of(spark, (1, "a", 2), (2, "b", 2), (3, "c", 2)).withColumn("is_migrated", F.lit(0)), ["id"], buckets=4)
    new.write.parquet(f"{base}/in")
    incremental.sync_stored(spark, f"{base}/in", new.schema, table, f"{base}/state", "id", "updated_at")
    assert plain(table.read()) == [(1, "x"), (2, "b"), (3, "c")]
    assert table.manifest().notes == {"batch": "0", "watermark": "2024-01-09 00:00:00.000000"}
    rows_of(spark, (3, "w", 8)).write.mode("append").parquet(f"{base}/in")
    incremental.sync_stored(spark, f"{base}/in", new.schema, table, f"{base}/state", "id", "updated_at")
    assert sorted(tuple(r) for r in table.read().select("id", "name", "is_migrated").collect()) == [(1, "x", 1), (2, "b", 0), (3, "w", 1)]
    version = table.manifest().version
    incremental.sync_stored(spark, f"{base}/in", new.schema, table, f"{base}/again", "id", "updated_at")  # its batch 0 is known
    assert table.manifest().version == version


def leads(spark, *rows):
    held = {"companyRegionId": 1, "createdAt": "d", "updatedAt": "d", "leadSourceId": "s", "paymentMethod": "CASH", "status": "NEW", "leadStatus": "CONVERTED", "purchaseDate": "NOW", "entityType": "INDIVIDUAL"}
    kind = "n int, leadId string, firstName string, mobilePhone string, companyRegionId int, createdAt string, updatedAt string, leadSourceId string, paymentMethod string, status string, leadStatus string, purchaseDate string, entityType string"
    return spark.createDataFrame([(n, i, f, p, *held.values()) for n, i, f, p in rows], kind)


def test_duplicates_of_earlier_batches(spark, tmp_path):
    """Three batches, each a run of its own, give what one pass over all rows gives."""
    rows = [(1, "A", "Ann", "1"), (2, "A", "Ann", "9"), (3, "B", "", "2"), (4, "C", "Cy", "3"), (5, "D", "Di", "1"), (6, "B", "Bo", "2"), (7, "E", "Ed", "2"), (8, "F", "Fi", "3"), (9, "G", "Gus", "4"), (10, "H", "Hal", "4"), (11, "G", "Gus", "5"), (12, "K", "Kim", None), (13, "L", "Lea", "7")]
    everything = leads(spark, *rows)
    loaded = spark.createDataFrame([("L", "x"), ("zz", "4")], "leadId string, mobilePhone string")
    for part in (rows[:4], rows[4:8], rows[8:]):
        leads(spark, *part).write.mode("append").parquet(f"{tmp_path}/in")
        first_seen.resume_stateful(spark, f"{tmp_path}/in", everything.schema, f"{tmp_path}/out", f"{tmp_path}/state", lambda d: first_seen.stream_leads(d, loaded, "n"), partitions=2)
    got = {r.n: (r.outcome, r.failure_reason) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    want = {r.n: (r.outcome, r.failure_reason) for r in migration.migrate_leads(everything, loaded, "n").collect()}
    assert got == want
    assert got[5] == ("duplicate", "Duplicate mobilePhone within batch: 1") and got[6][0] == "duplicate" and got[7][0] == "inserted"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_load_runs_no_python_for_each_lead(spark, tmp_path):
    plans, seen = [], []
    loaded = spark.createDataFrame([("L", "x")], "leadId string, mobilePhone string")
    staged = leads(spark, *[(i, f"I{i % 70}", "Ann", f"{i % 50}") for i in range(100)])

    def classify(rows):
        out = first_seen.stream_leads(rows, loaded, "n")
        seen.append(rows.isStreaming)
        plans.append(out._jdf.queryExecution().toString())
        return out

    for part in ("n < 60", "n >= 60"):
        staged.where(part).write.mode("append").parquet(f"{tmp_path}/in")
        first_seen.resume_stateful(spark, f"{tmp_path}/in", staged.schema, f"{tmp_path}/out", f"{tmp_path}/state", classify)
    assert seen == [False, False] and not any("TransformWithState" in p or "Python" in p for p in plans)
    got = {r.n: (r.outcome, r.failure_reason) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {r.n: (r.outcome, r.failure_reason) for r in migration.migrate_leads(staged, loaded, "n").collect()}
