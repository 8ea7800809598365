"""Tables of several partitions are written by several tasks."""

import math
import os
from glob import glob

import pytest

import __spark_entry__  # noqa: F401 (registers the queries)
from gridmill.plans.registry import QUERIES
from gridmill.sources import tables
from gridmill.streaming import incremental

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


def dealt(spark, name, path):
    spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(4).write.parquet(f"{path}/{name}.parquet")
    for other in glob(f"{FOLDER}/*.parquet"):
        if not os.path.basename(other).startswith(f"{name}."):
            os.symlink(other, f"{path}/{os.path.basename(other)}")
    return str(path)


def test_export_takes_the_own_partitions(spark, tmp_path, monkeypatch):
    folder, seen, real = dealt(spark, "orders", tmp_path), [], tables.export_snapshot
    monkeypatch.setattr(tables, "export_snapshot", lambda df, path: (seen.append(df.rdd.getNumPartitions()), real(df, path)))
    got = QUERIES["S6_snapshot_export"](spark, folder).first()
    n = spark.read.parquet(f"{folder}/orders.parquet").count()
    assert seen[0] > 1 and (got.least_files, got.n) == (math.ceil(n / 5000), n)


def test_sync_reads_several_files(spark, tmp_path, monkeypatch):
    folder, seen, real = dealt(spark, "customer", tmp_path), [], incremental.sync_updates
    monkeypatch.setattr(incremental, "sync_updates", lambda spark, source, *rest: (seen.append(len(glob(f"{source}/part-*"))), real(spark, source, *rest)))
    got = sorted(map(tuple, QUERIES["D21_watermark_sync"](spark, folder).collect()), key=str)
    assert seen[0] > 1 and got == sorted(map(tuple, QUERIES["D21_watermark_sync"](spark, FOLDER).collect()), key=str)


def test_numbered_files(spark, tmp_path):
    from gridmill.sources import numbered

    df = spark.range(0, 1234, 1, 7).selectExpr("id", "concat('n', id % 10) AS name", "IF(id % 3 = 0, NULL, timestamp_seconds(id)) AS at")
    for rows, order in ((100, ["id"]), (617, ["name", "id"]), (5000, []), (1, ["id"])):
        path = f"{tmp_path}/{rows}"
        numbered.export_numbered(df, path, rows, order)
        names = sorted(p.name for p in (tmp_path / str(rows)).iterdir())
        assert names == sorted(f"batch_{i + 1}.parquet" for i in range(-(-1234 // rows)))
    sizes = [spark.read.parquet(f"{tmp_path}/100/batch_{i}.parquet").selectExpr("count(*)", "min(id)", "max(id)").first() for i in (1, 12, 13)]
    assert [tuple(r) for r in sizes] == [(100, 0, 99), (100, 1100, 1199), (34, 1200, 1233)]
    whole = spark.read.parquet(f"{tmp_path}/617")
    assert whole.exceptAll(df).count() == 0 and whole.count() == 1234 and whole.dtypes == df.dtypes
    numbered.export_numbered(df.limit(150), f"{tmp_path}/100", 100)  # fewer parts than before: the others go
    assert sorted(p.name for p in (tmp_path / "100").iterdir()) == ["batch_1.parquet", "batch_2.parquet"]
    numbered.export_numbered(df.limit(0), f"{tmp_path}/100", 100)
    assert list((tmp_path / "100").iterdir()) == []


def test_failed_export_leaves_no_part(spark, tmp_path):
    import pytest

    from gridmill.sources import numbered

    numbered.export_numbered(spark.range(10), f"{tmp_path}/x", 5)
    writer = numbered.NumberedWriter(f"{tmp_path}/x", 5)
    with pytest.raises(ValueError):
        writer.commit([numbered.Parts([[2, "gone.parquet", 5]])])
    writer.abort([])
    assert sorted(p.name for p in (tmp_path / "x").iterdir()) == ["batch_1.parquet", "batch_2.parquet"]
