"""Tables: projected scans, pages, increments, exports, partitioned appends, bookmarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an exported file.
EXPORT_ROWS = 5000


def scan(spark: SparkSession, path: str, columns: Sequence[str], kind: str = "parquet", where: str | None = None, **options: str) -> DataFrame:
    """Columns of a table; the predicate goes down to the source."""
    df = spark.read.format(kind).options(**options).load(path)
    return (df.where(where) if where else df).select(*columns)


def page(df: DataFrame, key: str, after, size: int) -> DataFrame:
    return (df if after is None else df.where(F.col(key) > after)).orderBy(key).limit(size)


def since_yesterday(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    return df.where(F.col(ts) >= F.date_sub(as_of, 1))


def this_month(df: DataFrame, ts: str, as_of: Column) -> DataFrame:
    first = F.trunc(as_of, "MM")
    return df.where((F.col(ts) >= first) & (F.col(ts) < F.add_months(first, 1)))


def export_snapshot(df: DataFrame, path: str, rows: int = EXPORT_ROWS) -> None:
    df.write.option("maxRecordsPerFile", rows).option("compression", "snappy").mode("overwrite").parquet(path)


def append_monthly(df: DataFrame, path: str, ts: str, *sort: str) -> None:
    """Append to a table partitioned by month, sorted inside. Rows are dealt by month and a
    hash of the sort columns, so that a month is written by several tasks."""
    monthly = df.withColumn("yyyymm", F.date_format(ts, "yyyyMM"))
    monthly.repartition("yyyymm", *sort[:1]).sortWithinPartitions("yyyymm", ts, *sort).write.partitionBy("yyyymm").mode("append").parquet(path)


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Overwrite only the partitions that ``df`` has rows of. ``df`` must not read them."""
    df.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def read_bookmark(spark: SparkSession, path: str, name: str):
    """What a job noted last, or None on its first run."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    row = spark.read.parquet(path).where(F.col("name") == name).agg(F.max("value").alias("value")).first()
    return row["value"]


def write_bookmark(spark: SparkSession, path: str, name: str, value) -> None:
    spark.createDataFrame([(name, value)], "name string, value timestamp_ntz").coalesce(1).write.mode("append").parquet(path)


def scratch_folder(spark: SparkSession, what: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share; sessions
    without that setting (tests on one machine) get one of their own."""
    import os
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"/tmp/checkpoints/{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"
