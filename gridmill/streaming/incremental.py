"""Loads that go on where they stopped: a file stream that ends when it has caught up.

A checkpoint keeps which files are done, so that a run after a failure repeats no
finished batch, and the statistics of finished batches are kept beside their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.operators.diff import apply_deltas, deltas
from gridmill.sources.merged import MergedTable


def resume_load(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, classify: Callable[[DataFrame], DataFrame], files_per_batch: int = 100) -> None:
    """Classify new files' rows into ``outcome`` and write each batch under its number. A
    batch that is tried again overwrites what it left."""

    def batch(rows: DataFrame, number: int) -> None:
        classify(rows).write.mode("overwrite").partitionBy("outcome").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def batch_statistics(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).groupBy("batch", "outcome").agg(F.count("*").alias("n")).orderBy("batch", "outcome")


def sync_updates(spark: SparkSession, source: str, schema: T.StructType, versions: str | MergedTable, checkpoint: str, key: str, updated: str) -> None:
    """Bring a table, kept as numbered versions under ``versions`` with version 0 to start
    from, up to date with new files. Each batch reads the version before its own and writes
    a whole one. A stored table goes to :func:`sync_stored`, which rewrites only what changes."""
    if isinstance(versions, MergedTable):
        return sync_stored(spark, source, schema, versions, checkpoint, key, updated)

    def batch(rows: DataFrame, number: int) -> None:
        target = spark.read.parquet(f"{versions}/version={number}")
        newest = rows.withColumn("_nth", F.row_number().over(_newest(key, updated, rows.columns))).where("_nth = 1").drop("_nth")
        found = deltas(newest, target, key, updated, exclude=("is_migrated",))
        apply_deltas(target.drop("is_migrated"), found, key).write.mode("overwrite").parquet(f"{versions}/version={number + 1}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def sync_stored(spark: SparkSession, source: str, schema: T.StructType, table: MergedTable, checkpoint: str, key: str, updated: str) -> None:
    """Bring a stored table up to date with new files: newer rows' changed fields, no inserts.

    Only buckets with such rows are written anew. Each commit notes the batch that it took
    in and the latest update that it has seen; a batch that is tried again after its commit
    is left out, one that failed before it finds the table as it was."""

    def batch(rows: DataFrame, number: int) -> None:
        if int(table.manifest().notes.get("batch", -1)) >= number:
            return
        newest = rows.withColumn("_nth", F.row_number().over(_newest(key, updated, rows.columns))).where("_nth = 1").drop("_nth")
        found = deltas(newest, table.read(), key, updated, exclude=("is_migrated",)).where("outcome = 'updated'").persist()
        try:
            seen = [t for t in (table.manifest().notes.get("watermark"), _text(watermark(rows, updated))) if t]
            table.merge(found, lambda held, changed: apply_deltas(held, changed, key), {"batch": str(number), "watermark": max(seen, default="")})
        finally:
            found.unpersist()

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _text(moment) -> str | None:
    return None if moment is None else moment.isoformat(" ", "microseconds")


def _newest(key: str, updated: str, columns: list[str]):
    """Newest first; rows of one time by a hash of all they hold, so that reruns agree."""
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(F.col(updated).desc(), F.xxhash64(*columns).desc())


def watermark(df: DataFrame, updated: str):
    """The time up to which ``df`` goes; what the next run filters by."""
    return df.agg(F.max(updated)).first()[0]
