"""Loads whose duplicates may lie in an earlier batch: what was seen is kept from batch to batch.

Each batch of the stream is classified as a whole, by windows and joins, and leaves the
keys that it has seen in files under its number, beside the stream's checkpoint. A later
batch, also one after a restart, joins with those of all batches before it; of these only
keys that may be in the batch are shuffled. A batch that is tried again reads the same
earlier ones and overwrites its own.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.operators.dedupe import possible
from gridmill.plans import migration

#: Where the load that is running keeps its keys, and the number of its batch.
_BATCH: ContextVar[tuple[str, int]] = ContextVar("batch")


def flag_seen(rows: DataFrame, key: str, order: str, flag: str, counts: str | None = None) -> DataFrame:
    """A batch with ``flag``: whether the key was there before, earlier in this batch by
    ``order`` or in a batch before it. Rows whose ``counts`` is not true are not flagged,
    and their keys are not noted. To be used within :func:`resume_stateful`."""
    base, number = _BATCH.get()
    path, counted = f"{base}/{flag}", F.coalesce(F.col(counts), F.lit(False)) if counts else F.lit(True)
    keys = rows.where(counted).select(F.col(key).alias("seen")).distinct()
    keys.write.mode("overwrite").parquet(f"{path}/batch={number}")
    nth = F.row_number().over(Window.partitionBy(key, "_counted").orderBy(order))
    out = rows.withColumn("_counted", counted).withColumn(flag, F.col("_counted") & (nth > 1))
    if number:
        earlier = rows.sparkSession.read.schema(T.StructType([*keys.schema, T.StructField("batch", T.LongType())])).parquet(path).where(F.col("batch") < number)
        here = rows.sparkSession.read.schema(keys.schema).parquet(f"{path}/batch={number}")
        both = here.join(possible(earlier.select("seen"), here, ["seen"]).distinct().withColumnRenamed("seen", "_before"), F.col("seen").eqNullSafe(F.col("_before"))).select("_before", F.lit(True).alias("_there"))
        out = out.join(both, F.col(key).eqNullSafe(F.col("_before")), "left").withColumn(flag, F.col(flag) | F.col("_counted") & F.coalesce("_there", F.lit(False))).drop("_before", "_there")
    return out.drop("_counted")


def stream_leads(rows: DataFrame, loaded: DataFrame, order: str) -> DataFrame:
    """:func:`gridmill.plans.migration.migrate_leads` on a batch of a stream: the same tests in the same
    order, with the leads and the phones of all earlier batches known."""
    again = flag_seen(rows, "leadId", order, "_again")
    checked = again.withColumn("_invalid", F.when(~F.col("_again"), migration.lead_reason(rows)))
    counts = ~F.col("_again") & F.col("_invalid").isNull() & F.col("mobilePhone").isNotNull()
    checked = checked.withColumn("_counts", counts).withColumn("_group", migration.own_group(F.col("_counts"), "mobilePhone", order))
    return migration.lead_outcomes(flag_seen(checked, "_group", order, "_second_again", "_counts"), loaded, rows.columns)


def resume_stateful(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, classify: Callable[[DataFrame], DataFrame], files_per_batch: int = 100, partitions: int | None = None) -> None:
    """Take in new files' rows, classified by a ``classify`` that may use :func:`flag_seen`,
    and write each batch under its number; a batch that is tried again starts from the keys
    seen before it and overwrites what it left. ``partitions`` are those of its shuffles."""
    held = spark.conf.get("spark.sql.shuffle.partitions", None)
    if partitions:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)

    def batch(rows: DataFrame, number: int) -> None:
        at = _BATCH.set((f"{checkpoint}/seen", number))
        try:
            classify(rows).write.mode("overwrite").partitionBy("outcome").parquet(f"{target}/batch={number}")
        finally:
            _BATCH.reset(at)

    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.shuffle.partitions") if held is None else spark.conf.set("spark.sql.shuffle.partitions", held)
