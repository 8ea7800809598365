"""Latest and first rows, ranks, and what is already there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.sources.tables import scratch_folder


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where(F.col("_nth") <= k).drop("_nth")


def split_duplicates(df: DataFrame, key: str, order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """First occurrences, and the rest with the position that each has among its key's.
    Rows without a key are no duplicates of each other. They are kept apart from the
    window, so that they form no group."""
    keyed = df.where(F.col(key).isNotNull() & (F.trim(key) != ""))
    free = df.where(F.col(key).isNull() | (F.trim(key) == ""))
    nth = keyed.withColumn("occurrence", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return nth.where("occurrence = 1").drop("occurrence").unionByName(free), nth.where("occurrence > 1")


def average_rank(value: Column, *partition: str) -> Column:
    """Descending rank, ties sharing their mean, without its fraction."""
    over = Window.partitionBy(*partition)
    ties = F.count("*").over(Window.partitionBy(*partition, value))
    return (F.rank().over(over.orderBy(value.desc())) + (ties - 1) / 2).cast("int")


def average_ranks(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with the descending rank of ``value`` over all rows, ties sharing their mean,
    without its fraction, nulls last. Counts by value are summed over ranges of values: each
    task ranks its range and learns from a row a range how many rows come before."""
    spark = df.sparkSession
    path = scratch_folder(spark, "ranks")  # ranges are drawn from a sample: they must not change between two uses
    counts = df.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    counts.repartitionByRange(F.col("_value").desc_nulls_last()).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    held = spark.read.schema("_value " + df.schema[value].dataType.simpleString() + ", _n long, _range int").parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = held.groupBy("_range").agg(F.sum("_n").alias("_all")).select("_range", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("_range").orderBy(F.col("_value").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_start") + F.coalesce(F.sum("_n").over(within), F.lit(0)) + 1
    ranks = held.join(starts, "_range").select("_value", (first + (F.col("_n") - 1) / 2).cast("int").alias(out))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_value"))).select(*df.columns, out)


_PLAIN = (T.IntegralType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
#: Places of a key filter: 2 MB of bits, in words of 64.
FILTER_BITS = 24
#: Rows of a task of ``dealt``.
TASK_ROWS = 500_000


def _places(keys: Sequence[str], log_bits: int) -> list[Column]:
    return [F.xxhash64(F.lit(i), *keys).bitwiseAND(F.lit((1 << log_bits) - 1)) for i in (1, 2)]


def possible(large: DataFrame, small: DataFrame, keys: Sequence[str], log_bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``large`` whose keys may be in ``small``: all that are, and some others. A
    Bloom filter of two places a key is put together where the small side's rows lie, word
    by word in a hash table of at most ``2 ** log_bits / 64`` rows, and is broadcast: its
    size is given by ``log_bits``, whatever the number of keys. Where equal keys could have
    different hashes (other types, collations, doubles), and for a stream's small side,
    ``large`` stays as it is."""
    kinds = [(large.schema[k].dataType, small.schema[k].dataType) for k in keys]
    if small.isStreaming or any(a != b or not isinstance(a, _PLAIN) or isinstance(a, T.StringType) and not a.isUTF8BinaryCollation() for a, b in kinds):
        return large
    places = small.select(*keys).select(F.explode(F.array(*_places(keys, log_bits))).alias("_place"))
    bits = places.groupBy(F.expr("shiftright(_place, 6)").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, CAST(_place & 63 AS INT)))").alias("_bits"))
    out = large
    for place in _places(keys, log_bits):
        out = out.withColumn("_place", place)
        set_ = F.expr("shiftright(_bits, CAST(_place & 63 AS INT)) & 1L = 1L")
        out = out.join(F.broadcast(bits), (F.expr("shiftright(_place, 6)") == F.col("_word")) & set_, "left_semi").drop("_place")
    return out


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` of ``rows`` rows by its keys, a task for each ``TASK_ROWS``. Adaptive execution
    sizes tasks by compressed bytes, which short keys keep small however many rows they are;
    what a task sorts or hashes then grows with the table."""
    return df.repartition(max(1, -(-rows // TASK_ROWS)), *keys)


def not_loaded(df: DataFrame, target: DataFrame, keys: Sequence[str], rows: int = 0) -> DataFrame:
    """Rows whose key the target lacks. Of the target, which may be far larger than a batch,
    only rows that may match one are shuffled; where the batch is known to have so many
    ``rows`` that the filter would let most keys through, none is made."""
    sought = target.select(*keys)
    return df.join(sought if rows > 1 << FILTER_BITS - 2 else possible(sought, df, keys), list(keys), "left_anti")


def loaded_reason(df: DataFrame, tests: Sequence[tuple[DataFrame, Sequence[str], Column]]) -> DataFrame:
    """``df`` with ``failure_reason``: for each (target, keys, reason), in rising order of
    precedence, whether the keys are in the target. Of targets only possible matches move."""
    out, reasons = df, []
    for i, (target, keys, reason) in enumerate(tests):
        there = possible(target.select(*keys), df, keys).select(*[F.col(k).alias(f"_k{i}_{k}") for k in keys]).distinct().withColumn(f"_there{i}", F.lit(True))
        on = [out[k] == there[f"_k{i}_{k}"] for k in keys]
        out = out.join(there, on, "left")
        reasons.insert(0, F.when(F.col(f"_there{i}"), reason))
    return out.withColumn("failure_reason", F.coalesce(*reasons)).select(*df.columns, "failure_reason")


def references(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose parent exists, and the rest."""
    keys = parent.select(F.col(parent_key).alias(key)).distinct()
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")
