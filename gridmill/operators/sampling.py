"""Stratified samples: proportional allocation, caps, the draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of a hash by which rows are counted: 65536 steps a stratum.
STEP_DIGITS = 4


def allocate(frame: DataFrame, strata: Sequence[str], n: int, least: int = 1) -> DataFrame:
    """strata..., available, allocated: ``n`` units over the strata by their sizes.

    Shares are rounded half to even; the rounding gap goes one unit at a time over the
    strata in key order; each stratum then gets at least ``least``; what that makes too
    many is taken from the largest, one unit at a time, the first in key order among
    equals. The last step takes units off by their height, which needs no loop.

    Windows here run over strata, of which there are few; rows are aggregated before.
    """
    every = Window.partitionBy()
    sizes = frame.groupBy(*strata).agg(F.count("*").alias("available"))
    sizes = sizes.withColumn("_place", F.row_number().over(Window.orderBy(*[F.col(s).asc_nulls_first() for s in strata])) - 1)
    rounded = sizes.withColumn("_x", F.bround(F.col("available") / F.sum("available").over(every) * n).cast("long"))
    gap = F.lit(n) - F.sum("_x").over(every)
    total = F.count("*").over(every)
    repaired = rounded.withColumns({"_gap": gap, "_total": total})
    step = F.floor(F.abs("_gap") / F.col("_total")) + F.when(F.col("_place") < F.abs("_gap") % F.col("_total"), 1).otherwise(0)
    raised = repaired.withColumn("_x", F.greatest(F.col("_x") + F.signum("_gap") * step, F.lit(least)).cast("long"))
    raised = raised.withColumn("_excess", F.greatest(F.sum("_x").over(every) - n, F.lit(0)))
    units = raised.select("_place", "_x", "_excess", F.explode(F.when(F.col("_x") > least, F.sequence(F.lit(least + 1).cast("long"), F.col("_x")))).alias("_height"))
    order = F.row_number().over(Window.orderBy(F.col("_height").desc(), "_place"))
    taken = units.withColumn("_nth", order).where(F.col("_nth") <= F.col("_excess")).groupBy("_place").agg(F.count("*").alias("_taken"))
    out = raised.join(taken, "_place", "left")
    return out.select(*strata, "available", (F.col("_x") - F.coalesce("_taken", F.lit(0))).cast("long").alias("allocated"))


def draw(frame: DataFrame, allocation: DataFrame, strata: Sequence[str], key: str, seed: int = 42) -> DataFrame:
    """As many rows of each stratum as it was allocated, or all it has: those of the least
    hashes of key and seed, the same draw each time, none twice.

    Counts by the first ``STEP_DIGITS`` digits of the hash tell below which step all of a
    stratum's rows are drawn; only rows of the one step that is drawn in part are ranked."""
    given = allocation.select(*[F.col(s).alias(f"_{s}") for s in strata], "allocated")
    hashed = frame.withColumn("_hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))).withColumn("_step", F.substring("_hash", 1, STEP_DIGITS))
    counts = hashed.groupBy(*strata, "_step").agg(F.count("*").alias("_n")).join(given, _match(strata, "_"))
    upto = F.sum("_n").over(Window.partitionBy(*strata).orderBy(F.col("_step").asc_nulls_first()))
    # Of each stratum the first step with which it has enough rows, and how many of that step it needs.
    steps = counts.withColumn("_upto", upto).where(F.col("_upto") >= F.col("allocated"))
    steps = steps.groupBy(*[F.col(s).alias(f"_s_{s}") for s in strata]).agg(F.min(F.struct(F.col("_step").isNotNull().alias("known"), F.col("_step").alias("step"), (F.col("allocated") - F.col("_upto") + F.col("_n")).alias("need"))).alias("_last"))
    met = hashed.join(given, _match(strata, "_")).join(steps, _match(strata, "_s_"), "left")
    in_part = F.col("_last").isNotNull() & F.col("_step").eqNullSafe(F.col("_last.step"))
    below = F.col("_last").isNull() | (F.col("_step") < F.col("_last.step")) | (F.col("_step").isNull() & F.col("_last.known"))
    nth = F.row_number().over(Window.partitionBy(*strata).orderBy("_hash", key))
    ranked = met.where(in_part).withColumn("_nth", nth).where(F.col("_nth") <= F.col("_last.need"))
    return met.where(below).select(*frame.columns).unionByName(ranked.select(*frame.columns))


def _match(strata: Sequence[str], prefix: str) -> Column:
    on = F.lit(True)
    for s in strata:
        on = on & F.col(s).eqNullSafe(F.col(f"{prefix}{s}"))
    return on


def observed(frame: DataFrame, indicator: Column, key: str) -> DataFrame:
    return frame.agg(F.avg(indicator).alias("proportion"), F.count_distinct(key).alias("population"))
