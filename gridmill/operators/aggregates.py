"""Counts, shares, profiles and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.operators.quantiles import modes, quantiles, value_counts, wide_quantiles


def count_by(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name))


def distinct_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, name: str = "share") -> DataFrame:
    """Sums, and each one's percentage of all. The total is a window over the
    sums, a row a group."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias(value))
    total = F.sum(value).over(Window.partitionBy())
    return sums.withColumn(name, F.col(value) / total * 100)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, nulls, percent: one pass over the rows for all columns."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in names])
    return counts.select("_rows", F.inline(rows)).select("column_name", "nulls", F.bround(F.when(F.col("_rows") > 0, F.col("nulls") / F.col("_rows") * 100).otherwise(0.0), 2).alias("percent"))


def non_null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        return counts.select(F.lit(name).alias("table_name"), F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in df.columns])))

    return reduce(DataFrame.unionByName, [one(n, df) for n, df in tables.items()])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()])


def row_count_comparison(source: DataFrame, target: DataFrame) -> DataFrame:
    """(table_name, n_rows) of two sides: difference, percent of the source, status."""
    s, t = source.withColumnRenamed("n_rows", "source_rows"), target.withColumnRenamed("n_rows", "target_rows")
    both = s.join(t, "table_name", "full").fillna(0, ["source_rows", "target_rows"])
    gap = F.col("target_rows") - F.col("source_rows")
    percent = F.when(F.col("source_rows") == 0, F.when(F.col("target_rows") == 0, 0.0).otherwise(100.0)).otherwise(F.bround(gap / F.col("source_rows") * 100, 2))
    status = F.when(gap == 0, "MATCH").when(gap > 0, "TARGET_HAS_MORE").otherwise("SOURCE_HAS_MORE")
    return both.withColumns({"difference": gap, "percent": percent, "status": status})


def describe(df: DataFrame) -> DataFrame:
    """A row per column: count, distinct, top, mean, deviation, quartiles. One pass for the
    counts and moments, one for the values' counts, two for the quartiles, of all columns."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    none = F.lit(None).cast("double")

    def one(name: str) -> Column:
        c, number = F.col(name), name in numbers
        moments = {"mean": F.avg(c) if number else none, "std": F.stddev_samp(c) if number else none, "minimum": F.min(c) if number else none, "maximum": F.max(c) if number else none}
        return F.struct(F.lit(name).alias("column_name"), F.count(c).alias("n"), *[x.cast("double").alias(k) for k, x in moments.items()])

    moments = df.agg(F.array(*[one(c) for c in df.columns]).alias("rows")).select(F.inline("rows"))
    tops = modes(value_counts(df, df.columns)).select(F.col("column").alias("_top"), "n_distinct", "top")
    out = moments.join(tops, F.col("column_name") == F.col("_top"), "left")
    if numbers:
        found = quantiles(df, numbers, (0.25, 0.5, 0.75)).groupBy(F.col("column").alias("_of")).agg(*[F.max(F.when(F.col("share") == s, F.col("value"))).alias(n) for n, s in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
        out = out.join(found, F.col("column_name") == F.col("_of"), "left")
    else:
        out = out.withColumns({n: none for n in ("q1", "median", "q3")})
    return out.select("column_name", "n", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "top", "mean", "std", "minimum", "q1", "median", "q3", "maximum")


def normalised_crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    counts = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).fillna(0)
    total = reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values])
    return counts.select(row, *[(F.col(f"`{v}`") / total).alias(str(v)) for v in values])


def histogram_density(df: DataFrame, group: str, value: str, low: float, width: float) -> DataFrame:
    bins = df.where(F.col(value).isNotNull()).groupBy(group, F.floor((F.col(value) - low) / width).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    return bins.withColumn("density", F.col("n") / (F.sum("n").over(Window.partitionBy(group)) * width))


def five_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    names = ("minimum", "q1", "median", "q3", "maximum")
    return wide_quantiles(df, {n: (value, i / 4) for i, n in enumerate(names)}, [group])


def fill_with_group_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Missing values take their group's median; a group as large as the table needs no task
    of its own."""
    medians = wide_quantiles(df, {"_median": (value, 0.5)}, [group])
    joined = df.join(medians.withColumnRenamed(group, "_group"), df[group].eqNullSafe(F.col("_group")), "left")
    return joined.withColumn(value, F.coalesce(F.col(value).cast("double"), F.col("_median"))).select(*df.columns)


def catalog_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table_name").agg(F.count("*").alias("n_columns"), F.count_if("is_nullable").alias("n_nullable"), F.mode("data_type", True).alias("commonest_type"))


def outcome_counts(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    return df.groupBy(outcome).agg(F.count("*").alias("n"))


def reconciliation(parts: Column, whole: Column) -> Column:
    return F.when(parts == whole, "PASS").otherwise("FAIL")


def clamped_centre(df: DataFrame, lat: str, lon: str, bounds: tuple, default: tuple) -> DataFrame:
    def clamp(x: Column, low: float, high: float) -> Column:
        return F.greatest(F.lit(low), F.least(F.lit(high), x))

    return df.agg(F.coalesce(clamp(F.avg(lat), *bounds[0]), F.lit(default[0])).alias("lat"), F.coalesce(clamp(F.avg(lon), *bounds[1]), F.lit(default[1])).alias("lon"))
