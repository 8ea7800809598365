"""Exact quantiles and modes of groups of any size.

A quantile's place is fenced in first: a sketch of bounded size gives two values of each
group between which it must lie. A second pass counts what lies below, keeps apart the
values inside (some 4 / ``accuracy`` of the rows, equal ones summed before they are
shuffled), and ranks only these. So no task holds a group's values: it holds a sketch of
``accuracy`` entries, or the share of one group's values that lies inside. About the root
of a group's rows is a good ``accuracy``; 10,000 goes with a hundred million.

Modes are counts by value, of which the greatest is taken; a group's different values are
never gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000


def _tall(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """A row for each row and column: the groups as _g0, ..., column, value."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*[F.col(b).alias(f"_g{i}") for i, b in enumerate(by)], F.inline(cells))


def _same(a: DataFrame, b: DataFrame, names: Sequence[str], nullable: Sequence[str]) -> Column:
    """Equal in ``names``; in ``nullable`` ones nulls are equal too."""
    on = None
    for n in names:
        same = a[n].eqNullSafe(b[n]) if n in nullable else a[n] == b[n]
        on = same if on is None else on & same
    return on


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """by..., column, share, value: the exact quantile, between two values in proportion, as
    ``percentile`` has it. Nulls don't count; a group without values has nulls."""
    groups = [f"_g{i}" for i in range(len(by))]
    rows, slack = _tall(df, columns, by), 2 / accuracy
    fences = [F.percentile_approx("value", [max(s - slack, 0.0) for s in shares], accuracy), F.percentile_approx("value", [min(s + slack, 1.0) for s in shares], accuracy)]
    stats = rows.groupBy(*groups, "column").agg(F.count("value").alias("n"), fences[0].alias("low"), fences[1].alias("high"))
    wanted = F.array(*[F.struct(F.lit(i).alias("nth"), F.lit(float(s)).alias("share")) for i, s in enumerate(shares)])
    stats = stats.select(*groups, "column", "n", "low", "high", F.inline(wanted)).withColumns({"low": F.col("low")[F.col("nth")], "high": F.col("high")[F.col("nth")], "place": F.col("share") * (F.col("n") - 1)})
    small = stats.select(*groups, "column", "nth", "low", "high")
    small = F.broadcast(small) if not by else small  # without groups a row for each column and share
    rows = rows.where("value IS NOT NULL").alias("r").join(small.alias("s"), _same(rows, small, [*groups, "column"], groups))
    rows = rows.select(*[F.col(f"r.{g}") for g in groups], "r.column", "nth", "value", F.when(F.col("value") < F.col("low"), -1).when(F.col("value") > F.col("high"), 1).otherwise(0).alias("zone"))
    counted = rows.groupBy(*groups, "column", "nth", "zone", F.when(F.col("zone") == 0, F.col("value")).alias("inside")).agg(F.count("*").alias("c"), F.min("value").alias("least"), F.max("value").alias("most"))
    # The value next to the fence on either side is known too: a small group's place can be one off.
    value = F.when(F.col("zone") < 0, F.col("most")).otherwise(F.col("least"))
    upto = F.sum("c").over(Window.partitionBy(*groups, "column", "nth").orderBy("zone", "inside").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counted.select(*groups, "column", "nth", "zone", value.alias("value"), (upto - F.col("c")).alias("first"), upto.alias("end"))
    goal = stats.select(*groups, "column", "nth", "share", "n", "place")
    met = goal.alias("s").join(ranked.alias("k"), _same(goal, ranked, [*groups, "column", "nth"], groups), "left")

    def at(rank: Column) -> Column:
        here = (F.col("first") <= rank) & (rank < F.col("end"))
        known = (F.col("zone") == 0) | (F.col("zone") < 0) & (rank == F.col("end") - 1) | (F.col("zone") > 0) & (rank == F.col("first"))
        return F.max(F.when(here & known, F.col("k.value")).when(here, F.raise_error(F.lit("a quantile lies outside of its fence"))))

    lower, upper = F.floor("place"), F.ceil("place")
    found = met.groupBy(*[F.col(f"s.{g}") for g in groups], "s.column", "share", "n", "place").agg(at(lower).alias("a"), at(upper).alias("b"))
    mixed = (F.ceil("place") - F.col("place")) * F.col("a") + (F.col("place") - F.floor("place")) * F.col("b")
    exact = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(mixed)
    return found.select(*[F.col(g).alias(b) for g, b in zip(groups, by)], "column", "share", exact.alias("value"))


def wide_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]], by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """by..., and a column for each of ``wanted``: name to (column, share)."""
    found = quantiles(df, sorted({c for c, _ in wanted.values()}), sorted({s for _, s in wanted.values()}), [*by], accuracy)
    picks = [F.max(F.when((F.col("column") == c) & (F.col("share") == float(s)), F.col("value"))).alias(name) for name, (c, s) in wanted.items()]
    return found.groupBy(*by).agg(*picks)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, text, number (of a number), n: how often each value stands in each column."""
    kinds = dict(df.dtypes)
    number = lambda c: F.col(c).cast("double") if kinds[c] not in ("string", "boolean", "date", "timestamp", "timestamp_ntz", "binary") else F.lit(None).cast("double")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), number(c).alias("number")) for c in columns])
    return df.select(F.inline(cells)).where("text IS NOT NULL").groupBy("column", "text", "number").agg(F.count("*").alias("n"))


def modes(counts: DataFrame) -> DataFrame:
    """column, n_distinct, top, frequency of :func:`value_counts`; the smallest on ties."""
    best = F.min(F.struct((-F.col("n")).alias("n"), "number", "text")).alias("best")
    return counts.groupBy("column").agg(F.count("*").alias("n_distinct"), best).select("column", "n_distinct", F.col("best.text").alias("top"), (-F.col("best.n")).alias("frequency"))
