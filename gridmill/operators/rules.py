"""Filters and validations with reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.text import is_missing

#: Above this many keys a list filter becomes a join.
FEW_KEYS = 1000


def with_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(column) != "")


def in_time(df: DataFrame, ts: str, first: Column, last: Column, measure: str) -> DataFrame:
    return df.where(F.col(ts).between(first, last) & (F.col(measure) > 0))


def one_of(df: DataFrame, column: str, keys: Sequence) -> DataFrame:
    """Rows whose key is listed; a long list is joined, so that it doesn't grow the plan."""
    if len(keys) <= FEW_KEYS:
        return df.where(F.col(column).isin(list(keys)))
    listed = df.sparkSession.createDataFrame([(k,) for k in set(keys)], df.select(column).schema)
    return df.join(listed, column, "left_semi")


def in_month(df: DataFrame, ts: str, year: int, month: int) -> DataFrame:
    """A range of days, so that partitions and row groups can be skipped."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    return df.where((F.to_date(ts) >= first) & (F.to_date(ts) < F.add_months(first, 1)))


def selected(df: DataFrame, column: str, choice: Sequence[str] | None) -> DataFrame:
    return df if not choice or "All" in choice else df.where(F.col(column).isin(list(choice)))


def newer_than(df: DataFrame, column: str, mark: Column) -> DataFrame:
    return df.where(F.col(column) > mark)


def clean_ids(df: DataFrame, names: Sequence[str] = ("LeadId", "lead_id")) -> DataFrame:
    column = next((n for n in names if n in df.columns), df.columns[0])
    out = df.select(F.trim(F.col(column).cast("string")).alias("lead_id"))
    return out.where(F.col("lead_id").isNotNull() & ~F.lower("lead_id").isin("", "nan"))


def first_reason(df: DataFrame, required: Sequence[str], allowed: dict[str, Sequence[str]], checks: Sequence[tuple[Column, Column]] = (), always: Sequence[str] = ()) -> Column:
    """The first thing wrong with a row, or null: required fields in order, then values
    outside what is allowed (empty ones pass, but for fields in ``always``), then checks."""
    kinds = dict(df.dtypes)
    tests = [(is_missing(F.col(f), kinds[f]), F.lit(f"Missing required field: {f}")) for f in required]
    for f, values in allowed.items():
        wrong = ~F.coalesce(F.col(f).isin(list(values)), F.lit(False))
        tests.append((wrong if f in always else wrong & ~is_missing(F.col(f), kinds[f]), F.concat(F.lit(f"Invalid {f}: "), F.coalesce(F.col(f).cast("string"), F.lit("None")))))
    tests += list(checks)
    return F.coalesce(*[F.when(test, reason) for test, reason in tests])


def all_reasons(tests: Sequence[tuple[Column, Column]]) -> Column:
    """Everything wrong with a row, joined by commas; null if nothing is."""
    return F.nullif(F.concat_ws(", ", *[F.when(test, reason) for test, reason in tests]), F.lit(""))
