"""Numbers and times: coercion, rounding, ratios, parsing, ages and date ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_PATTERNS = ("yyyy-MM-dd'T'HH:mm:ss.SSSX", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


def as_number(x: Column) -> Column:
    return x.try_cast("double")


def number_or_zero(x: Column) -> Column:
    return F.coalesce(x.try_cast("double"), F.lit(0.0))


def half_even(x: Column, places: int = 0) -> Column:
    return F.bround(x, places)


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole == 0, F.lit(empty)).otherwise(F.try_divide(part, whole))


def percent_change(source: Column, target: Column) -> Column:
    """Difference in percent of the source; an empty source gives 0 or 100."""
    return F.when(source == 0, F.when(target == 0, 0.0).otherwise(100.0)).otherwise((target - source) / source * 100)


def day_first(x: Column) -> Column:
    """A date written dd/MM/yyyy; null if it is none."""
    return F.to_date(F.try_to_timestamp(x, F.lit("dd/MM/yyyy")))


def day_and_hour(day: Column, hour: Column, fallback: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(F.concat_ws(" ", day, hour), F.lit("dd/MM/yyyy HH:mm:ss")), fallback)


def any_time(x: Column) -> Column:
    """A time as text in any of the known forms, or as seconds since 1970; null if none fits."""
    plain = F.trim(x)
    tries = [F.try_to_timestamp(plain, F.lit(p)) for p in TIME_PATTERNS]
    return F.coalesce(F.when(plain.rlike(r"^\d+(\.\d+)?$"), F.timestamp_seconds(plain.try_cast("double"))), *tries)


def iso_time(x: Column) -> Column:
    return F.try_to_timestamp(x, F.lit(TIME_PATTERNS[0]))


def age(born: Column, as_of: Column) -> Column:
    return F.year(as_of) - F.year(born)


def day_of(ts: Column) -> Column:
    return F.to_date(F.date_trunc("DAY", ts))


def minute_of(ts: Column) -> Column:
    return F.date_trunc("MINUTE", ts)


def load_range(last_success: Column, today: Column, first_days: int, first_run: Column) -> tuple[Column, Column]:
    """First and last day to load: on the first run ``first_days`` back, else from the last
    success, else yesterday."""
    yesterday = F.date_sub(today, 1)
    start = F.when(first_run, F.date_sub(today, first_days)).when(last_success.isNotNull(), last_success).otherwise(yesterday)
    return start, yesterday


def indicator(x: Column, kind: str, low: Column | None = None, high: Column | None = None) -> Column:
    """1 or 0: a positive number; or, for two-valued text, whether it is the greater value."""
    if kind == "positive":
        return (F.coalesce(x, F.lit(0)) > 0).cast("int")
    return F.when(x == low, 0).when(x == high, 1).cast("int")
