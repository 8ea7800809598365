"""Text cleaning: phones, names, keys, JSON, literals that stand for nothing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country codes that a local phone number replaces by 0.
COUNTRY_CODES = ("254", "255", "252", "256")
# Parts of an error text, by the category they mean, in order.
ERROR_CATEGORIES = (
    (("duplicate value found", "duplicates_detected"), "Duplicate Record"),
    (("required_field_missing",), "Missing Field"),
    (("invalid_field",), "Invalid Field"),
    (("malformed request",), "API Error"),
)


def standard_phone(raw: Column) -> Column:
    """A phone in local form. Scientific notation becomes digits first; what can't be read
    is null; what has another length keeps its digits for the validation to reject."""
    plain = F.trim(raw)
    number = plain.try_cast("double")
    whole = F.when(plain.rlike("[eE]"), number.try_cast("decimal(38,0)").cast("string")).otherwise(plain)
    digits = F.regexp_replace(whole, r"[^\d+]", "")
    coded = F.lit(False)
    for code in COUNTRY_CODES:
        coded = coded | digits.startswith(code)
    local = (
        F.when(digits.startswith("2540"), F.concat(F.lit("0"), F.substring(digits, 5, 100)))
        .when(digits.startswith("+254"), F.concat(F.lit("0"), F.substring(digits, 5, 100)))
        .when(coded, F.concat(F.lit("0"), F.substring(digits, 4, 100)))
        .when(digits.startswith("7") | digits.startswith("1"), F.concat(F.lit("0"), digits))
        .otherwise(digits)
    )
    return F.when(raw.isNull() | (raw == ""), None).otherwise(local)


def is_standard_phone(phone: Column) -> Column:
    return (F.length(phone) == 10) & phone.startswith("0")


def without_plus(phone: Column) -> Column:
    return F.replace(phone, F.lit("+"), F.lit(""))


def first_name(full: Column) -> Column:
    parts = F.split(F.trim(full), r"\s+")
    return F.when(F.coalesce(F.trim(full), F.lit("")) == "", "N/A").otherwise(parts[0])


def last_name(full: Column) -> Column:
    parts = F.split(F.trim(full), r"\s+")
    return F.when((F.coalesce(F.trim(full), F.lit("")) == "") | (F.size(parts) < 2), "N/A").otherwise(F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " "))


def error_category(message: Column) -> Column:
    low, out = F.lower(message), None
    for parts, name in ERROR_CATEGORIES:
        met = F.lit(False)
        for part in parts:
            met = met | F.contains(low, F.lit(part))
        out = F.when(met, name) if out is None else out.when(met, name)
    return out.otherwise("Other Error")


def normal_text(x: Column) -> Column:
    return F.lower(F.trim(F.coalesce(x, F.lit("missing"))))


def without_decimal_zero(x: Column) -> Column:
    return F.regexp_replace(x, r"\.0$", "")


def composite_key(*parts: Column) -> Column:
    """Parts joined by two pipes; a null is spelled out, so that it equals a null."""
    return F.concat_ws("||", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def prefixed(prefix: str, x: Column) -> Column:
    """Null stays null."""
    return F.concat(F.lit(prefix), x.cast("string"))


def json_text(document: Column, path: str) -> Column:
    return F.get_json_object(document, f"$.{path}")


def cleaned(x: Column, *void: str) -> Column:
    """Null where the text is empty or one of the spellings of nothing."""
    return F.when(x.isNull() | (F.trim(x) == "") | F.lower(x).isin([v.lower() for v in void]), None).otherwise(x)


def row_as_json(columns: list[str]) -> Column:
    """The row as a JSON object that keeps keys whose value is null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def is_missing(x: Column, kind: str) -> Column:
    """Null, an empty text, or the number 0."""
    if kind == "string":
        return x.isNull() | (x == "")
    return x.isNull() | (x == 0) if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") else x.isNull()
