"""Projections: names, types and layouts of columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rule = Callable[[str], str]


def collapse_blanks(name: str) -> str:
    return re.sub(r"\s+", " ", name).strip()


def underscored(name: str) -> str:
    return re.sub(r"[ /]", "_", name.lower())


def spelled_number(name: str) -> str:
    """``num`` as a word of its own becomes ``number``; dots go."""
    return re.sub(r"\bnum\b", "number", name.replace(".", ""))


STANDARD: tuple[Rule, ...] = (collapse_blanks, underscored)
FUEL: tuple[Rule, ...] = (spelled_number, collapse_blanks, underscored)


def normal_names(df: DataFrame, rules: Sequence[Rule] = STANDARD) -> DataFrame:
    names = list(df.columns)
    for rule in rules:
        names = [rule(n) for n in names]
    return df.toDF(*names)


def rename_aliases(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Columns under their target names, those present only. Where several name one target,
    the first that is not null counts."""
    of: dict[str, list[str]] = {}
    for name in df.columns:
        of.setdefault(aliases.get(name, name), []).append(name)
    return df.select(*[F.coalesce(*[df[f"`{n}`"] for n in names]).alias(target) for target, names in of.items()])


def subset(df: DataFrame, keep: Sequence[str] | None = None, drop_pattern: str | None = None) -> DataFrame:
    names = [c for c in (keep or df.columns) if c in df.columns and not (drop_pattern and re.search(drop_pattern, c))]
    return df.select(*names)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast what is there; values that don't fit become null, columns that are missing are skipped."""
    return df.withColumns({c: df[c].try_cast(t) for c, t in types.items() if c in df.columns})


def coerce_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``df`` that ``schema`` has (by lower-case name), in its types. Empty texts
    are null; truth values are read from words and digits."""
    targets = {f.name.lower(): f for f in schema.fields}
    return df.select(*[_coerced(df[c], targets[c.lower()].dataType).alias(targets[c.lower()].name) for c in df.columns if c.lower() in targets])


def _coerced(x: Column, kind: T.DataType) -> Column:
    text = F.nullif(F.trim(x.cast("string")), F.lit(""))
    if isinstance(kind, T.BooleanType):
        return F.when(F.lower(text).isin("true", "1", "yes"), True).when(F.lower(text).isin("false", "0", "no"), False)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSX")), F.try_to_timestamp(text)).cast(kind)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return text.try_cast("double").try_cast(kind)
    return text.try_cast(kind)


def intersect(df: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    names = {f.name.lower() for f in schema.fields}
    return df.select(*[c for c in df.columns if c.lower() in names]).where(F.col(key).isNotNull())


def drop_compound(df: DataFrame) -> DataFrame:
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.StructType)])


def truncate_texts(df: DataFrame, length: int | None = None) -> DataFrame:
    """Cut every text to ``length`` characters; off by default."""
    if length is None:
        return df
    return df.withColumns({f.name: F.substring(f.name, 1, length) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def prepare_record(df: DataFrame, surrogate: str = "id") -> DataFrame:
    """Empty texts are null, the surrogate key goes, the row is marked as migrated."""
    out = df.drop(surrogate)
    texts = {f.name: F.nullif(F.col(f.name), F.lit("")) for f in out.schema.fields if isinstance(f.dataType, T.StringType)}
    return out.withColumns(texts).withColumn("is_migrated", F.lit(1))


def to_layout(df: DataFrame, layout: Sequence[tuple[str, str, Column | None]]) -> DataFrame:
    """(name, type, expression) columns; without an expression, nulls of the type."""
    return df.select(*[(F.lit(None) if x is None else x).cast(t).alias(n) for n, t, x in layout])


def map_fields(df: DataFrame, fields: dict[str, str], defaults: dict[str, str]) -> DataFrame:
    """Columns under the target's names; defaults where a value is missing or empty."""
    out = []
    for source, target in fields.items():
        x = F.col(source) if source in df.columns else F.lit(None).cast("string")
        out.append(F.coalesce(F.nullif(x, F.lit("")), F.lit(defaults.get(target))).alias(target))
    return df.select(*out)


def action_payload(ref: str, action: str, date: str, extra: dict[str, Sequence[str]]) -> Column:
    """JSON of an account action; ``extra`` names further fields for single actions."""
    parts = [F.col(ref), F.col(action), F.col(date)]
    for kind, names in extra.items():
        parts += [F.when(F.col(action) == kind, F.col(n)).alias(n) for n in names]
    return F.to_json(F.struct(*parts))


def nested_payload(scalars: Sequence[str], nested: dict[str, str]) -> Column:
    return F.to_json(F.struct(*scalars, *[F.struct(F.col(source).alias("id")).alias(name) for name, source in nested.items()]))
