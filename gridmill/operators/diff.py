"""Tables held against each other: differences, deltas, deletes, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.text import row_as_json
from gridmill.operators.dedupe import one_per_key
from gridmill.operators.digests import where_differing

# Names that are taken as keys when none is known, in order.
USUAL_KEYS = ("id", "uuid", "user_id", "email", "username")


def choose_keys(source: DataFrame, target: DataFrame, given: Sequence[str] = (), source_keys: Sequence[str] = (), target_keys: Sequence[str] = ()) -> list[str]:
    common = [c for c in source.columns if c in target.columns]
    if given and all(k in common for k in given):
        return list(given)
    if source_keys and list(source_keys) == list(target_keys):
        return list(source_keys)
    return next(([k] for k in USUAL_KEYS if k in common), common)


def keyed_outer(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Full join on the keys, null keys equal: <column>_source, <column>_target for the
    common columns, and the side a row is on. Of rows with equal keys the first counts."""
    common = [c for c in source.columns if c in target.columns and c not in keys]
    first = [F.col(c).asc_nulls_first() for c in common] or [F.lit(0)]
    s = one_per_key(source.select(*keys, *common), keys, first).select(*[F.col(c).alias(f"{c}_source") for c in (*keys, *common)], F.lit(True).alias("_s"))
    t = one_per_key(target.select(*keys, *common), keys, first).select(*[F.col(c).alias(f"{c}_target") for c in (*keys, *common)], F.lit(True).alias("_t"))
    on = None
    for k in keys:
        same = F.col(f"{k}_source").eqNullSafe(F.col(f"{k}_target"))
        on = same if on is None else on & same
    side = F.when(F.col("_t").isNull(), "only_source").when(F.col("_s").isNull(), "only_target").otherwise("both")
    joined = s.join(t, on, "full").withColumn("side", side)
    return joined.select(*[F.when(F.col("_s"), F.col(f"{k}_source")).otherwise(F.col(f"{k}_target")).alias(k) for k in keys], "side", *[f"{c}_{x}" for c in common for x in ("source", "target")]), common


def _changed(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{c}_source").eqNullSafe(F.col(f"{c}_target"))
    return out


def differing(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows on both sides that differ: keys, the two values of each column. Only where digests
    of the tables differ are their rows joined."""
    source, target = where_differing(source, target, keys)
    joined, common = keyed_outer(source, target, keys)
    return joined.where((F.col("side") == "both") & _changed(common)).drop("side")


def one_sided(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that only one side has, and which, found in the same way."""
    joined, _ = keyed_outer(*where_differing(source, target, keys), keys)
    return joined.where(F.col("side") != "both").select(*keys, "side")


def differing_long(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row for each key and column that differs, values as text."""
    rows = differing(source, target, keys)
    common = [c.removesuffix("_source") for c in rows.columns if c.endswith("_source")]
    parts = F.array(*[F.when(~F.col(f"{c}_source").eqNullSafe(F.col(f"{c}_target")), F.struct(F.lit(c).alias("column"), F.col(f"{c}_source").cast("string").alias("source_value"), F.col(f"{c}_target").cast("string").alias("target_value"))) for c in common])
    return rows.select(*keys, F.inline(F.array_compact(parts)))


def summary(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    joined, common = keyed_outer(source, target, keys)
    side = F.col("side")
    return joined.agg(
        F.count_if(side != "only_target").alias("source_rows"), F.count_if(side != "only_source").alias("target_rows"), F.count_if(side == "only_source").alias("only_source"),
        F.count_if(side == "only_target").alias("only_target"), F.count_if(side == "both").alias("common"), F.count_if((side == "both") & _changed(common)).alias("differing"),
    )


def deltas(source: DataFrame, target: DataFrame, key: str, updated: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Outcome of each source row against the target's row of its key: ``skipped`` (no such
    row, or not newer), ``no_change``, ``updated``; changed fields as (column, old, new)."""
    fields = [c for c in source.columns if c in target.columns and c not in (key, updated, *exclude)]
    held = one_per_key(target, [key], [F.col(updated).desc_nulls_last(), F.xxhash64(*fields).desc()])  # repeated keys must not multiply rows
    old = held.select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in (*fields, updated)], F.lit(True).alias("_there"))
    joined = source.join(old, key, "left")
    newer = F.coalesce(F.col("_there") & (F.col(updated) > F.col(f"_old_{updated}")), F.lit(False))
    change = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_old_{c}")), F.struct(F.lit(c).alias("column"), F.col(f"_old_{c}").cast("string").alias("old"), F.col(c).cast("string").alias("new"))) for c in fields]))
    out = joined.withColumn("changes", F.when(newer, change).otherwise(F.array().cast("array<struct<column:string,old:string,new:string>>")))
    outcome = F.when(~newer, "skipped").when(F.size("changes") == 0, "no_change").otherwise("updated")
    return out.withColumn("outcome", outcome).select(*source.columns, "changes", "outcome")


def apply_deltas(target: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The target after the updates: rows that were updated take the source's columns and
    are marked as migrated, as they stay if they were; nothing is inserted."""
    marked = F.coalesce("is_migrated", F.lit(0)) if "is_migrated" in target.columns else F.lit(0)
    new = found.where("outcome = 'updated'").select(key, *[F.col(c).alias(f"_new_{c}") for c in found.columns if c in target.columns and c not in (key, "is_migrated")], F.lit(True).alias("_hit"))
    joined = target.join(new, key, "left")
    held = [F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if f"_new_{c}" in new.columns else F.col(c) for c in target.columns if c not in (key, "is_migrated")]
    return joined.select(key, *held, F.when(F.col("_hit"), 1).otherwise(marked).alias("is_migrated"))


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], updated: str | None = None) -> DataFrame:
    """Incoming rows in place of the target's, and beside them. Incoming nulls count. Of
    several incoming rows of a key the latest by ``updated`` wins, then the one of the
    greatest hash, so that reruns agree."""
    order = [F.col("_from").desc(), *([F.col(updated).desc_nulls_last()] if updated else []), F.xxhash64(*target.columns).desc()]
    both = target.withColumn("_from", F.lit(0)).unionByName(incoming.withColumn("_from", F.lit(1)))
    return one_per_key(both, keys, order).drop("_from")


def upsert_counts(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    there = target.select(*keys).distinct().withColumn("_there", F.lit(True))
    met = incoming.select(*keys).join(there, list(keys), "left")
    return met.agg(F.count_if(F.col("_there").isNull()).alias("inserted"), F.count_if(F.col("_there")).alias("updated"))


def deleted_rows(old: DataFrame, new: DataFrame, key: str, table: str, at: Column) -> DataFrame:
    """An audit row for each row that is gone, with its columns as JSON."""
    gone = old.join(new.select(key), key, "left_anti")
    return gone.select(F.lit(table).alias("table_name"), F.col(key).cast("string").alias("record_id"), row_as_json(old.columns).alias("deleted_data"), at.alias("deleted_at"))


def schema_rows(df: DataFrame, table: str) -> DataFrame:
    rows = [(table, f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, data_type string, is_nullable boolean, position int")


def schema_diff(source: DataFrame, target: DataFrame, renamed: dict[str, str] | None = None, split: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Catalog rows of two sides compared. ``renamed`` gives a source table's name on the
    target's side; ``split`` the tables into which one went, of which any may hold a column."""
    s = source
    for a, b in (renamed or {}).items():
        s = s.withColumn("table_name", F.when(F.col("table_name") == a, b).otherwise(F.col("table_name")))
    t = target
    for a, parts in (split or {}).items():
        t = t.withColumn("table_name", F.when(F.col("table_name").isin(list(parts)), a).otherwise(F.col("table_name")))
    s = s.select("table_name", "column_name", F.col("data_type").alias("source_type"))
    t = t.groupBy("table_name", "column_name").agg(F.min("data_type").alias("target_type"))
    status = F.when(F.col("target_type").isNull(), "missing_in_target").when(F.col("source_type").isNull(), "missing_in_source").when(F.col("source_type") != F.col("target_type"), "type_mismatch").otherwise("match")
    return s.join(t, ["table_name", "column_name"], "full").withColumn("status", status)
