"""Account workflows: decisions, guarded updates, generated rows, dated actions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.operators.dedupe import one_per_key


def requested_status(requested: DataFrame, accounts: DataFrame, key: str) -> DataFrame:
    return requested.join(accounts.select(key, "status"), key, "left").withColumn("status", F.coalesce("status", F.lit("NOT FOUND")))


def repossession_action(accounts: DataFrame, repossessions: DataFrame, order: Sequence[Column]) -> DataFrame:
    """What an account in arrears needs, by its latest record: none, or one that is over,
    asks for a new one; an open one does not."""
    latest = one_per_key(repossessions, ["account_id"], order).select("account_id", F.col("status").alias("latest"))
    action = F.when(F.col("latest").isNull() | F.col("latest").isin("PAID", "CANCELLED"), "create").when(F.col("latest") == "NEW", "skip_new").otherwise("skip_other")
    return accounts.join(latest, "account_id", "left").select("account_id", "latest", action.alias("action"))


def guarded_update(accounts: DataFrame, ids: DataFrame, guard: str = "Arrears", to: str = "Pending Repossession") -> DataFrame:
    """``ids`` get the new status only where they still have the guarded one, in whatever case."""
    listed = ids.select("account_id").distinct().withColumn("_listed", F.lit(True))
    hit = F.coalesce(F.col("_listed"), F.lit(False)) & (F.lower("status") == guard.lower())
    return accounts.join(listed, "account_id", "left").withColumn("updated", hit).withColumn("status", F.when(hit, to).otherwise(F.col("status"))).drop("_listed")


def reverse_tagging(repossessions: DataFrame, ids: DataFrame, active: Sequence[str] = ("NEW", "IN_TRANSIT")) -> DataFrame:
    """Active records of ``ids`` become PAID and inactive."""
    listed = ids.select("account_id").distinct().withColumn("_listed", F.lit(True))
    hit = F.coalesce(F.col("_listed"), F.lit(False)) & F.col("status").isin(list(active))
    out = repossessions.join(listed, "account_id", "left").withColumn("is_active", F.when(hit, 0).otherwise(1))
    return out.withColumn("status", F.when(hit, "PAID").otherwise(F.col("status"))).drop("_listed")


def one_premise(accounts: DataFrame, premises: DataFrame) -> DataFrame:
    """The least premise of each account's customer."""
    least = premises.groupBy("customer_id").agg(F.min("premises_id").alias("premises_id"))
    return accounts.join(least, "customer_id", "left")


def chained_id(step: str, *keys: str) -> Column:
    """The same id for the same keys and step, on any run."""
    return F.substring(F.sha2(F.concat_ws("|", F.lit(step), *[F.col(k).cast("string") for k in keys]), 256), 1, 32)


def workflow_rows(accounts: DataFrame, premises: DataFrame, done: DataFrame) -> DataFrame:
    """Assignment, schedule and form ids of each account to process, and why the others are not."""
    placed = one_premise(accounts, premises).join(done.select("account_id").distinct().withColumn("_done", F.lit(True)), "account_id", "left")
    outcome = F.when(F.col("premises_id").isNull(), "invalid").when(F.col("_done"), "skipped").otherwise("processed")
    ids = placed.withColumn("outcome", outcome).withColumn("assignment_id", F.when(outcome == "processed", chained_id("assignment", "account_id", "premises_id")))
    ids = ids.withColumn("schedule_id", F.when(F.col("assignment_id").isNotNull(), chained_id("schedule", "assignment_id")))
    ids = ids.withColumn("form_id", F.when(F.col("schedule_id").isNotNull(), chained_id("form", "schedule_id")))
    return ids.select("account_id", "customer_id", "premises_id", "outcome", "assignment_id", "schedule_id", "form_id")


def assign_unless_equal(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Set columns, marking rows that had the values already."""
    same = F.lit(True)
    for c, x in values.items():
        same = same & F.col(c).eqNullSafe(x)
    out = df.withColumn("outcome", F.when(same, "skipped").otherwise("updated"))
    return out.withColumns(values)


def apply_actions(accounts: DataFrame, actions: DataFrame) -> DataFrame:
    """The latest date of each action per account, on the accounts."""
    latest = actions.groupBy("account_ref").pivot("action", ["jsf", "dispatch"]).agg(F.max("action_date"))
    return accounts.join(latest.withColumnsRenamed({"jsf": "jsf_date", "dispatch": "dispatch_date"}), "account_ref", "left")


def verify_actions(accounts: DataFrame, actions: DataFrame) -> DataFrame:
    """The accounts that actions name, as they are now, in order."""
    return accounts.join(actions.select("account_ref").distinct(), "account_ref", "left_semi").orderBy("account_ref")
