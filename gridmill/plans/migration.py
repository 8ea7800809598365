"""Staging to production: leads, identity checks, next of kin; intake of lead files; fuel.

Jobs classify rows and return them with ``outcome`` and ``failure_reason``; writing is a
separate call, so that a dry run is the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.functions import codes, numbers, text
from gridmill.operators.dedupe import loaded_reason, not_loaded, one_per_key
from gridmill.operators.rules import all_reasons, first_reason

LEAD_REQUIRED = ("leadId", "firstName", "mobilePhone", "companyRegionId", "createdAt", "updatedAt", "leadSourceId")
LEAD_ALLOWED = {"paymentMethod": codes.PAYMENT_METHODS, "status": codes.STATUSES, "leadStatus": codes.LEAD_STATUSES, "purchaseDate": codes.PURCHASE_DATES, "entityType": codes.ENTITY_TYPES}
KYC_REQUIRED = ("externalRefId", "leadId", "idNumber", "dob", "status", "documentType")
KYC_ALLOWED = {"documentType": codes.DOCUMENT_TYPES}
#: The region in which a serial number is required.
SERIAL_REGION = 3


def _nth(key: str, *order: Column) -> Column:
    return F.row_number().over(Window.partitionBy(key).orderBy(*order))


def first_valid_first(batch: DataFrame, key: str, reason: Column, second: str, order: str) -> DataFrame:
    """``batch`` with ``_again`` (the key was there before), ``_invalid`` (what ``reason``
    says of a first occurrence) and ``_second_again`` (the second key was there before on a
    valid row). The order of these three tests decides: an invalid row blocks no second key."""
    first = batch.withColumn("_again", _nth(key, F.col(order)) > 1)
    checked = first.withColumn("_invalid", F.when(~F.col("_again"), reason)).withColumn("_valid", ~F.col("_again") & F.col("_invalid").isNull())
    grouped = checked.withColumn("_group", own_group(F.col("_valid") & F.col(second).isNotNull(), second, order)).withColumn("_second_again", F.col("_valid") & (_nth("_group", F.col(order)) > 1))
    return grouped.drop("_valid", "_group")


def own_group(counts: Column, key: str, order: str) -> Column:
    """Rows that count go by ``key``; the others stand in groups of their own."""
    return F.when(counts, F.concat(F.lit("key:"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("row:"), F.col(order).cast("string")))


def lead_reason(staged: DataFrame) -> Column:
    return F.concat(F.lit("Validation failed: "), first_reason(staged, LEAD_REQUIRED, LEAD_ALLOWED))


def migrate_leads(staged: DataFrame, loaded: DataFrame, order: str) -> DataFrame:
    """In order: the same lead again; validation; the same phone again among valid leads;
    leads or phones that are loaded (the phone's reason wins). A phone first seen on an
    invalid lead blocks none; one of a lead that is rejected later does."""
    return lead_outcomes(first_valid_first(staged, "leadId", lead_reason(staged), "mobilePhone", order), loaded, staged.columns)


def lead_outcomes(phones: DataFrame, loaded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Outcome and reason of leads that have been held against each other."""
    there = loaded_reason(phones, [(loaded, ["leadId"], F.lit("Duplicate leadId")), (loaded, ["mobilePhone"], F.concat(F.lit("Duplicate mobilePhone: "), F.col("mobilePhone")))])
    outcome = F.when(F.col("_again"), "duplicate").when(F.col("_invalid").isNotNull(), "invalid").when(F.col("_second_again") | F.col("failure_reason").isNotNull(), "duplicate").otherwise("inserted")
    why = F.when(F.col("_again"), "Duplicate leadId within staging batch").when(F.col("_invalid").isNotNull(), F.col("_invalid")).when(F.col("_second_again"), F.concat(F.lit("Duplicate mobilePhone within batch: "), F.col("mobilePhone"))).otherwise(F.col("failure_reason"))
    return there.withColumns({"outcome": outcome, "failure_reason": why}).select(*columns, "outcome", "failure_reason")


def migrate_kyc(staged: DataFrame, loaded: DataFrame, leads: DataFrame, order: str) -> DataFrame:
    """As leads, with a serial number rule, pairs that are loaded, and the lead's existence."""
    serial = (F.col("companyRegionId") == SERIAL_REGION) & F.coalesce(F.col("serialNumber") == "", F.lit(True))
    first = staged.withColumn("_again", _nth("externalRefId", F.col(order)) > 1)
    reason = F.concat(F.lit("Validation failed: "), first_reason(first, KYC_REQUIRED, KYC_ALLOWED, [(serial, F.lit(f"serialNumber is required for region {SERIAL_REGION}"))], always=("documentType",)))
    checked = first.withColumn("_invalid", F.when(~F.col("_again"), reason))
    there = loaded_reason(checked, [(loaded, ["externalRefId"], F.lit("Duplicate externalRefId")), (loaded, ["leadId", "idNumber"], F.lit("Duplicate leadId+idNumber"))])
    known = leads.select(F.col("leadId").alias("_lead")).distinct().withColumn("_there", F.lit(True))
    parent = there.join(known, there["leadId"] == known["_lead"], "left")
    orphan = F.col("_there").isNull()
    outcome = F.when(F.col("_again"), "duplicate").when(F.col("_invalid").isNotNull(), "invalid").when(F.col("failure_reason").isNotNull(), "duplicate").when(orphan, "fk_failed").otherwise("inserted")
    why = F.when(F.col("_again"), "Duplicate externalRefId within staging batch").when(F.col("_invalid").isNotNull(), F.col("_invalid")).when(F.col("failure_reason").isNotNull(), F.col("failure_reason")).when(orphan, F.concat(F.lit("Missing leadId FK: "), F.col("leadId")))
    return parent.withColumns({"outcome": outcome, "failure_reason": why}).select(*staged.columns, "outcome", "failure_reason")


def migrate_kin(staged: DataFrame, loaded: DataFrame, leads: DataFrame) -> DataFrame:
    """Key present, pair not loaded, lead exists."""
    there = loaded_reason(staged, [(loaded, ["leadId", "phoneNumber"], F.lit("Duplicate leadId+phoneNumber"))])
    known = leads.select(F.col("leadId").alias("_lead")).distinct().withColumn("_there", F.lit(True))
    parent = there.join(known, there["leadId"] == known["_lead"], "left")
    missing = F.col("leadId").isNull() | (F.col("leadId") == "")
    outcome = F.when(missing, "invalid").when(F.col("failure_reason").isNotNull(), "duplicate").when(F.col("_there").isNull(), "fk_failed").otherwise("inserted")
    why = F.when(missing, "Missing leadId").when(F.col("failure_reason").isNotNull(), F.col("failure_reason")).when(F.col("_there").isNull(), F.concat(F.lit("Missing leadId FK: "), F.col("leadId")))
    return parent.withColumns({"outcome": outcome, "failure_reason": why}).select(*staged.columns, "outcome", "failure_reason")


def intake_leads(raw: DataFrame, order: str) -> DataFrame:
    """A lead file's rows with standard phone and names, then first of each phone, then
    everything that is wrong with each."""
    phone = text.standard_phone(F.col("phone_raw"))
    rows = raw.select(order, text.first_name(F.col("full_name")).alias("FirstName"), text.last_name(F.col("full_name")).alias("LastName"), phone.alias("MobilePhone"), F.coalesce(F.nullif("lead_source", F.lit("")), F.lit("")).alias("LeadSource"), F.lit("N/A").alias("Company"))
    # Rows without a phone are no duplicates of each other and must not share a group.
    group = F.coalesce(F.nullif("MobilePhone", F.lit("")), F.concat(F.lit("row:"), F.col(order).cast("string")))
    numbered = rows.withColumn("_group", group).withColumn("_again", _nth("_group", F.col(order)) > 1).drop("_group")
    wrong = all_reasons([(F.col("MobilePhone").isNull(), F.lit("missing phone number")), (F.col("MobilePhone").isNotNull() & ~text.is_standard_phone(F.col("MobilePhone")), F.concat(F.lit("invalid phone format: "), F.col("MobilePhone"))), (F.coalesce(F.col("FirstName"), F.lit("")) == "", F.lit("missing first name"))])
    outcome = F.when(F.col("_again"), "duplicate").when(wrong.isNotNull(), "invalid").otherwise("accepted")
    return numbered.withColumn("outcome", outcome).withColumn("failure_reason", F.when(F.col("_again"), "duplicate phone number").otherwise(wrong)).drop("_again")


def fuel_transactions(raw: DataFrame, load_ts: Column) -> DataFrame:
    """Raw fuel-card text typed: dates day first, hours, numbers with 0 for what is none."""
    return raw.select(
        text.without_decimal_zero(F.col("customer_num")).alias("customer_number"), F.coalesce("card_num", F.lit("")).alias("card_number"), F.coalesce("receipt_num", F.lit("")).alias("receipt_number"),
        numbers.day_and_hour(F.col("date_raw"), F.col("hour_raw"), load_ts).cast("timestamp_ntz").alias("transaction_datetime"), numbers.day_first(F.col("date_raw")).alias("transaction_date"),
        numbers.number_or_zero(F.col("qty_raw")).alias("quantity"), numbers.number_or_zero(F.col("amount")).alias("amount"),
    )


FUEL_KEY = ("card_number", "transaction_datetime", "receipt_number")


def load_fuel(raw: DataFrame, target: DataFrame, load_ts: Column) -> DataFrame:
    """New transactions: one of each key, in the file and against the target."""
    typed = fuel_transactions(raw, load_ts)
    first = one_per_key(typed, FUEL_KEY, [F.col("customer_number"), F.col("quantity"), F.col("amount")])
    return not_loaded(first, target, FUEL_KEY)
