"""The lead system's tables in the sales service's three layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.functions import codes, text
from gridmill.operators.dedupe import one_per_key
from gridmill.operators.schema import to_layout

# What stands for missing things, and the channel with an id of its own.
DEFAULT_USER = 895
OTHERS = "Others"
NO_NAME = "Not Specified"
OWN_CHANNEL, OWN_CHANNEL_ID = "SALESAPP", 8
SOURCE_SYSTEM = "SALESFORCE"
EMPLOYEE_SOURCE = "engineer referral"
COLLATION = "UNICODE_CI_AI"
#: A dimension of at most so many rows is broadcast.
LOOKUP_ROWS = 500_000


@dataclass(frozen=True)
class Dimensions:
    """users (user_id, employee_id), agents (agent_id, employee_id), referrals (lead_id,
    referral_id), customers (id_number, customer_id), sources (name, source_id), channels
    (name, channel_id)."""

    users: DataFrame
    agents: DataFrame
    referrals: DataFrame
    customers: DataFrame
    sources: DataFrame
    channels: DataFrame


def lookup_pairs(dimension: DataFrame, key: str, value: str, collation: str | None = COLLATION) -> DataFrame:
    """Different (``_key``, ``_value``) of a dimension, which is counted: with at most
    ``LOOKUP_ROWS`` rows it is broadcast."""
    cased = F.collate(F.col(key), collation) if collation else F.col(key)
    pairs = dimension.where(F.col(key).isNotNull()).select(cased.alias("_key"), F.col(value).alias("_value")).distinct()
    return F.broadcast(pairs) if dimension.count() <= LOOKUP_ROWS else pairs


def with_pair(df: DataFrame, by: str, pairs: DataFrame, out: str, collation: str | None = COLLATION) -> DataFrame:
    """``df`` with the ``_value`` of the pair whose ``_key`` equals ``by`` as ``out``. Both
    sides of the condition are columns, not expressions: only then are collated keys joined
    by hash, and can small pairs be broadcast; else every lookup shuffles ``df`` and sorts it."""
    by_ = F.collate(F.col(by), collation) if collation else F.col(by)
    return df.withColumn("_by", by_).join(pairs, F.col("_by") == F.col("_key"), "left").drop("_by", "_key").withColumnRenamed("_value", out)


def looked_up(df: DataFrame, by: str, dimension: DataFrame, key: str, value: str, out: str, collation: str | None = COLLATION) -> DataFrame:
    """``df`` with ``value`` of the row of ``dimension`` whose ``key`` equals ``by``, whatever
    its case and accents, as ``out``; null where none does. A key that has several values
    gives a row for each."""
    return with_pair(df, by, lookup_pairs(dimension, key, value, collation), out, collation)


def mashup(leads: DataFrame, surveys: DataFrame, d: Dimensions) -> DataFrame:
    """A row per lead with its latest survey, its users and the ids of what it names: ten
    left joins. Equal rows appear once: leads are told apart right after the joins by lead,
    whose partitioning they keep, and dimensions before they are joined, so nothing wide is
    shuffled for it. Referrals, which match a lead's id whatever its case, are looked up for
    the ids alone, and join the leads by the exact id as surveys do: leads move once for
    both. Both of a survey's users go by who created it."""
    latest = one_per_key(surveys, ["lead_id"], [F.col("modified_at").desc(), F.col("seq").desc(), F.col("part_ref").desc()])
    kin = latest.select(F.col("lead_id").alias("_lead"), "kin_name", "kin_surname", "relation", "kin_phone", F.col("created_at").alias("kin_created_at"), F.col("modified_at").alias("kin_modified_at"), F.col("created_by_id").alias("kin_created_by_id"))
    referred = looked_up(leads.select("lead_id"), "lead_id", d.referrals, "lead_id", "referral_id", "referral_id").where("referral_id IS NOT NULL").distinct()
    named = leads.withColumns({c: F.coalesce(c, F.lit(OTHERS)) for c in ("lead_source", "channel")})
    out = named.join(kin, named["lead_id"] == kin["_lead"], "left").drop("_lead")
    out = out.join(referred, "lead_id", "left").distinct()
    out = looked_up(out, "agent_id", d.agents, "agent_id", "employee_id", "agent_employee")
    users = lookup_pairs(d.users, "user_id", "employee_id")
    for by, role in (("created_by_id", "created_by"), ("modified_by_id", "modified_by"), ("kin_created_by_id", "kin_created_by"), ("kin_created_by_id", "kin_modified_by")):
        out = with_pair(out, by, users, role)
    out = looked_up(out, "id_number", d.customers, "id_number", "customer_id", "customer_id", collation=None)
    out = looked_up(out, "lead_source", d.sources, "name", "source_id", "source_id")
    out = looked_up(out, "channel", d.channels, "name", "channel_id", "channel_id")
    own = F.when(F.col("channel") == OWN_CHANNEL, OWN_CHANNEL_ID).otherwise(F.col("channel_id"))
    return out.withColumns({"channel_id": own, "agent": F.coalesce("employee_id", "agent_employee")}).drop("agent_employee")


def _nothing(names: str, kind: str) -> list[tuple[str, str, None]]:
    return [(n, kind, None) for n in names.split()]


def leads_layout(m: DataFrame) -> DataFrame:
    c, source = F.col, F.lower("lead_source")
    return to_layout(m, [
        ("leadId", "string", c("lead_id")), ("firstName", "string", F.coalesce("first_name", "name")), ("lastName", "string", c("last_name")), ("mobilePhone", "string", c("phone")), ("idNumber", "string", c("id_number")), ("companyRegionId", "int", F.lit(1)),
        ("leadConvertedDate", "timestamp_ntz", c("converted_at")), ("paymentMethod", "string", F.coalesce("payment_method", F.lit("CASH"))), ("purchaseDate", "string", codes.mapped(c("purchase_date"), *codes.PURCHASE_DATE)),
        ("status", "string", codes.mapped(c("status"), *codes.STATUS)), ("leadStatus", "string", codes.lead_status(c("is_converted"))), ("leadCategory", "string", codes.mapped(c("category"), *codes.LEAD_CATEGORY)),
        ("referralId", "string", c("referral_id")), ("productOfInterest", "string", c("product")), ("preferredLanguage", "string", c("language")), ("agentId", "bigint", c("agent")), ("createdById", "bigint", c("agent")), ("lastUpdatedById", "bigint", c("modified_by")),
        ("throughPartnerLeadId", "string", c("lead_id")), ("isReshuffleLead", "int", F.when(c("lead_source") == "Reshuffled Leads", 1).otherwise(0)), ("createdAt", "timestamp_ntz", c("created_at")), ("updatedAt", "timestamp_ntz", c("updated_at")),
        ("phoneNumber", "string", c("phone")), ("name", "string", c("name")), ("kraPinNumber", "string", c("tax_pin")), ("source", "string", c("lead_source")), ("leadAmtCustomerId", "bigint", c("customer_id")), ("entityType", "string", F.lit("INDIVIDUAL")),
        ("customerTypeId", "bigint", c("customer_type")), ("leadChannelId", "bigint", c("channel_id")), ("referralType", "string", codes.mapped(source, *codes.REFERRAL_TYPE)), ("employeeReferralId", "bigint", F.when(source == EMPLOYEE_SOURCE, c("employee_id"))),
        ("isActive", "int", F.lit(1)), ("leadSourceId", "bigint", c("source_id")), ("lastModifiedAt", "timestamp_ntz", c("updated_at")), ("lastModifiedBy", "bigint", c("modified_by")), ("is_migrated", "int", F.lit(1)),
        *_nothing("middleName email alternatePhoneNumber companyName paymentTerms formVersion", "string"), *_nothing("sundeskUserId agent_provider_id kycId tdhId deletedBy formId archivedBy", "bigint"), *_nothing("deletedAt archivedAt", "timestamp_ntz"),
    ])


def kyc_layout(m: DataFrame, invalid: tuple = ()) -> DataFrame:
    """Identity checks; those without a reference, an id number or a date of birth go."""
    c = F.col
    found = lambda path: text.json_text(c("kyc_json"), path)
    modified = F.when(c("modified_by").isin(*invalid), c("agent")).otherwise(c("modified_by")) if invalid else c("modified_by")
    out = to_layout(m, [
        ("externalRefId", "string", text.prefixed("sf-", found("SmileJobID"))), ("leadId", "string", c("lead_id")), ("idNumber", "string", F.coalesce(found("IDNumber"), "id_number")), ("dob", "string", F.coalesce(text.cleaned(found("DOB"), "null", "not available"), "date_of_birth")),
        ("status", "string", codes.mapped(found("_status_"), *codes.KYC_STATUS)), ("companyRegionId", "int", F.lit(1)), ("meta", "string", c("kyc_json")), ("createdBy", "bigint", c("agent")), ("updatedBy", "bigint", modified), ("createdAt", "timestamp_ntz", c("created_at")),
        ("updatedAt", "timestamp_ntz", c("updated_at")), ("documentType", "string", found("IDType")), ("smileJobId", "string", found("SmileJobID")), ("resultCode", "string", found("ResultCode")), ("source", "string", found("ResultType")), ("gender", "string", c("gender")),
        ("isActive", "int", F.lit(1)), ("lastModifiedAt", "timestamp_ntz", c("updated_at")), ("lastModifiedBy", "bigint", c("modified_by")), ("is_migrated", "int", F.lit(1)),
        *_nothing("serialNumber description documentType_temp callbackJsonBlob resultText actions description2 formVersion", "string"), *_nothing("formId deletedBy archivedBy", "bigint"), *_nothing("deletedAt archivedAt", "timestamp_ntz"),
    ])
    return out.where("idNumber IS NOT NULL AND dob IS NOT NULL AND externalRefId IS NOT NULL")


def kin_layout(m: DataFrame, invalid: tuple = (), default: int = DEFAULT_USER) -> DataFrame:
    """Next of kin who have a phone number."""
    c = F.col
    user = codes.valid_user(c("kin_created_by"), c("kin_modified_by"), invalid, default)
    out = to_layout(m, [
        ("sourceSystemId", "string", F.lit(SOURCE_SYSTEM)), ("leadId", "string", c("lead_id")), ("firstName", "string", F.coalesce("kin_name", "kin_surname", F.lit(NO_NAME))), ("lastName", "string", F.coalesce("kin_surname", "kin_name", F.lit(NO_NAME))),
        ("phoneNumber", "string", c("kin_phone")), ("relationship", "string", codes.relationship(c("relation"))), ("type", "string", F.lit("NEXT_OF_KIN")), ("isActive", "int", F.lit(1)), ("createdAt", "timestamp_ntz", c("kin_created_at")), ("createdBy", "bigint", user),
        ("updatedAt", "timestamp_ntz", c("kin_modified_at")), ("updatedBy", "bigint", c("kin_modified_by")), ("is_migrated", "int", F.lit(1)), *_nothing("sourceSystem alternativePhoneNumber gender id_number_c", "string"),
    ])
    return out.where("phoneNumber IS NOT NULL")
