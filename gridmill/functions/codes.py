"""Code mappings between the lead system and the sales service."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code mappings, each with what any other value becomes.
PURCHASE_DATE = ({"Now": "NOW"}, "LATER")
STATUS = ({"New": "NEW", "Converted": "CONVERTED", "Qualified": "QUALIFIED"}, "NEW")
LEAD_CATEGORY = ({"Hot": "HOT", "Cold": "COLD", "Warm": "WARM"}, "WARM")
REFERRAL_TYPE = ({"engineer referral": "EMPLOYEE", "ipos": "IPOS", "refer & earn": "CUSTOMER", "refer and earn": "CUSTOMER"}, None)
KYC_STATUS = ({"COMPLETED": "SUCCESS", "FAILED": "FAILED"}, "PENDING")
RELATIONSHIP = {"Child (son/daughter)": "Other", "Parent": "Other", "Grandparents": "Other", "Wife": "Spouse", "Husband": "Spouse"}
# What validations allow.
PAYMENT_METHODS = ("CASH", "PAYG", "CREDIT")
STATUSES = ("NEW", "IN_PROGRESS", "QUALIFIED", "CONVERTED", "ARCHIVED")
LEAD_STATUSES = ("LEAD_CREATION", "TDH_SUBMISSION", "KYC_COMPLETED", "CDS1", "QUALIFIED", "CONVERTED", "DEPOSIT", "CDS2")
PURCHASE_DATES = ("NOW", "TWO_WEEKS", "TWO_MONTHS", "LATER")
ENTITY_TYPES = ("INDIVIDUAL", "COMPANY")
DOCUMENT_TYPES = ("NATIONAL_ID", "NATIONAL_ID_NO_PHOTO", "ALIEN_CARD", "PASSPORT", "KRA_PIN", "TAX_INFORMATION", "GHANA_CARD", "GHANA_CARD_NO_PHOTO", "VOTER_ID")


def mapped(x: Column, codes: dict[str, str], other: str | Column | None = None) -> Column:
    """The code of ``x``, by a literal map; ``other`` where it has none."""
    table = F.create_map(*[F.lit(v) for pair in codes.items() for v in pair])
    return F.coalesce(F.try_element_at(table, x), other if isinstance(other, Column) else F.lit(other))


def lead_status(is_converted: Column) -> Column:
    return F.when(is_converted == 0, "LEAD_CREATION").when(is_converted == 1, "CONVERTED")


def relationship(x: Column) -> Column:
    return F.when(x.isNull(), "Other").otherwise(mapped(x, RELATIONSHIP, x))


def valid_user(first: Column, second: Column, invalid: tuple, default: int) -> Column:
    """The first user unless null, else the second; users that are marked invalid and
    missing ones become the default."""
    return F.when(first.isin(*invalid), default).otherwise(F.coalesce(first, second, F.lit(default))) if invalid else F.coalesce(first, second, F.lit(default))


def persona(income: Column, acreage: Column, source: Column, water: Column) -> Column:
    # A missing source of income counts as other than farming.
    farming = F.coalesce(source == "farming", F.lit(False))
    return (
        F.when(income == "high", "Business Customer")
        .when((acreage == "2 or less") & ~farming, "Youth Side Hustle")
        .when((acreage == "2 or less") & farming, "Youth Primary Customer")
        .when((acreage == "more than 2") & water.isin("well", "rain harvesting"), "Older Irrigated/Seasonal")
        .when((acreage == "more than 2") & (water == "rainfed"), "Older Rainfed/Seasonal")
        .otherwise("Unclassified")
    )
