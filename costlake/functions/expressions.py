"""Column functions of the charge-line model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# Names that stand for no cost center, and regions of the allocation policy.
NO_CENTER = ("", "unknown", "unallocated", "unallocated costs", "no cost center assigned")
EUROPE_REGIONS = ("west europe", "north europe", "france central", "sweden central", "uk south")
POLICY_VERSION = "REGION_FALLBACK_V1"

#: Default keys of the tags that describe an application, by the columns they become; plans take another map as a parameter.
APPLICATION_TAGS = {
    "application_code": "application-code",
    "application_name": "application-name",
    "application_owner_id": "application-owner-id",
    "application_owner_email": "application-owner-email",
    "application_business_owner": "application-business-owner",
}


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(F.trim(F.col(c) if isinstance(c, str) else c), F.lit(""))


def known(*columns: str) -> Column:
    """The first of the columns that is not blank, else 'Unknown'."""
    return F.coalesce(*(blank_to_null(c) for c in columns), F.lit(UNKNOWN))


def surrogate_key(tag: str, *parts: str | Column) -> Column:
    """SHA-256 of the tag and parts joined by ||; parts must not be null, as nulls would be skipped."""
    return F.sha2(F.concat_ws("||", F.lit(tag), *(F.col(p) if isinstance(p, str) else p for p in parts)), 256)


def date_key(c: str) -> Column:
    return F.date_format(F.to_date(F.col(c)), "yyyyMMdd").cast("long")


def month_of(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM")


def tag_map(c: str = "Tags") -> Column:
    return F.from_json(F.col(c), "map<string,string>")


def normalized_unit(c: str) -> Column:
    """Null for a blank unit or one called unknown."""
    return F.when(F.lower(F.trim(F.col(c))) == "unknown", None).otherwise(blank_to_null(c))


def cost_component() -> Column:
    """The one part of the effective cost that a charge line belongs to."""
    usage = F.col("ChargeCategory") == "Usage"
    commitment = usage & (F.col("PricingCategory") == "Commitment-Based")
    return (
        F.when(F.col("ChargeCategory") == "Adjustment", "adjustment")
        .when(commitment & (F.col("CommitmentDiscountType") == "Reservation"), "reservation")
        .when(commitment & (F.col("CommitmentDiscountType") == "Savings Plan"), "savings_plan")
        .when(usage & (F.col("PricingCategory") == "On-Demand"), "usage_on_demand")
        .when(usage & (F.col("PricingCategory") == "Dynamic"), "usage_dynamic")
        .otherwise("other")
    )


def allocation_method(center: str, region: str, corporate_regions: tuple[str, ...] = ()) -> Column:
    """How a line's cost center is found: from the source, else by its region. Without corporate regions none matches."""
    by_region = F.lower(F.trim(F.coalesce(F.col(region), F.lit(""))))
    return (
        F.when(~F.lower(F.trim(F.coalesce(F.col(center), F.lit("")))).isin(*NO_CENTER), "SOURCE")
        .when(by_region.isin(*EUROPE_REGIONS), "REGION_EUROPE")
        .when(by_region == "global", "GLOBAL_CORPORATE")
        .when(by_region.isin(*(r.lower() for r in corporate_regions)) if corporate_regions else F.lit(False), "REGION_CORPORATE")
        .otherwise("UNALLOCATED")
    )


def allocated_center(method: str, center: str) -> Column:
    m = F.col(method)
    return (
        F.when(m == "SOURCE", F.trim(F.col(center)))
        .when(m == "REGION_EUROPE", "CostCenter_Europe")
        .when(m.isin("GLOBAL_CORPORATE", "REGION_CORPORATE"), "CostCenter_Corporate")
        .otherwise("Unallocated Costs")
    )


def displayed_center(center: str) -> Column:
    """Names without meaning become one label."""
    c = F.col(center)
    return F.when(c.isNull() | F.lower(F.trim(c)).isin(*NO_CENTER), "Unallocated Costs").otherwise(F.trim(c))


def ratio(part: Column, whole: Column, when_zero: float | None = None) -> Column:
    """part / whole in double precision; when_zero if the whole is null or 0."""
    whole = whole.cast("double")
    return F.when(whole.isNull() | (whole == 0), F.lit(when_zero).cast("double")).otherwise(part.cast("double") / whole)


def sum_or_null(c: Column) -> Column:
    """Sum that is null if any member is null: an unknown amount is not zero."""
    return F.when(F.count_if(c.isNull()) > 0, None).otherwise(F.sum(c))


def fits_exactly(c: str, kind: str = "decimal(38,18)") -> Column:
    """Whether the text of a number survives a cast to kind unchanged; null if it is null."""
    exact = F.col(c).cast("string").try_cast(kind)
    wide = F.col(c).cast("string").try_cast("decimal(38,28)")
    return F.when(F.col(c).isNull(), None).otherwise(exact.isNotNull() & F.coalesce(exact.cast("decimal(38,28)") == wide, F.lit(False)))
