"""The typed contract of charge lines: casts, fallbacks, blocking rules and their diagnosis."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "1.0.0"


class Field(NamedTuple):
    name: str
    type: str = "string"
    required: bool = False
    nullable: bool = True
    allowed: tuple[str, ...] = ()


class Fallback(NamedTuple):
    """target takes source's value where it is null, source is not blank and condition equals value."""

    target: str
    source: str
    condition: str
    value: str


# The 91 fields of the contract by kind, and those that are required or not nullable.
DECIMALS = (
    "BilledCost EffectiveCost ListCost ListUnitPrice PricingQuantity ConsumedQuantity x_BilledCostInUsd x_BilledUnitPrice x_BillingExchangeRate "
    "x_EffectiveCostInUsd x_EffectiveUnitPrice ContractedCost x_ContractedCostInUsd ContractedUnitPrice x_PartnerCreditRate x_PricingBlockSize"
).split()
INTEGERS, BOOLEANS = ["x_PartnerCreditApplied"], ["x_SkuIsCreditEligible"]
DATES = ["BillingPeriodStart", "BillingPeriodEnd"]
TIMESTAMPS = ["ChargePeriodStart", "ChargePeriodEnd", "x_ServicePeriodStart", "x_ServicePeriodEnd", "x_BillingExchangeRateDate"]
STRINGS = (
    "BillingAccountId BillingAccountName BillingAccountType BillingCurrency ChargeCategory ChargeDescription ChargeFrequency CommitmentDiscountCategory "
    "CommitmentDiscountId CommitmentDiscountName CommitmentDiscountType InvoiceIssuerName PricingCategory PricingUnit ProviderName PublisherName Region "
    "ResourceId ResourceName ResourceType ServiceCategory ServiceName SkuId SkuPriceId SubAccountId SubAccountName SubAccountType Tags ConsumedUnit "
    "x_AccountName x_AccountOwnerId x_BillingAccountId x_BillingAccountName x_BillingProfileId x_BillingProfileName x_CostAllocationRuleName x_CostCenter "
    "x_CustomerId x_CustomerName x_InvoiceId x_InvoiceIssuerId x_InvoiceSectionId x_InvoiceSectionName x_PricingCurrency x_PricingSubcategory "
    "x_PricingUnitDescription x_PublisherCategory x_PublisherId x_ResellerId x_ResellerName x_ResourceGroupName x_ResourceType x_SkuDescription "
    "x_SkuDetails x_SkuMeterCategory x_SkuMeterId x_SkuMeterName x_SkuMeterSubcategory x_SkuOfferId x_SkuOrderId x_SkuOrderName x_SkuPartNumber "
    "x_SkuRegion x_SkuServiceFamily x_SkuTerm x_SkuTier"
).split()
REQUIRED = (
    "BilledCost BillingCurrency BillingPeriodStart BillingPeriodEnd ChargePeriodStart ChargePeriodEnd PricingCategory ProviderName ServiceName"
).split()
NOT_NULL = [*REQUIRED, "EffectiveCost", "ListCost"]
ALLOWED = {"BillingCurrency": ("EUR",), "ProviderName": ("Microsoft",), "PricingCategory": ("On-Demand", "Commitment-Based", "Dynamic")}
FALLBACKS = (Fallback("ServiceName", "ChargeDescription", "ChargeCategory", "Adjustment"),)


def fields() -> list[Field]:
    kinds = {"decimal(38,18)": DECIMALS, "long": INTEGERS, "boolean": BOOLEANS, "date": DATES, "timestamp": TIMESTAMPS, "string": STRINGS}
    return [Field(n, k, n in REQUIRED, n not in NOT_NULL, ALLOWED.get(n, ())) for k, names in kinds.items() for n in names]


class ContractError(ValueError):
    pass


def conform(df: DataFrame, contract: list[Field] | None = None, fallbacks: tuple[Fallback, ...] = FALLBACKS) -> DataFrame:
    """df with every field in its type; missing optional fields are null, further columns stay. One projection."""
    contract = contract or fields()
    missing = sorted(f.name for f in contract if f.required and f.name not in df.columns)
    if missing:
        raise ContractError(f"required columns are missing: {missing}")
    typed = {f.name: (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.type) for f in contract}
    for rule in fallbacks:
        fits = typed[rule.target].isNull() & (F.trim(typed[rule.source]) != "") & (typed[rule.condition] == rule.value)
        typed[rule.target] = F.when(fits, typed[rule.source]).otherwise(typed[rule.target])
    others = [F.col(c) for c in df.columns if c not in typed]
    return df.select(*(c.alias(n) for n, c in typed.items()), *others)


def rules(contract: list[Field] | None = None, currency: str = "EUR", provider: str = "Microsoft") -> dict[str, Column]:
    """Blocking rules by name; true is a violation. A null is one only for the not-null rules."""
    contract = contract or fields()
    found = {f"not_null_{f.name}": F.col(f.name).isNull() for f in contract if not f.nullable}
    found |= {f"allowed_values_{f.name}": F.col(f.name).isNotNull() & ~F.col(f.name).isin(*f.allowed) for f in contract if f.allowed}
    return found | {
        "expected_BillingCurrency": F.col("BillingCurrency") != currency,
        "expected_ProviderName": F.col("ProviderName") != provider,
        "ordered_ChargePeriod": F.col("ChargePeriodStart") > F.col("ChargePeriodEnd"),
        "ordered_BillingPeriod": F.col("BillingPeriodStart") > F.col("BillingPeriodEnd"),
    }


def rule_names(contract: list[Field] | None = None) -> list[str]:
    """Names of rules() in its order; needs no session."""
    contract = contract or fields()
    found = [f"not_null_{f.name}" for f in contract if not f.nullable] + [f"allowed_values_{f.name}" for f in contract if f.allowed]
    return [*found, "expected_BillingCurrency", "expected_ProviderName", "ordered_ChargePeriod", "ordered_BillingPeriod"]


def count_violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with the violations of each rule, in one scan."""
    return df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()))


def fingerprint(columns: list[str]) -> Column:
    """SHA-256 of the row as JSON, columns by name, nulls kept."""
    return F.sha2(F.to_json(F.struct(*(F.col(c) for c in sorted(columns))), {"ignoreNullFields": "false"}), 256)


def diagnose(df: DataFrame, checks: dict[str, Column], shown: list[str], files: int = 3, rows: int = 2, width: int = 160) -> DataFrame:
    """For each broken rule the files with most violations and in each the first rows by fingerprint, values cut.

    Violations are one row per rule and line; both limits keep a bounded number per rule.
    """
    names = list(checks)
    broken = F.filter(
        F.array(*(F.when(F.coalesce(checks[n], F.lit(False)), F.lit(n)) for n in names)), lambda n: n.isNotNull()
    )
    lines = df.select(
        F.explode(broken).alias("rule"),
        F.coalesce(F.col("_source_file"), F.lit("unavailable")).alias("file"),
        fingerprint([c for c in df.columns if not c.startswith("_")]).alias("fingerprint"),
        *(F.substring(F.col(c).cast("string"), 1, width).alias(c) for c in shown),
    )
    from pyspark.sql import Window as W

    counts = lines.groupBy("rule", "file").agg(F.count("*").alias("violations"))
    top = counts.withColumn("place", F.row_number().over(W.partitionBy("rule").orderBy(F.desc("violations"), "file"))).where(F.col("place") <= files)
    ranked = lines.withColumn("sample", F.row_number().over(W.partitionBy("rule", "file").orderBy("fingerprint"))).where(F.col("sample") <= rows)
    return ranked.join(top.select("rule", "file", "violations"), ["rule", "file"])


def enforce(df: DataFrame, checks: dict[str, Column] | None = None) -> DataFrame:
    """df if no rule is broken; else an error that names the rules and their counts. All or nothing."""
    counts = count_violations(df, checks or rules()).first().asDict()
    broken = {n: c for n, c in counts.items() if c}
    if broken:
        raise ContractError("contract violations, nothing was written: " + ", ".join(f"{n}={c}" for n, c in broken.items()))
    return df


def canonical(df: DataFrame, version: str = VERSION) -> DataFrame:
    """df with billing_month and _contract_version."""
    return df.withColumns({"billing_month": F.date_format("BillingPeriodStart", "yyyy-MM"), "_contract_version": F.lit(version)})
