"""The star schema: ten dimensions, a bridge and the fact table, with hashed keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import (
    APPLICATION_TAGS,
    POLICY_VERSION,
    UNKNOWN,
    allocated_center,
    allocation_method,
    blank_to_null,
    date_key,
    known,
    surrogate_key,
    tag_map,
)

# Attributes of each dimension in the order of its key, with their source columns.
SERVICE = {
    "service_name": "ServiceName",
    "service_category": "ServiceCategory",
    "provider_name": "ProviderName",
    "publisher_id": "x_PublisherId",
    "publisher_name": "PublisherName",
    "publisher_category": "x_PublisherCategory",
    "reseller_id": "x_ResellerId",
    "reseller_name": "x_ResellerName",
}
SKU = {
    "sku_id": "SkuId",
    "sku_price_id": "SkuPriceId",
    "sku_description": "x_SkuDescription",
    "sku_details": "x_SkuDetails",
    "meter_id": "x_SkuMeterId",
    "meter_name": "x_SkuMeterName",
    "meter_category": "x_SkuMeterCategory",
    "meter_subcategory": "x_SkuMeterSubcategory",
    "offer_id": "x_SkuOfferId",
    "order_id": "x_SkuOrderId",
    "order_name": "x_SkuOrderName",
    "part_number": "x_SkuPartNumber",
    "sku_region": "x_SkuRegion",
    "sku_service_family": "x_SkuServiceFamily",
    "sku_term": "x_SkuTerm",
    "sku_tier": "x_SkuTier",
}
COMMITMENT = {
    "commitment_discount_id": "CommitmentDiscountId",
    "commitment_discount_name": "CommitmentDiscountName",
    "commitment_discount_category": "CommitmentDiscountCategory",
    "commitment_discount_type": "CommitmentDiscountType",
}
PRICING = {
    "pricing_category": "PricingCategory",
    "pricing_subcategory": "x_PricingSubcategory",
    "pricing_unit": "PricingUnit",
    "pricing_unit_description": "x_PricingUnitDescription",
}
SCOPE = {
    "billing_account_id": "BillingAccountId",
    "billing_account_name": "BillingAccountName",
    "billing_account_type": "BillingAccountType",
    "sub_account_id": "SubAccountId",
    "sub_account_name": "SubAccountName",
    "sub_account_type": "SubAccountType",
    "account_name": "x_AccountName",
    "account_owner_id": "x_AccountOwnerId",
    "billing_profile_id": "x_BillingProfileId",
    "billing_profile_name": "x_BillingProfileName",
    "invoice_section_id": "x_InvoiceSectionId",
    "invoice_section_name": "x_InvoiceSectionName",
    "customer_id": "x_CustomerId",
    "customer_name": "x_CustomerName",
    "cost_center": "x_CostCenter",
    "cost_allocation_rule_name": "x_CostAllocationRuleName",
}
RESOURCE = {
    "resource_id": "ResourceId",
    "resource_name": "ResourceName",
    "resource_type": "ResourceType",
    "provider_resource_type": "x_ResourceType",
    "resource_group_name": "x_ResourceGroupName",
}
DATE_COLUMNS = (
    "BillingPeriodStart BillingPeriodEnd ChargePeriodStart ChargePeriodEnd x_ServicePeriodStart x_ServicePeriodEnd x_BillingExchangeRateDate"
).split()


def _attribute(name: str, source: str) -> Column:
    """Free text may be empty; every other attribute is 'Unknown' when blank."""
    return F.coalesce(F.col(source), F.lit("")) if name in ("sku_description", "sku_details") else known(source)


def _attributes(mapping: dict[str, str]) -> dict[str, Column]:
    return {n: _attribute(n, s) for n, s in mapping.items()}


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))


# Parts of each surrogate key by name; never null. Parts that are attributes have their names.
def service_parts() -> dict[str, Column]:
    return _attributes(SERVICE)


def sku_parts() -> dict[str, Column]:
    return _attributes(SKU) | {"_eligible": _text("x_SkuIsCreditEligible")}


def location_parts() -> dict[str, Column]:
    return {"region": known("Region"), "sku_region": known("x_SkuRegion")}


def charge_type_parts() -> dict[str, Column]:
    return {"charge_category": known("ChargeCategory"), "charge_frequency": known("ChargeFrequency")}


def scope_parts() -> dict[str, Column]:
    return {n: known(SCOPE[n]) for n in ("billing_account_id", "sub_account_id", "billing_profile_id")}


def resource_parts() -> dict[str, Column]:
    return {"_provider": known("ProviderName"), "resource_id": known("ResourceId")}


def service_key() -> Column:
    return surrogate_key("service", *service_parts().values())


def sku_key() -> Column:
    return surrogate_key("sku", *sku_parts().values())


def location_key() -> Column:
    region, sku_region = location_parts().values()
    return surrogate_key("location", region, F.lit(UNKNOWN), sku_region)


def commitment_key() -> Column:
    return surrogate_key("commitment", *_attributes(COMMITMENT).values())


def pricing_key() -> Column:
    return surrogate_key("pricing", *_attributes(PRICING).values(), known("x_PricingCurrency", "BillingCurrency"), _text("x_PartnerCreditApplied"))


def charge_type_key() -> Column:
    """The constant keeps keys of an older model valid."""
    category, frequency = charge_type_parts().values()
    return surrogate_key("charge_type", category, F.lit(UNKNOWN), frequency)


def scope_key() -> Column:
    return surrogate_key("billing_scope", *scope_parts().values())


def resource_key_of(provider: Column, resource: Column) -> Column:
    return surrogate_key("resource", provider, resource)


def resource_key() -> Column:
    return resource_key_of(*resource_parts().values())


PARTS = {
    "service_sk": service_parts,
    "sku_sk": sku_parts,
    "location_sk": location_parts,
    "charge_type_sk": charge_type_parts,
    "billing_scope_sk": scope_parts,
    "resource_sk": resource_parts,
}


def key_of_parts(key: str) -> Column:
    """A key of a resource, its location or its billing scope from columns that hold its parts."""
    made = {
        "resource_sk": lambda: resource_key_of(F.col("_provider"), F.col("resource_id")),
        "location_sk": lambda: surrogate_key("location", "region", F.lit(UNKNOWN), "sku_region"),
        "billing_scope_sk": lambda: surrogate_key("billing_scope", "billing_account_id", "sub_account_id", "billing_profile_id"),
    }
    return made[key]()


def event_time() -> Column:
    return F.coalesce(F.col("ChargePeriodStart"), F.col("BillingPeriodStart").cast("timestamp"))


def dim_date(lines: DataFrame) -> DataFrame:
    day = F.col("date")
    return (
        lines.select(F.explode(F.array(*(F.to_date(c) for c in DATE_COLUMNS))).alias("date"))
        .where("date is not null")
        .distinct()
        .select(
            date_key("date").alias("date_sk"),
            "date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.weekofyear(day).alias("week"),
            F.dayofmonth(day).alias("day"),
            (F.weekday(day) + 1).alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            (day == F.trunc(day, "month")).alias("is_month_start"),
            (day == F.last_day(day)).alias("is_month_end"),
        )
    )


def _latest(rows: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Type 1: for each key the row of the latest event, and the first event as valid_from.

    A hash aggregate leaves one row for each version of a key, with its first and last
    event; the newest of the few versions follows, ties broken by the attributes.
    """
    versions = rows.groupBy(key, "_ingested_at", *attributes).agg(F.max("event_time").alias("event_time"), F.min("event_time").alias("_first"))
    newest = F.max(F.struct("event_time", "_ingested_at", *attributes)).alias("_newest")
    return versions.groupBy(key).agg(newest, F.min("_first").alias("valid_from")).select(
        key,
        *(F.col(f"_newest.{a}").alias(a) for a in attributes),
        "valid_from",
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def dim_billing_scope(lines: DataFrame) -> DataFrame:
    rows = lines.select(scope_key().alias("billing_scope_sk"), *(c.alias(n) for n, c in _attributes(SCOPE).items()), event_time().alias("event_time"), "_ingested_at")
    return _latest(rows, "billing_scope_sk", list(SCOPE))


def _application(tags: str, application_tags: dict[str, str]) -> dict[str, Column]:
    """The application's attributes out of a column of parsed tags."""
    return {n: F.coalesce(blank_to_null(F.element_at(tags, F.lit(k))), F.lit(UNKNOWN)) for n, k in application_tags.items()}


def dim_resource(lines: DataFrame, application_tags: dict[str, str] = APPLICATION_TAGS) -> DataFrame:
    tagged = lines.withColumn("_tags", tag_map())
    rows = tagged.select(
        resource_key().alias("resource_sk"),
        *(c.alias(n) for n, c in _attributes(RESOURCE).items()),
        F.coalesce("Tags", F.lit("")).alias("tags_raw"),
        *(c.alias(n) for n, c in _application("_tags", application_tags).items()),
        event_time().alias("event_time"),
        "_ingested_at",
    )
    return _latest(rows, "resource_sk", [*RESOURCE, "tags_raw", *application_tags])


def newest(lines: DataFrame, key: str, wanted: list[str], application_tags: dict[str, str] = APPLICATION_TAGS) -> DataFrame:
    """The parts of a Type 1 key, resource_sk or billing_scope_sk, with some attributes as its dimension has them.

    Versions tell rows apart by the attributes up to the last one wanted: the first fields of
    the largest row are the largest first fields. Those after it, such as tags, would multiply
    the versions. Application attributes follow from tags_raw.
    """
    parts = PARTS[key]()
    attributes = _attributes(SCOPE) if key == "billing_scope_sk" else _attributes(RESOURCE) | {"tags_raw": F.coalesce("Tags", F.lit(""))}
    order = list(attributes)
    last = max(order.index("tags_raw" if n in application_tags else n) for n in wanted)
    told = [n for n in order[: last + 1] if n not in parts]
    columns = parts | {n: attributes[n] for n in told}
    rows = lines.select(*(c.alias(n) for n, c in columns.items()), event_time().alias("event_time"), "_ingested_at")
    versions = rows.groupBy(*parts, "_ingested_at", *told).agg(F.max("event_time").alias("event_time"))
    found = versions.groupBy(*parts).agg(F.max(F.struct("event_time", "_ingested_at", *told)).alias("_newest")).select(*parts, *(F.col(f"_newest.{n}").alias(n) for n in told))
    if any(n in application_tags for n in wanted):
        found = found.withColumn("_tags", tag_map("tags_raw")).withColumns(_application("_tags", application_tags))
    return found.select(*parts, *(n for n in wanted if n not in parts))


def _distinct(lines: DataFrame, key: str, value: Column, attributes: dict[str, Column]) -> DataFrame:
    return lines.select(value.alias(key), *(c.alias(n) for n, c in attributes.items())).distinct()


def dim_service(lines: DataFrame) -> DataFrame:
    return _distinct(lines, "service_sk", service_key(), _attributes(SERVICE))


def dim_sku(lines: DataFrame) -> DataFrame:
    return _distinct(lines, "sku_sk", sku_key(), _attributes(SKU) | {"sku_is_credit_eligible": F.col("x_SkuIsCreditEligible")})


def dim_location(lines: DataFrame) -> DataFrame:
    return _distinct(
        lines, "location_sk", location_key(), {"region": known("Region"), "availability_zone": F.lit(UNKNOWN), "sku_region": known("x_SkuRegion")}
    )


def dim_commitment_discount(lines: DataFrame) -> DataFrame:
    return _distinct(lines, "commitment_sk", commitment_key(), _attributes(COMMITMENT))


def dim_pricing(lines: DataFrame) -> DataFrame:
    more = {"pricing_currency": known("x_PricingCurrency", "BillingCurrency"), "partner_credit_applied": F.col("x_PartnerCreditApplied")}
    return _distinct(lines, "pricing_sk", pricing_key(), _attributes(PRICING) | more)


def dim_charge_type(lines: DataFrame) -> DataFrame:
    return _distinct(
        lines, "charge_type_sk", charge_type_key(), {"charge_category": known("ChargeCategory"), "charge_frequency": known("ChargeFrequency")}
    )


def _tags(lines: DataFrame, *columns: Column) -> DataFrame:
    """A row for each tag whose trimmed key and value are not empty."""
    exploded = lines.where(blank_to_null("Tags").isNotNull()).select(*columns, F.explode(tag_map()).alias("_key", "_value"))
    kept = exploded.withColumns({"tag_key": blank_to_null("_key"), "tag_value": blank_to_null("_value")}).where("tag_key is not null and tag_value is not null")
    return kept.drop("_key", "_value")


def dim_tag(lines: DataFrame) -> DataFrame:
    return _tags(lines).distinct().select(surrogate_key("tag", "tag_key", "tag_value").alias("tag_sk"), "tag_key", "tag_value")


def bridge_resource_tag(lines: DataFrame) -> DataFrame:
    rows = _tags(lines, resource_key().alias("resource_sk"), event_time().alias("_at"))
    return rows.groupBy("resource_sk", surrogate_key("tag", "tag_key", "tag_value").alias("tag_sk")).agg(
        F.min("_at").alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to")
    )


#: Repeated lines that are looked up by broadcast at most.
FEW_REPEATED = 100_000


def _line_hash(lines: DataFrame, content: list[str]) -> Column:
    """64 bits of file and content; equal lines have equal hashes. Times count to the millisecond, as the fingerprint writes them."""

    def part(c: str, kind: str) -> Column:
        if kind.startswith("timestamp"):
            return F.date_trunc("millisecond", c)
        return F.to_json(F.struct(c)) if kind.startswith(("map", "array", "struct", "double", "float", "variant")) else F.col(c)

    return F.xxhash64("_source_file", *(part(c, k) for c, k in lines.dtypes if c in content))


def identified_lines(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """lines with line_key: the row's content hash and its number among equal rows of the file.

    The same in every replay, whatever the order of rows. Hashes are counted first, which
    moves 64 bits a line: where none occurs twice, every line has number 1 and stays where it
    is read; up to FEW_REPEATED hashes that do are broadcast, and only their lines meet in a
    window; more of them send all lines through it. by: lines are brought together by these
    columns before they get keys, which take more bytes than all else.
    """
    from ..operators.contract import fingerprint

    spark = lines.sparkSession
    content = [c for c in lines.columns if not c.startswith("_")]
    hashed = lines.withColumn("_hash", _line_hash(lines, content))
    twice = hashed.groupBy("_hash").count().where("count > 1").select("_hash").limit(FEW_REPEATED + 1).collect()
    key = lambda number: F.concat_ws(":", fingerprint(content), number)
    number = F.row_number().over(W.partitionBy("_source_file", "_content").orderBy(F.lit(1))).cast("string")
    windowed = lambda df: df.withColumn("_content", fingerprint(content)).withColumn("line_key", F.concat_ws(":", "_content", number)).drop("_content", "_hash")
    dealt = lambda df: df.hint("rebalance", *by) if by else df
    if len(twice) > FEW_REPEATED:
        return dealt(windowed(hashed))
    if not twice:
        return dealt(lines).withColumn("line_key", key(F.lit("1")))
    repeated = F.broadcast(spark.createDataFrame(twice, "_hash long"))
    once = dealt(hashed.join(repeated, "_hash", "left_anti").select(*lines.columns)).withColumn("line_key", key(F.lit("1")))
    return once.unionByName(dealt(windowed(hashed.join(repeated, "_hash", "left_semi").select(*lines.columns, "_hash"))))


def fact_cost_usage(lines: DataFrame, focus_version: str = "1.0", keys: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """The facts of lines, brought together by some columns. Their keys count equal lines first (identified_lines); without keys nothing runs until the frame is used."""
    numbered, own = lines, []
    if keys:
        numbered = identified_lines(lines, by)
        line_parts = [F.coalesce("_source_file", F.lit(UNKNOWN)), F.col("line_key")]
        own = [surrogate_key("fact", *line_parts).alias("cost_usage_sk"), surrogate_key("charge", *line_parts).alias("charge_id")]
    on_demand = F.col("PricingCategory") == "On-Demand"
    return numbered.select(
        *own,
        "billing_month",
        scope_key().alias("billing_scope_sk"),
        resource_key().alias("resource_sk"),
        service_key().alias("service_sk"),
        sku_key().alias("sku_sk"),
        location_key().alias("location_sk"),
        pricing_key().alias("pricing_sk"),
        commitment_key().alias("commitment_sk"),
        charge_type_key().alias("charge_type_sk"),
        *(
            date_key(source).alias(f"{name}_date_sk")
            for name, source in zip(
                ("billing_period_start", "billing_period_end", "charge_period_start", "charge_period_end", "service_period_start", "service_period_end", "exchange_rate"),
                DATE_COLUMNS,
            )
        ),
        F.col("BilledCost").alias("billed_cost"),
        F.col("EffectiveCost").alias("effective_cost"),
        F.col("ListCost").alias("list_cost"),
        F.col("ListUnitPrice").alias("list_unit_price"),
        F.col("x_BilledCostInUsd").alias("billed_cost_usd"),
        F.col("x_EffectiveCostInUsd").alias("effective_cost_usd"),
        F.when(on_demand, F.col("ListCost")).alias("on_demand_cost"),
        F.when(on_demand, F.col("x_BilledCostInUsd")).alias("on_demand_cost_usd"),
        F.col("x_BilledUnitPrice").alias("billed_unit_price"),
        F.col("x_EffectiveUnitPrice").alias("effective_unit_price"),
        F.when(on_demand, F.col("ListUnitPrice")).alias("on_demand_unit_price"),
        F.col("ConsumedQuantity").alias("usage_quantity"),
        known("ConsumedUnit").alias("usage_unit"),
        F.col("PricingQuantity").alias("pricing_quantity"),
        F.col("x_PricingBlockSize").alias("pricing_block_size"),
        F.col("x_PartnerCreditRate").alias("partner_credit_rate"),
        F.col("x_BillingExchangeRate").alias("billing_exchange_rate"),
        F.coalesce("ChargeDescription", F.lit("")).alias("charge_description"),
        F.col("BillingCurrency").alias("billing_currency"),
        F.col("_ingested_at").alias("ingestion_timestamp"),
        F.col("ProviderName").alias("source_system"),
        F.lit(focus_version).alias("focus_version"),
        F.col("_contract_version").alias("contract_version"),
        F.col("_ingestion_run_id").alias("batch_id"),
    )


def cost_allocation(lines: DataFrame, corporate_regions: tuple[str, ...] = ()) -> DataFrame:
    """Every line with how and where its cost is allocated."""
    return (
        lines.withColumn("cost_center_source", F.col("x_CostCenter"))
        .withColumn("allocation_method", allocation_method("x_CostCenter", "Region", corporate_regions))
        .withColumns({"cost_center_allocated": allocated_center("allocation_method", "x_CostCenter"), "allocation_policy_version": F.lit(POLICY_VERSION)})
    )


DIMENSIONS = {
    "dim_date": dim_date,
    "dim_billing_scope": dim_billing_scope,
    "dim_resource": dim_resource,
    "dim_service": dim_service,
    "dim_sku": dim_sku,
    "dim_location": dim_location,
    "dim_commitment_discount": dim_commitment_discount,
    "dim_pricing": dim_pricing,
    "dim_charge_type": dim_charge_type,
    "dim_tag": dim_tag,
    "bridge_resource_tag": bridge_resource_tag,
}
