"""Queries of the star schema, the marts and the serving reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import APPLICATION_TAGS
from ..operators.contract import VERSION
from ..plans import gold, marts, serving
from .registry import lines, query, star

M = "1998-03"


def _gold(name: str):
    return lambda spark, d: gold.DIMENSIONS[name](lines(spark, d))


query(
    "gld1",
    """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, CAST(d AS VARCHAR) AS date, CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
    CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name, CAST(weekofyear(d) AS BIGINT) AS week, CAST(day(d) AS BIGINT) AS day,
    CAST(isodow(d) AS BIGINT) AS day_of_week, dayname(d) AS day_name, d = CAST(date_trunc('month', d) AS DATE) AS is_month_start, d = last_day(d) AS is_month_end
    FROM (SELECT DISTINCT CAST(unnest([BillingPeriodStart, BillingPeriodEnd, CAST(ChargePeriodStart AS DATE), CAST(ChargePeriodEnd AS DATE)]) AS DATE) AS d FROM charges)""",
)(_gold("dim_date"))

_UNKNOWN = lambda names: ", ".join(f"'Unknown' AS {n}" for n in names)
_FILLED = ("billing_account_id", "sub_account_id", "cost_center")
query(
    "gld2",
    f"""SELECT sha256('billing_scope||' || BillingAccountId || '||' || SubAccountId || '||Unknown') AS billing_scope_sk, BillingAccountId AS billing_account_id,
    SubAccountId AS sub_account_id, coalesce(nullif(trim(x_CostCenter), ''), 'Unknown') AS cost_center, {_UNKNOWN(n for n in gold.SCOPE if n not in _FILLED)},
    CAST(min(ChargePeriodStart) AS VARCHAR) AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current FROM charges GROUP BY ALL""",
)(_gold("dim_billing_scope"))
query(
    "gld3",
    f"""SELECT sha256('resource||Microsoft||' || ResourceId) AS resource_sk, ResourceId AS resource_id, x_ResourceGroupName AS resource_group_name,
    {_UNKNOWN(n for n in gold.RESOURCE if n not in ("resource_id", "resource_group_name"))}, arg_max(Tags, (ChargePeriodStart, Tags)) AS tags_raw,
    arg_max(application_code, (ChargePeriodStart, Tags)) AS application_code, {_UNKNOWN(n for n in APPLICATION_TAGS if n != "application_code")},
    CAST(min(ChargePeriodStart) AS VARCHAR) AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current FROM charges GROUP BY ResourceId, x_ResourceGroupName""",
)(_gold("dim_resource"))
query(
    "gld4",
    """SELECT DISTINCT sha256('service||' || ServiceName || '||' || ServiceCategory || '||Microsoft' || repeat('||Unknown', 5)) AS service_sk,
    ServiceName AS service_name, ServiceCategory AS service_category, 'Microsoft' AS provider_name, 'Unknown' AS publisher_id, 'Unknown' AS publisher_name,
    'Unknown' AS publisher_category, 'Unknown' AS reseller_id, 'Unknown' AS reseller_name FROM charges""",
)(_gold("dim_service"))
query(
    "gld5",
    f"""SELECT DISTINCT sha256('sku||' || SkuId || '||Unknown||||' || repeat('||Unknown', 13)) AS sku_sk, SkuId AS sku_id, '' AS sku_description, '' AS sku_details,
    {_UNKNOWN(n for n in gold.SKU if n not in ("sku_id", "sku_description", "sku_details"))}, CAST(NULL AS BOOLEAN) AS sku_is_credit_eligible FROM charges""",
)(_gold("dim_sku"))
query(
    "gld6",
    """SELECT DISTINCT sha256('location||' || coalesce(nullif(trim(Region), ''), 'Unknown') || '||Unknown||Unknown') AS location_sk,
    coalesce(nullif(trim(Region), ''), 'Unknown') AS region, 'Unknown' AS availability_zone, 'Unknown' AS sku_region FROM charges""",
)(_gold("dim_location"))
query(
    "gld7",
    """SELECT DISTINCT sha256('commitment||Unknown||Unknown||Unknown||' || coalesce(CommitmentDiscountType, 'Unknown')) AS commitment_sk,
    'Unknown' AS commitment_discount_id, 'Unknown' AS commitment_discount_name, 'Unknown' AS commitment_discount_category,
    coalesce(CommitmentDiscountType, 'Unknown') AS commitment_discount_type FROM charges""",
)(_gold("dim_commitment_discount"))
query(
    "gld8",
    """SELECT DISTINCT sha256('pricing||' || PricingCategory || '||Unknown||Unknown||Unknown||EUR||Unknown') AS pricing_sk, PricingCategory AS pricing_category,
    'Unknown' AS pricing_subcategory, 'Unknown' AS pricing_unit, 'Unknown' AS pricing_unit_description, 'EUR' AS pricing_currency,
    CAST(NULL AS BIGINT) AS partner_credit_applied FROM charges""",
)(_gold("dim_pricing"))
query(
    "gld9",
    """SELECT DISTINCT sha256('charge_type||' || ChargeCategory || '||Unknown||' || ChargeFrequency) AS charge_type_sk, ChargeCategory AS charge_category,
    ChargeFrequency AS charge_frequency FROM charges""",
)(_gold("dim_charge_type"))
query(
    "gld10",
    """WITH t AS (SELECT 'application-code' AS k, application_code AS v FROM charges UNION SELECT 'env', env_tag FROM charges)
    SELECT sha256('tag||' || k || '||' || v) AS tag_sk, k AS tag_key, v AS tag_value FROM t""",
)(_gold("dim_tag"))
query(
    "gld11",
    """WITH t AS (SELECT ResourceId AS r, 'application-code' AS k, application_code AS v, ChargePeriodStart AS a FROM charges
    UNION ALL SELECT ResourceId, 'env', env_tag, ChargePeriodStart FROM charges)
    SELECT sha256('resource||Microsoft||' || r) AS resource_sk, sha256('tag||' || k || '||' || v) AS tag_sk, CAST(min(a) AS VARCHAR) AS valid_from,
    CAST(NULL AS VARCHAR) AS valid_to FROM t GROUP BY r, k, v""",
)(_gold("bridge_resource_tag"))
_DAY_KEY = lambda c: f"CAST(strftime({c}, '%Y%m%d') AS BIGINT)"
_NO_NUMBER = (
    "list_unit_price billed_cost_usd effective_cost_usd on_demand_cost_usd billed_unit_price effective_unit_price on_demand_unit_price pricing_quantity "
    "pricing_block_size partner_credit_rate billing_exchange_rate"
).split()
# the keys of a fact hash the whole line as JSON, which SQL does not write alike: here they are computed and must be two digests,
# dq15b counts them, and tests/test_lake.py recomputes them


def with_checked_keys(facts):
    digest = lambda c: F.col(c).rlike("^[0-9a-f]{64}$")
    given = digest("cost_usage_sk") & digest("charge_id") & (F.col("cost_usage_sk") != F.col("charge_id"))
    return facts.withColumn("has_keys", given).drop("cost_usage_sk", "charge_id")


query(
    "gld12",
    f"""SELECT billing_month, sha256('billing_scope||' || BillingAccountId || '||' || SubAccountId || '||Unknown') AS billing_scope_sk,
    sha256('resource||Microsoft||' || ResourceId) AS resource_sk, sha256('charge_type||' || ChargeCategory || '||Unknown||' || ChargeFrequency) AS charge_type_sk,
    sha256('service||' || ServiceName || '||' || ServiceCategory || '||Microsoft' || repeat('||Unknown', 5)) AS service_sk,
    sha256('sku||' || SkuId || '||Unknown||||' || repeat('||Unknown', 13)) AS sku_sk,
    sha256('location||' || coalesce(nullif(trim(Region), ''), 'Unknown') || '||Unknown||Unknown') AS location_sk,
    sha256('pricing||' || PricingCategory || '||Unknown||Unknown||Unknown||EUR||Unknown') AS pricing_sk,
    sha256('commitment||Unknown||Unknown||Unknown||' || coalesce(CommitmentDiscountType, 'Unknown')) AS commitment_sk,
    {_DAY_KEY("BillingPeriodStart")} AS billing_period_start_date_sk, {_DAY_KEY("BillingPeriodEnd")} AS billing_period_end_date_sk,
    {_DAY_KEY("ChargePeriodStart")} AS charge_period_start_date_sk, {_DAY_KEY("ChargePeriodEnd")} AS charge_period_end_date_sk,
    {", ".join(f"CAST(NULL AS BIGINT) AS {n}_date_sk" for n in ("service_period_start", "service_period_end", "exchange_rate"))},
    CAST(BilledCost AS DOUBLE) AS billed_cost, CAST(EffectiveCost AS DOUBLE) AS effective_cost, CAST(ListCost AS DOUBLE) AS list_cost,
    {", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in _NO_NUMBER)},
    CAST(CASE WHEN PricingCategory = 'On-Demand' THEN ListCost END AS DOUBLE) AS on_demand_cost, CAST(ConsumedQuantity AS DOUBLE) AS usage_quantity,
    coalesce(nullif(trim(ConsumedUnit), ''), 'Unknown') AS usage_unit, '' AS charge_description, 'EUR' AS billing_currency, '2024-01-01 00:00:00' AS ingestion_timestamp,
    'Microsoft' AS source_system, '1.0' AS focus_version, '{VERSION}' AS contract_version, 'run-' || billing_month AS batch_id, true AS has_keys FROM charges""",
)(lambda s, d: with_checked_keys(gold.fact_cost_usage(lines(s, d))))
query(
    "gld13",
    "SELECT x_ChargeId, billing_month, allocation_method, cost_center AS cost_center_allocated, CAST(BilledCost AS DOUBLE) AS BilledCost FROM allocation",
)(lambda s, d: star(s, d).allocation.select("x_ChargeId", "billing_month", "allocation_method", "cost_center_allocated", "BilledCost"))

# --- marts
_SUM = "CAST(sum(BilledCost) AS DOUBLE)"
_LATEST = """latest_resource AS (SELECT ResourceId AS rid, arg_max(application_code, (ChargePeriodStart, Tags)) AS app FROM charges GROUP BY ResourceId)"""
_SAVINGS = """CAST(sum(ListCost) AS DOUBLE) AS list_cost, CAST(sum(ContractedCost) AS DOUBLE) AS contracted_cost, CAST(sum(EffectiveCost) AS DOUBLE) AS effective_cost,
    CAST(sum(CASE WHEN component = 'reservation' THEN EffectiveCost ELSE 0 END) AS DOUBLE) AS reservation,
    CAST(sum(CASE WHEN component = 'savings_plan' THEN EffectiveCost ELSE 0 END) AS DOUBLE) AS savings_plan,
    CAST(sum(CASE WHEN component = 'usage_on_demand' THEN EffectiveCost ELSE 0 END) AS DOUBLE) AS usage_on_demand,
    CAST(sum(CASE WHEN component = 'usage_dynamic' THEN EffectiveCost ELSE 0 END) AS DOUBLE) AS usage_dynamic,
    CAST(sum(CASE WHEN component = 'adjustment' THEN EffectiveCost ELSE 0 END) AS DOUBLE) AS adjustment,
    CAST(sum(CASE WHEN component = 'other' THEN EffectiveCost ELSE 0 END) AS DOUBLE) AS other_effective_cost,
    CAST(sum(ListCost) - sum(ContractedCost) AS DOUBLE) AS negotiated_savings, CAST(sum(ContractedCost) - sum(EffectiveCost) AS DOUBLE) AS commitment_savings,
    CAST(sum(ListCost) - sum(EffectiveCost) AS DOUBLE) AS total_savings_vs_list,
    round(CASE WHEN sum(ListCost) = 0 THEN 0 ELSE 100 * (CAST(sum(ListCost) - sum(EffectiveCost) AS DOUBLE) / CAST(sum(ListCost) AS DOUBLE)) END, 6) AS savings_rate"""
_SUMMARY = f"""count(*) AS charge_lines, count(DISTINCT ResourceId) AS active_resources, count(DISTINCT ServiceName) AS consumed_services, {_SUM} AS billed_cost,
    CAST(sum(EffectiveCost) AS DOUBLE) AS effective_cost, CAST(sum(ListCost) AS DOUBLE) AS list_cost, CAST(sum(ListCost) - sum(EffectiveCost) AS DOUBLE) AS total_savings_vs_list"""


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _mart(name: str):
    return lambda spark, d: marts.MARTS[name](star(spark, d))


query("dm1", f"SELECT billing_month, {_SUM} AS monthly_billed_cost FROM charges GROUP BY ALL")(_mart("dm_monthly_billing"))
query("dm2", f"SELECT CAST(CAST(ChargePeriodStart AS DATE) AS VARCHAR) AS date, {_SUM} AS daily_billed_cost FROM charges GROUP BY ALL")(_mart("dm_daily_billing"))
query(
    "dm3",
    f"""SELECT billing_month, cost_center, 'Unknown' AS customer_name, ServiceCategory AS service_category, ServiceName AS service_name, {_SUM} AS total_billed_cost
    FROM allocation GROUP BY ALL""",
)(_mart("dm_cost_by_scope_service_month"))
query(
    "dm4",
    f"SELECT ServiceCategory AS service_category, ServiceName AS service_name, {_SUM} AS total_billed_cost FROM charges GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1, 2 LIMIT 30",
)(_mart("dm_top_services"))
query(
    "dm5",
    f"""SELECT x_ResourceGroupName AS resource_group_name, 'Unknown' AS resource_name, coalesce(nullif(trim(Region), ''), 'Unknown') AS region, {_SUM} AS total_billed_cost
    FROM charges GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1, 2, 3 LIMIT 100""",
)(_mart("dm_top_resources"))
query(
    "dm6", f"SELECT billing_month, ChargeCategory AS charge_category, ChargeFrequency AS charge_frequency, {_SUM} AS total_billed_cost FROM charges GROUP BY ALL"
)(_mart("dm_cost_by_charge_type"))
query(
    "dm7",
    f"""SELECT SkuId AS sku_id, 'Unknown' AS meter_category, 'Unknown' AS meter_name, {_SUM} AS total_billed_cost FROM charges GROUP BY ALL
    ORDER BY sum(BilledCost) DESC, 1 LIMIT 100""",
)(_mart("dm_sku_cost"))
query("dm8", f"SELECT billing_month, {_SAVINGS} FROM allocation GROUP BY ALL")(lambda s, d: rounded(_mart("dm_savings_monthly")(s, d), "savings_rate"))
query("dm9", f"SELECT billing_month, {_SUMMARY} FROM charges GROUP BY ALL")(_mart("dm_executive_summary_monthly"))
query(
    "dm10",
    f"""SELECT billing_month, x_ResourceGroupName AS resource_group_name, 'Unknown' AS resource_name, coalesce(nullif(trim(Region), ''), 'Unknown') AS region,
    {_SUM} AS total_billed_cost FROM charges GROUP BY ALL""",
)(_mart("dm_top_resources_monthly"))
query(
    "dm11",
    """SELECT billing_month, count(*) AS total_rows, count(*) FILTER (BilledCost IS NULL) AS billed_cost_nulls, count(*) FILTER (BillingCurrency IS NULL) AS currency_nulls,
    count(*) FILTER (ServiceName IS NULL) AS service_nulls, CAST(1 AS BIGINT) AS batches, '2024-01-01 00:00:00' AS latest_silver_load FROM charges GROUP BY ALL""",
)(_mart("dm_data_quality_monthly"))
query(
    "dm12",
    f"""SELECT billing_month, x_ResourceGroupName AS resource_group_name, {_SUM} AS total_billed_cost, count(DISTINCT ResourceId) AS resource_count FROM charges GROUP BY ALL""",
)(_mart("dm_cost_by_resource_group_month"))
query(
    "dm13",
    f"""SELECT billing_month, SubAccountId AS subscription_id, 'Unknown' AS subscription_name, {_SUM} AS total_billed_cost,
    count(DISTINCT ResourceId) AS resource_count FROM charges GROUP BY ALL""",
)(_mart("dm_cost_by_subscription_month"))
query(
    "dm14",
    f"""WITH {_LATEST} SELECT billing_month, 'Unknown' AS application_owner_id, 'Unknown' AS application_owner_email, 'Unknown' AS application_business_owner,
    app AS application_code, 'Unknown' AS application_name, {_SUM} AS total_billed_cost, count(DISTINCT ResourceId) AS resource_count
    FROM charges JOIN latest_resource ON rid = ResourceId GROUP BY ALL""",
)(_mart("dm_cost_by_application_owner_month"))

# --- serving
_EX = f"""WITH m AS (SELECT billing_month, {_SUMMARY} FROM charges GROUP BY ALL),
    h AS (SELECT *, lag(billed_cost) OVER (ORDER BY billing_month) AS p FROM m)
    SELECT charge_lines, active_resources AS resources, consumed_services AS services, billed_cost, effective_cost, list_cost, total_savings_vs_list AS savings_vs_list,
    p AS previous_billed_cost, round(billed_cost - p, 4) AS month_change, round(100 * ((billed_cost - p) / abs(nullif(p, 0))), 6) AS month_change_rate,
    round(billed_cost / active_resources, 6) AS average_cost_per_resource, round(billed_cost / consumed_services, 6) AS average_cost_per_service
    FROM h WHERE billing_month = '{M}'"""
query("qry1", "SELECT DISTINCT billing_month FROM charges ORDER BY 1 DESC")(lambda s, d: serving.months(lines(s, d)))
query("qry4", _EX)(
    lambda s, d: rounded(
        serving.executive_summary(_mart("dm_executive_summary_monthly")(s, d), M).withColumn("month_change", F.round("month_change", 4)),
        "month_change_rate",
        "average_cost_per_resource",
        "average_cost_per_service",
    )
)
query("qry5", f"SELECT billing_month, {_SUM} AS monthly_billed_cost FROM charges GROUP BY ALL ORDER BY 1")(
    lambda s, d: _mart("dm_monthly_billing")(s, d).orderBy("billing_month")
)
query(
    "qry6",
    f"""SELECT billing_month, count(*) AS charge_lines, {_SUM} AS billed_cost, CAST(sum(EffectiveCost) AS DOUBLE) AS effective_cost, CAST(sum(ListCost) AS DOUBLE) AS list_cost,
    CAST(sum(ListCost) - sum(EffectiveCost) AS DOUBLE) AS savings_vs_list FROM charges GROUP BY ALL ORDER BY 1""",
)(lambda s, d: serving.executive_history(_mart("dm_executive_summary_monthly")(s, d)))
query(
    "qry7",
    f"""SELECT CAST(CAST(ChargePeriodStart AS DATE) AS VARCHAR) AS date, {_SUM} AS daily_billed_cost FROM charges WHERE billing_month = '{M}' GROUP BY ALL ORDER BY 1""",
)(lambda s, d: serving.daily_trend(_mart("dm_daily_billing")(s, d), M))
query(
    "qry8",
    f"""SELECT list_cost, contracted_cost, effective_cost, negotiated_savings, total_savings_vs_list AS total_savings, savings_rate
    FROM (SELECT billing_month, {_SAVINGS} FROM allocation GROUP BY ALL) WHERE billing_month = '{M}'""",
)(lambda s, d: rounded(serving.savings_summary(_mart("dm_savings_monthly")(s, d), M), "savings_rate"))
query("qry9", f"SELECT *, total_savings_vs_list AS total_savings FROM (SELECT billing_month, {_SAVINGS} FROM allocation GROUP BY ALL) ORDER BY billing_month")(
    lambda s, d: rounded(serving.monthly_savings(_mart("dm_savings_monthly")(s, d)), "savings_rate")
)


def _month_totals(mart: str, keys: list[str], limit: int | None):
    return lambda s, d: serving.totals(serving.in_month(_mart(mart)(s, d), M), keys, "total_billed_cost", limit)


query(
    "qry10", f"SELECT ServiceName AS service_name, {_SUM} AS total_billed_cost FROM charges WHERE billing_month = '{M}' GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1 LIMIT 15"
)(_month_totals("dm_cost_by_scope_service_month", ["service_name"], 15))
query(
    "qry11", f"SELECT cost_center, {_SUM} AS total_billed_cost FROM allocation WHERE billing_month = '{M}' GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1 LIMIT 20"
)(lambda s, d: serving.cost_centers(_mart("dm_cost_by_scope_service_month")(s, d), M))
query(
    "qry12",
    f"""SELECT ChargeCategory AS charge_category, ChargeFrequency AS charge_frequency, {_SUM} AS total_billed_cost FROM charges WHERE billing_month = '{M}' GROUP BY ALL""",
)(_month_totals("dm_cost_by_charge_type", ["charge_category", "charge_frequency"], None))
query(
    "qry13",
    f"""SELECT x_ResourceGroupName AS resource_group_name, 'Unknown' AS resource_name, coalesce(nullif(trim(Region), ''), 'Unknown') AS region, {_SUM} AS total_billed_cost
    FROM charges WHERE billing_month = '{M}' GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1, 2, 3 LIMIT 25""",
)(_month_totals("dm_top_resources_monthly", ["resource_group_name", "resource_name", "region"], 25))
query(
    "qry14",
    f"""SELECT x_ResourceGroupName AS resource_group_name, {_SUM} AS total_billed_cost, count(DISTINCT ResourceId) AS resource_count FROM charges
    WHERE billing_month = '{M}' GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1 LIMIT 25""",
)(lambda s, d: marts.top(serving.in_month(_mart("dm_cost_by_resource_group_month")(s, d), M), 25, "resource_group_name").drop("billing_month"))
query(
    "qry15",
    f"""SELECT SubAccountId AS subscription_id, 'Unknown' AS subscription_name, {_SUM} AS total_billed_cost, count(DISTINCT ResourceId) AS resource_count FROM charges
    WHERE billing_month = '{M}' GROUP BY ALL""",
)(lambda s, d: serving.in_month(_mart("dm_cost_by_subscription_month")(s, d), M).drop("billing_month").orderBy(F.desc("total_billed_cost"), "subscription_id"))
query(
    "qry16",
    f"""WITH {_LATEST} SELECT app AS application_code, {_SUM} AS total_billed_cost, count(DISTINCT ResourceId) AS resource_count
    FROM charges JOIN latest_resource ON rid = ResourceId WHERE billing_month = '{M}' GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1 LIMIT 50""",
)(
    lambda s, d: marts.top(serving.in_month(_mart("dm_cost_by_application_owner_month")(s, d), M), 50, *marts.OWNER).select(
        "application_code", "total_billed_cost", "resource_count"
    )
)
query(
    "qry17",
    f"""SELECT service_name, CAST(sum(b) AS DOUBLE) AS total_billed_cost FROM (SELECT ServiceCategory, ServiceName AS service_name, sum(BilledCost) AS b FROM charges GROUP BY ALL
    ORDER BY b DESC, 1, 2 LIMIT 30) GROUP BY ALL ORDER BY sum(b) DESC, 1 LIMIT 30""",
)(lambda s, d: serving.totals(_mart("dm_top_services")(s, d), ["service_name"], "total_billed_cost", 30))
query(
    "qry18",
    f"""SELECT x_ResourceGroupName AS resource_group_name, 'Unknown' AS resource_name, coalesce(nullif(trim(Region), ''), 'Unknown') AS region, {_SUM} AS total_billed_cost
    FROM charges GROUP BY ALL ORDER BY sum(BilledCost) DESC, 1, 2, 3 LIMIT 30""",
)(lambda s, d: marts.top(_mart("dm_top_resources")(s, d), 30, "resource_group_name", "resource_name", "region"))
query(
    "qry19",
    f"""SELECT SkuId AS sku_id, 'Unknown' AS meter_category, 'Unknown' AS meter_name, {_SUM} AS total_billed_cost FROM charges GROUP BY ALL
    ORDER BY sum(BilledCost) DESC, 1 LIMIT 50""",
)(lambda s, d: marts.top(_mart("dm_sku_cost")(s, d), 50, "sku_id"))
query(
    "qry20",
    f"""SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS billed_cost_nulls, CAST(0 AS BIGINT) AS currency_nulls, CAST(0 AS BIGINT) AS service_nulls,
    CAST(1 AS BIGINT) AS batches, '2024-01-01 00:00:00' AS latest_silver_load, CAST(100 AS DOUBLE) AS critical_completeness_rate FROM charges WHERE billing_month = '{M}'""",
)(lambda s, d: serving.data_quality(_mart("dm_data_quality_monthly")(s, d), M))
query(
    "qry25",
    """WITH m AS (SELECT year(ChargePeriodStart) AS y, month(ChargePeriodStart) AS n, sum(BilledCost) AS b FROM charges GROUP BY ALL),
    k AS (SELECT n FROM m WHERE y IN (2000, 2001) GROUP BY n HAVING count(*) = 2)
    SELECT count(DISTINCT n) AS months, CAST(sum(b) FILTER (y = 2000) AS DOUBLE) AS base_total, CAST(sum(b) FILTER (y = 2001) AS DOUBLE) AS total,
    round(100 * (CAST(sum(b) FILTER (y = 2001) - sum(b) FILTER (y = 2000) AS DOUBLE) / abs(CAST(sum(b) FILTER (y = 2000) AS DOUBLE))), 6) AS change_rate
    FROM m WHERE n IN (SELECT n FROM k) AND y IN (2000, 2001)""",
)(lambda s, d: rounded(serving.comparable_years(_mart("dm_monthly_billing")(s, d), 2000, 2001), "change_rate"))
_BY_SERVICE = f"WITH t AS (SELECT ServiceName AS service_name, sum(BilledCost) AS b FROM charges WHERE billing_month = '{M}' GROUP BY ALL)"
query(
    "qry26",
    f"""{_BY_SERVICE} SELECT service_name, CAST(b AS DOUBLE) AS total_billed_cost, CAST((SELECT sum(b) FROM t) AS DOUBLE) AS month_total,
    round(100 * (CAST(b AS DOUBLE) / abs(CAST((SELECT sum(b) FROM t) AS DOUBLE))), 6) AS share FROM t ORDER BY b DESC, 1 LIMIT 1""",
)(lambda s, d: rounded(serving.top_service_share(_month_totals("dm_cost_by_scope_service_month", ["service_name"], None)(s, d)), "share"))
query(
    "qry27",
    f"""SELECT CAST(coalesce(sum(BilledCost) FILTER (cost_center <> 'Unallocated Costs'), 0) AS DOUBLE) AS allocated_cost, {_SUM} AS total_cost,
    round(100 * (CAST(coalesce(sum(BilledCost) FILTER (cost_center <> 'Unallocated Costs'), 0) AS DOUBLE) / abs({_SUM})), 6) AS coverage
    FROM allocation WHERE billing_month = '{M}'""",
)(lambda s, d: rounded(serving.center_coverage(serving.cost_centers(_mart("dm_cost_by_scope_service_month")(s, d), M, 1000)), "coverage"))
query(
    "qry28",
    f"""WITH r AS (SELECT x_ResourceGroupName AS g, coalesce(nullif(trim(Region), ''), 'Unknown') AS r, sum(BilledCost) AS b FROM charges WHERE billing_month = '{M}' GROUP BY ALL
    ORDER BY b DESC, 1, 2 LIMIT 25), f AS (SELECT b FROM r ORDER BY b DESC, g, r LIMIT 5)
    SELECT CAST((SELECT sum(b) FROM f) AS DOUBLE) AS leading_total, CAST(sum(b) AS DOUBLE) AS shown_total,
    round(100 * (CAST((SELECT sum(b) FROM f) AS DOUBLE) / abs(CAST(sum(b) AS DOUBLE))), 6) AS concentration FROM r""",
)(lambda s, d: rounded(serving.concentration(_month_totals("dm_top_resources_monthly", ["resource_group_name", "resource_name", "region"], 25)(s, d)), "concentration"))
query(
    "qry31",
    f"""WITH v AS (SELECT billing_month, {_SAVINGS} FROM allocation GROUP BY ALL),
    f AS (SELECT *, least(list_cost, negotiated_savings, commitment_savings, effective_cost) >= 0 AS stackable FROM v)
    SELECT billing_month, stackable, CAST(1 AS BIGINT) AS step, 'list_cost' AS name, list_cost AS amount FROM f
    UNION ALL SELECT billing_month, stackable, 2, 'negotiated_savings', -negotiated_savings FROM f
    UNION ALL SELECT billing_month, stackable, 3, 'commitment_savings', -commitment_savings FROM f
    UNION ALL SELECT billing_month, stackable, 4, 'effective_cost', effective_cost FROM f""",
)(lambda s, d: serving.cost_bridge(_mart("dm_savings_monthly")(s, d)))
query("qry32", f"SELECT Region AS region, ChargeCategory AS charge_category, {_SUM} AS total_billed_cost FROM charges GROUP BY ALL")(
    lambda s, d: serving.totals(lines(s, d).withColumnsRenamed({"Region": "region", "ChargeCategory": "charge_category"}), ["region", "charge_category"], "BilledCost")
)
query(
    "qry33",
    """SELECT 'prod' AS environment, billing_month, CAST(CAST(ChargePeriodStart AS DATE) AS VARCHAR) AS date, ResourceId AS resource_id, Region AS region, cost_center,
    allocation_method, application_code, CAST(BilledCost AS DOUBLE) AS billed_cost, CAST(ContractedCost AS DOUBLE) AS contracted_cost, component AS effective_cost_component
    FROM allocation""",
)(
    lambda s, d: serving.serving_lines(star(s, d).allocation).select(
        "environment", "billing_month", "date", "resource_id", "region", "cost_center", "allocation_method", "application_code", "billed_cost", "contracted_cost", "effective_cost_component"
    )
)
