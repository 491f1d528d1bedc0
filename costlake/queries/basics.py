"""Queries of single operators: projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators import contract
from ..operators.joins import differences, overlap_join, set_difference, validity_join
from ..plans import finance, gold, marts, serving
from ..sources import files
from ..sources.charges import charges, table
from ..sources.usage import RUN_END, RUN_START, list_prices, run_windows, usage
from .checks import GRANTS, broken, grants
from .finance import _CONSUMPTION, _DAILY, _definitions, consumption, daily
from .products import _SAVINGS, _SUM, M, rounded
from .registry import lines, query, star

C = "charges"


def over(f):
    """A query over charge lines."""
    return lambda s, d: f(charges(s, d))


# --- projections
query("prj1", f"""SELECT x_ChargeId, CAST(BilledCost AS DOUBLE) AS BilledCost, CAST(BillingPeriodStart AS VARCHAR) AS BillingPeriodStart, CAST(ChargePeriodEnd AS VARCHAR) AS ChargePeriodEnd,
    CAST(NULL AS BIGINT) AS x_PartnerCreditApplied, CAST(NULL AS BOOLEAN) AS x_SkuIsCreditEligible, CAST(NULL AS VARCHAR) AS PublisherName FROM {C}""")(
    lambda s, d: lines(s, d).select("x_ChargeId", "BilledCost", "BillingPeriodStart", "ChargePeriodEnd", "x_PartnerCreditApplied", "x_SkuIsCreditEligible", "PublisherName")
)
query("prj2", f"""SELECT x_ChargeId, CASE WHEN NOT regexp_matches(x_ChargeId, '^\\d+-\\d+-\\d+-1-') THEN ServiceName
    WHEN ChargeCategory = 'Adjustment' AND ResourceId LIKE '%-1' THEN 'svc ' || ServiceName END AS ServiceName FROM {C}""")(
    lambda s, d: contract.conform(broken(s, d)).select("x_ChargeId", "ServiceName")
)
query("prj3", f"SELECT x_ChargeId, billing_month, '1.0.0' AS _contract_version FROM {C}")(lambda s, d: lines(s, d).select("x_ChargeId", "billing_month", "_contract_version"))
query("prj4", f"SELECT DISTINCT coalesce(nullif(trim(Region), ''), 'Unknown') AS region, coalesce(nullif(trim(x_CostCenter), ''), 'Unknown') AS center FROM {C}")(
    over(lambda c: c.select(X.known("Region").alias("region"), X.known("x_CostCenter").alias("center")).distinct())
)
query("prj5", f"SELECT x_ChargeId, coalesce(nullif(trim(x_CostCenter), ''), nullif(trim(Region), ''), 'Unknown') AS first_known FROM {C}")(
    over(lambda c: c.select("x_ChargeId", X.known("x_CostCenter", "Region").alias("first_known")))
)
query("prj6", f"SELECT DISTINCT ResourceId, sha256('resource||' || ProviderName || '||' || ResourceId) AS resource_sk FROM {C}")(
    over(lambda c: c.select("ResourceId", X.surrogate_key("resource", "ProviderName", "ResourceId").alias("resource_sk")).distinct())
)
query("prj7", f"SELECT DISTINCT CAST(strftime(BillingPeriodStart, '%Y%m%d') AS BIGINT) AS a, CAST(strftime(ChargePeriodEnd, '%Y%m%d') AS BIGINT) AS b FROM {C}")(
    over(lambda c: c.select(X.date_key("BillingPeriodStart").alias("a"), X.date_key("ChargePeriodEnd").alias("b")).distinct())
)
query("prj8", f"SELECT x_ChargeId, CAST(CASE WHEN PricingCategory = 'On-Demand' THEN ListCost END AS DOUBLE) AS on_demand_cost FROM {C}")(
    over(lambda c: c.select("x_ChargeId", F.when(F.col("PricingCategory") == "On-Demand", F.col("ListCost")).alias("on_demand_cost")))
)
query("prj9", f"""SELECT CAST(d AS VARCHAR) AS date, CAST(weekofyear(d) AS BIGINT) AS week, CAST(isodow(d) AS BIGINT) AS day_of_week, dayname(d) AS day_name, d = last_day(d) AS is_month_end
    FROM (SELECT DISTINCT CAST(unnest([BillingPeriodStart, BillingPeriodEnd, CAST(ChargePeriodStart AS DATE), CAST(ChargePeriodEnd AS DATE)]) AS DATE) AS d FROM {C})""")(
    lambda s, d: gold.dim_date(lines(s, d)).select("date", "week", "day_of_week", "day_name", "is_month_end")
)
query("prj10", f"SELECT DISTINCT application_code, env_tag AS env FROM {C}")(
    over(
        lambda c: c.select(X.tag_map().alias("t"))
        .select(X.blank_to_null(F.element_at("t", F.lit(X.APPLICATION_TAGS["application_code"]))).alias("application_code"), X.blank_to_null(F.element_at("t", F.lit("env"))).alias("env"))
        .distinct()
    )
)
query("prj11", "SELECT component, count(*) AS lines, CAST(sum(EffectiveCost) AS DOUBLE) AS effective_cost FROM allocation GROUP BY ALL")(
    over(lambda c: c.groupBy(X.cost_component().alias("component")).agg(F.count("*").alias("lines"), F.sum("EffectiveCost").alias("effective_cost")))
)
query("prj12", "SELECT allocation_method, count(*) AS lines FROM allocation GROUP BY ALL")(
    over(lambda c: c.groupBy(X.allocation_method("x_CostCenter", "Region").alias("allocation_method")).agg(F.count("*").alias("lines")))
)
query("prj12b", f"""SELECT CASE allocation_method WHEN 'UNALLOCATED' THEN CASE WHEN region_name IN ('South India', 'UAE North') THEN 'REGION_CORPORATE' ELSE 'UNALLOCATED' END
    ELSE allocation_method END AS allocation_method, {_SUM} AS cost FROM allocation GROUP BY ALL""")(
    lambda s, d: gold.cost_allocation(lines(s, d), ("South India", "UAE North")).groupBy("allocation_method").agg(F.sum("BilledCost").alias("cost"))
)
query("prj13", "SELECT cost_center AS cost_center_allocated, 'REGION_FALLBACK_V1' AS allocation_policy_version, count(*) AS lines FROM allocation GROUP BY ALL")(
    lambda s, d: star(s, d).allocation.groupBy("cost_center_allocated", "allocation_policy_version").agg(F.count("*").alias("lines"))
)
query("prj15", "SELECT unit, count(*) AS lines FROM allocation GROUP BY ALL")(over(lambda c: c.groupBy(X.normalized_unit("ConsumedUnit").alias("unit")).agg(F.count("*").alias("lines"))))
query("prj16", f"""SELECT CASE WHEN x_CostCenter IS NULL OR lower(trim(x_CostCenter)) IN ('', 'unknown') THEN 'Unallocated Costs' ELSE trim(x_CostCenter) END AS center,
    count(*) AS lines FROM {C} GROUP BY ALL""")(over(lambda c: c.groupBy(X.displayed_center("x_CostCenter").alias("center")).agg(F.count("*").alias("lines"))))
query("prj17", f"""SELECT x_ChargeId, sha256('{{"Region":' || coalesce('"' || Region || '"', 'null') || ',"SkuId":"' || SkuId || '","x_ChargeId":"' || x_ChargeId || '"}}') AS fingerprint FROM {C}""")(
    over(lambda c: c.select("x_ChargeId", contract.fingerprint(["x_ChargeId", "SkuId", "Region"]).alias("fingerprint")))
)
query("prj19", "SELECT workspace_id, CASE workspace_id WHEN 0 THEN 'Frankfurt' WHEN 1 THEN 'Belgium' END AS label, count(*) AS records FROM usage GROUP BY ALL")(
    lambda s, d: usage(s, d)
    .groupBy("workspace_id", F.when(F.col("workspace_id") == 0, "Frankfurt").when(F.col("workspace_id") == 1, "Belgium").alias("label"))
    .agg(F.count("*").alias("records"))
)
query("prj20", "SELECT count(*) FILTER (value = round(value, 1)) AS exact, count(*) AS records FROM events")(
    lambda s, d: table(s, d, "events").agg(F.count_if(X.fits_exactly("value", "decimal(38,1)")).alias("exact"), F.count("*").alias("records"))
)

# --- filters
query("flt1", f"SELECT x_ChargeId FROM {C} WHERE billing_month = '{M}'")(over(lambda c: serving.in_month(c, M).select("x_ChargeId")))
query("flt2", f"SELECT billing_month, count(*) AS lines FROM {C} WHERE billing_month LIKE '1998-%' GROUP BY ALL")(
    over(lambda c: serving.in_year(c, 1998).groupBy("billing_month").agg(F.count("*").alias("lines")))
)
query("flt3", "SELECT x_ChargeId FROM allocation WHERE ChargeCategory = 'Usage' AND unit IS NOT NULL AND ConsumedQuantity IS NOT NULL")(
    over(lambda c: c.where((F.col("ChargeCategory") == "Usage") & X.normalized_unit("ConsumedUnit").isNotNull() & F.col("ConsumedQuantity").isNotNull()).select("x_ChargeId"))
)
query("flt5", "SELECT record_id FROM usage WHERE workspace_id IN (1, 2) AND usage_start_time >= TIMESTAMP '2024-01-05' AND usage_unit = 'DBU' AND sku_name <> 'view'")(
    lambda s, d: usage(s, d)
    .where(F.col("workspace_id").isin(1, 2) & (F.col("usage_start_time") >= F.lit("2024-01-05").cast("timestamp")) & (F.col("usage_unit") == "DBU") & (F.col("sku_name") != "view"))
    .select("record_id")
)
query("flt6", f"SELECT x_ChargeId FROM {C} WHERE NOT coalesce(Region = 'Global', false)")(over(lambda c: c.where(~F.coalesce(F.col("Region") == "Global", F.lit(False))).select("x_ChargeId")))

# --- joins
query("jn1", f"SELECT ServiceName AS service_name, {_SUM} AS cost FROM {C} GROUP BY ALL")(
    lambda s, d: star(s, d).fact.join(gold.dim_service(lines(s, d)), "service_sk").groupBy("service_name").agg(F.sum("billed_cost").alias("cost"))
)


def _seen(c):
    return c.where(F.col("SkuId") == "7").select("_source_file").distinct()


query("jn2", f"SELECT DISTINCT _source_file FROM {C} WHERE _source_file NOT IN (SELECT _source_file FROM {C} WHERE SkuId = '7')")(
    over(lambda c: c.select("_source_file").distinct().join(_seen(c), "_source_file", "left_anti"))
)
query("jn3", f"SELECT x_ChargeId FROM {C} WHERE _source_file IN (SELECT _source_file FROM {C} WHERE SkuId = '7')")(
    over(lambda c: c.join(_seen(c), "_source_file", "left_semi").select("x_ChargeId"))
)
query("jn4", """SELECT record_id, CAST(price AS DOUBLE) AS price FROM usage u LEFT JOIN list_prices p ON u.sku_name = p.sku_name AND usage_start_time >= price_start_time
    AND (price_end_time IS NULL OR (usage_start_time < price_end_time AND usage_end_time <= price_end_time))""")(
    lambda s, d: validity_join(usage(s, d), list_prices(s), finance.PRICE_KEYS, "usage_start_time", "price_start_time", "price_end_time", "usage_end_time").select("record_id", "price")
)
query("jn5", f"""SELECT record_id, CAST(epoch(least(usage_end_time, TIMESTAMP '{RUN_END}')) - epoch(greatest(usage_start_time, TIMESTAMP '{RUN_START}')) AS BIGINT) AS overlap_seconds
    FROM usage WHERE usage_end_time > TIMESTAMP '{RUN_START}' AND usage_start_time < TIMESTAMP '{RUN_END}'""")(
    lambda s, d: overlap_join(usage(s, d), run_windows(s), "usage_start_time", "usage_end_time", "run_start_time", "run_end_time").select("record_id", "overlap_seconds")
)


def repriced(s, d):
    """Daily costs beside those at prices that lack the signups', over five keys; unknown equals unknown."""
    keys = ["usage_date", "month", "provider", "service", "currency"]
    fewer = finance.priced_daily(usage(s, d), list_prices(s).where("sku_name <> 'signup'"))
    found = differences(daily(s, d), fewer, keys, ["cost_before_credits", "usage_quantity"])
    return found.select("usage_date", "service", "difference", F.col("left_cost_before_credits").alias("left_cost"), F.col("right_cost_before_credits").alias("right_cost"))


query("jn9", f"""SELECT usage_date, service, 'changed' AS difference, cost_before_credits AS left_cost, CAST(NULL AS DOUBLE) AS right_cost
    FROM ({_DAILY}) WHERE service = 'signup' AND cost_before_credits IS NOT NULL""")(repriced)
query("jn10", f"SELECT count(*) AS rows, {_SUM} AS cost, (SELECT count(*) FROM events) AS events FROM {C}")(
    lambda s, d: charges(s, d).agg(F.count("*").alias("rows"), F.sum("BilledCost").alias("cost")).crossJoin(table(s, d, "events").agg(F.count("*").alias("events")))
)
query("jn12", f"SELECT count(*) AS visible FROM {C}")(
    lambda s, d: charges(s, d)
    .join(F.broadcast(grants(s).where("role = 'FINOPS_ADMIN' and is_active").limit(1).select(F.lit(True).alias("admin"))), F.lit(True), "left")
    .agg(F.count_if("admin").alias("visible"))
)
query("jn15", f"SELECT x_ChargeId FROM {C} WHERE billing_month = (SELECT max(billing_month) FROM {C})")(
    over(lambda c: c.join(F.broadcast(c.agg(F.max("billing_month").alias("billing_month"))), "billing_month", "left_semi").select("x_ChargeId"))
)
query("jn16", f"SELECT billing_month, {_SUM} AS cost FROM {C} GROUP BY ALL HAVING sum(BilledCost) > (SELECT sum(BilledCost) / count(DISTINCT billing_month) FROM {C})")(
    over(
        lambda c: c.groupBy("billing_month")
        .agg(F.sum("BilledCost").alias("cost"))
        .crossJoin(F.broadcast(c.agg((F.sum("BilledCost").cast("double") / F.countDistinct("billing_month")).alias("_mean"))))
        .where("cast(cost as double) > _mean")
        .drop("_mean")
    )
)

# --- aggregates
query("agg1", f"SELECT billing_month, ChargeCategory, {_SUM} AS cost, count(*) AS lines FROM {C} GROUP BY ALL")(
    over(lambda c: c.groupBy("billing_month", "ChargeCategory").agg(F.sum("BilledCost").alias("cost"), F.count("*").alias("lines")))
)
query("agg2", f"SELECT billing_month, count(DISTINCT ResourceId) AS resources, count(DISTINCT ServiceName) AS services, count(DISTINCT SubAccountId) AS accounts FROM {C} GROUP BY ALL")(
    over(
        lambda c: c.groupBy("billing_month").agg(
            F.countDistinct("ResourceId").alias("resources"), F.countDistinct("ServiceName").alias("services"), F.countDistinct("SubAccountId").alias("accounts")
        )
    )
)
query("agg3", f"SELECT CAST(coalesce(sum(BilledCost) FILTER (SkuId = 'none'), 0) AS DOUBLE) AS cost FROM {C}")(
    over(lambda c: c.where("SkuId = 'none'").agg(F.coalesce(F.sum("BilledCost"), F.lit(0)).alias("cost")))
)
query("agg4", f"""SELECT billing_month, CAST(sum(CASE WHEN ChargeCategory = 'Usage' THEN BilledCost ELSE 0 END) AS DOUBLE) AS used,
    CAST(sum(CASE WHEN ChargeCategory = 'Adjustment' THEN BilledCost ELSE 0 END) AS DOUBLE) AS adjusted FROM {C} GROUP BY ALL""")(
    over(
        lambda c: c.groupBy("billing_month").agg(
            *(F.sum(F.when(F.col("ChargeCategory") == k, F.col("BilledCost")).otherwise(0)).alias(n) for k, n in (("Usage", "used"), ("Adjustment", "adjusted")))
        )
    )
)
query("agg5", f"SELECT billing_month, count(*) FILTER (BilledCost < 0) AS negative, count(*) FILTER (Region IS NULL) AS regionless FROM {C} GROUP BY ALL")(
    over(lambda c: c.groupBy("billing_month").agg(F.count_if(F.col("BilledCost") < 0).alias("negative"), F.count_if(F.col("Region").isNull()).alias("regionless")))
)
query("agg6", f"SELECT ServiceName, CAST(min(ChargePeriodStart) AS VARCHAR) AS first, CAST(max(ChargePeriodEnd) AS VARCHAR) AS last FROM {C} GROUP BY ALL")(
    over(lambda c: c.groupBy("ServiceName").agg(F.min("ChargePeriodStart").alias("first"), F.max("ChargePeriodEnd").alias("last")))
)
query("agg7", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS newest FROM events GROUP BY ALL")(
    lambda s, d: table(s, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("newest"))
)
query("agg8", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM events GROUP BY ALL")(
    lambda s, d: table(s, d, "events").groupBy("user_id").agg(F.array_join(F.sort_array(F.flatten(F.collect_set(F.array("event_type")))), ",").alias("types"))
)
query("agg9", f"SELECT DISTINCT ServiceName, ServiceCategory, Region FROM {C}")(over(lambda c: c.select("ServiceName", "ServiceCategory", "Region").distinct()))
query("agg11", f"SELECT ResourceId, count(DISTINCT Region) AS regions FROM {C} GROUP BY ALL HAVING count(DISTINCT Region) > 0 AND count(DISTINCT SubAccountId) > 1")(
    over(
        lambda c: c.groupBy("ResourceId")
        .agg(F.countDistinct("Region").alias("regions"), F.countDistinct("SubAccountId").alias("_n"))
        .where("regions > 0 and _n > 1")
        .drop("_n")
    )
)
query("agg13", f"SELECT service, CAST(CASE WHEN count(*) FILTER (cost_before_credits IS NULL) > 0 THEN NULL ELSE round(sum(cost_before_credits), 6) END AS DOUBLE) AS cost FROM ({_DAILY}) GROUP BY ALL")(
    lambda s, d: rounded(daily(s, d).groupBy("service").agg(X.sum_or_null(F.col("cost_before_credits")).cast("double").alias("cost")), "cost")
)
query("agg14", "SELECT ServiceName, CAST(sum(CASE WHEN unit IS NOT NULL THEN ConsumedQuantity END) AS DOUBLE) AS quantity FROM allocation GROUP BY ALL")(
    over(lambda c: c.groupBy("ServiceName").agg(F.sum(F.when(X.normalized_unit("ConsumedUnit").isNotNull(), F.col("ConsumedQuantity"))).alias("quantity")))
)
query("agg15", """SELECT record_id, CAST(CASE WHEN count(p.sku_name) = 1 AND min(p.price) = round(min(p.price), 9) THEN min(p.price) END AS DOUBLE) AS unit_price
    FROM usage u LEFT JOIN list_prices p ON u.sku_name = p.sku_name AND usage_start_time >= price_start_time
    AND (price_end_time IS NULL OR (usage_start_time < price_end_time AND usage_end_time <= price_end_time)) GROUP BY ALL""")(
    lambda s, d: finance.unit_prices(usage(s, d), list_prices(s)).select("record_id", "unit_price")
)
query("agg16", f"SELECT count(*) FILTER (SkuId = '9') AS currency, count(*) FILTER (SkuId = '7') AS period FROM {C}")(
    lambda s, d: contract.count_violations(
        contract.conform(broken(s, d)), {"currency": F.col("BillingCurrency") != "EUR", "period": F.col("ChargePeriodStart") > F.col("ChargePeriodEnd")}
    )
)
query("agg17", f"SELECT billing_month, count(*) FILTER (Region IS NULL) + count(*) FILTER (x_CostCenter IS NULL) AS nulls FROM {C} GROUP BY ALL")(
    over(lambda c: c.groupBy("billing_month").agg((F.count_if(F.col("Region").isNull()) + F.count_if(F.col("x_CostCenter").isNull())).alias("nulls")))
)
query("agg18", f"SELECT billing_month, round(100 * (1 - CAST(count(*) FILTER (Region IS NULL) AS DOUBLE) / (3 * count(*))), 6) AS completeness FROM {C} GROUP BY ALL")(
    over(lambda c: c.groupBy("billing_month").agg(F.round(100 * (1 - F.count_if(F.col("Region").isNull()).cast("double") / (3 * F.count("*"))), 6).alias("completeness")))
)
query("agg19", f"SELECT billing_month, savings_rate FROM (SELECT billing_month, {_SAVINGS} FROM allocation GROUP BY ALL)")(
    lambda s, d: rounded(marts.savings_monthly(star(s, d)).select("billing_month", "savings_rate"), "savings_rate")
)
query("agg21", f"""SELECT service_name, consumed_unit, sum(consumed_quantity) AS consumed_quantity, CAST(sum(usage_rows) AS BIGINT) AS usage_rows, min(first_loaded_charge_date) AS first
    FROM ({_CONSUMPTION}) GROUP BY ALL""")(
    lambda s, d: finance.reaggregate(consumption(s, d), ["service_name", "consumed_unit"]).select(
        "service_name", "consumed_unit", "consumed_quantity", "usage_rows", F.col("first_loaded_charge_date").alias("first")
    )
)
query("agg22", f"SELECT month, CASE WHEN bool_or(service = 'view') THEN 'partial' ELSE 'closed' END AS period_status FROM ({_DAILY}) GROUP BY ALL")(
    lambda s, d: daily(s, d)
    .groupBy("month")
    .agg(F.when(F.max(F.when(F.col("service") == "view", 1).otherwise(0)) == 1, "partial").otherwise("closed").alias("period_status"))
)
query("agg23", f"SELECT service, round(sum(cost_before_credits), 6) AS cost FROM ({_DAILY}) GROUP BY ALL")(
    lambda s, d: rounded(daily(s, d).groupBy("service").agg(F.sum("cost_before_credits").cast("double").alias("cost")), "cost")
)

# --- windows
query("win1", f"""SELECT _source_file, CAST(n AS BIGINT) AS n, x_ChargeId FROM (SELECT *, row_number() OVER (PARTITION BY _source_file
    ORDER BY ChargePeriodStart, ChargePeriodEnd, ResourceId, SkuId, ServiceName, BilledCost, EffectiveCost, ListCost, x_ChargeId) AS n FROM {C})""")(
    over(
        lambda c: c.withColumn(
            "n",
            F.row_number().over(
                W.partitionBy("_source_file").orderBy("ChargePeriodStart", "ChargePeriodEnd", "ResourceId", "SkuId", "ServiceName", "BilledCost", "EffectiveCost", "ListCost", "x_ChargeId")
            ),
        ).select("_source_file", "n", "x_ChargeId")
    )
)
query("win2", f"SELECT ResourceId, arg_max(x_ChargeId, (ChargePeriodStart, x_ChargeId)) AS newest FROM {C} GROUP BY ALL")(
    over(lambda c: serving.latest(c, ["ResourceId"], "ChargePeriodStart", "x_ChargeId").select("ResourceId", F.col("x_ChargeId").alias("newest")))
)
query("win3", f"SELECT x_ChargeId, CAST(min(ChargePeriodStart) OVER (PARTITION BY ResourceId) AS VARCHAR) AS first_seen FROM {C}")(
    over(lambda c: c.select("x_ChargeId", F.min("ChargePeriodStart").over(W.partitionBy("ResourceId")).alias("first_seen")))
)
query("win4", f"""WITH m AS (SELECT billing_month, sum(BilledCost) AS b FROM {C} GROUP BY ALL), h AS (SELECT *, lag(b) OVER (ORDER BY billing_month) AS p FROM m)
    SELECT billing_month, CAST(p AS DOUBLE) AS previous, CAST(b - p AS DOUBLE) AS change, round(100 * (CAST(b - p AS DOUBLE) / abs(nullif(CAST(p AS DOUBLE), 0))), 6) AS rate FROM h""")(
    lambda s, d: rounded(
        marts.monthly_billing(star(s, d))
        .withColumn("previous", F.lag("monthly_billed_cost").over(W.orderBy("billing_month")))
        .select(
            "billing_month",
            "previous",
            (F.col("monthly_billed_cost") - F.col("previous")).alias("change"),
            (100 * X.ratio(F.col("monthly_billed_cost") - F.col("previous"), F.abs("previous"))).alias("rate"),
        ),
        "rate",
    )
)
query("win7", "SELECT DISTINCT user_id AS job_id, 'job-' || user_id || '-v3' AS name FROM events WHERE user_id % 5 <> 0")(
    lambda s, d: serving.latest(_definitions(s, d), ["job_id"], "change_time").where("delete_time is null").select("job_id", "name")
)

# --- sorts and set operations
query("srt1", f"SELECT SkuId, {_SUM} AS cost FROM {C} GROUP BY ALL ORDER BY sum(BilledCost) DESC, SkuId LIMIT 30")(
    over(lambda c: marts.top(c.groupBy("SkuId").agg(F.sum("BilledCost").alias("cost")), 30, "SkuId", by="cost"))
)
query("srt2", f"SELECT billing_month, ServiceName, count(*) AS lines FROM {C} GROUP BY ALL ORDER BY 1, 2")(
    over(lambda c: c.groupBy("billing_month", "ServiceName").agg(F.count("*").alias("lines")).orderBy("billing_month", "ServiceName"))
)
query("srt3", f"SELECT count(*) FILTER (SkuId = 'none') = 0 AS empty FROM {C}")(over(lambda c: c.where("SkuId = 'none'").limit(1).agg((F.count("*") == 0).alias("empty"))))
query("srt4", f"SELECT count(DISTINCT billing_month) <= 10000 AS bounded FROM {C}")(
    over(lambda c: c.select("billing_month").distinct().limit(10_001).agg((F.count("*") <= 10_000).alias("bounded")))
)
query("set1", "SELECT 'orders' AS \"table\", count(*) AS rows FROM orders UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'events', count(*) FROM events")(
    lambda s, d: files.table_counts({n: table(s, d, n) for n in ("orders", "customer", "events")})
)
query("set2", f"SELECT billing_month FROM {C} UNION SELECT strftime(ts, '%Y-%m') FROM events")(
    lambda s, d: charges(s, d).select("billing_month").union(table(s, d, "events").select(F.date_format("ts", "yyyy-MM"))).distinct()
)
query("set3", f"SELECT DISTINCT billing_month, 'left' AS side FROM {C} WHERE billing_month NOT IN (SELECT billing_month FROM {C} WHERE SkuId = '7')")(
    over(lambda c: set_difference(c.select("billing_month").distinct(), c.where("SkuId = '7'").select("billing_month").distinct()))
)

# --- sources that need no storage
query("src4", "SELECT count(*) AS rows FROM orders")(lambda s, d: (table(s, d, "orders").createOrReplaceTempView("orders_view"), s.table("orders_view").agg(F.count("*").alias("rows")))[1])


def _files(c):
    return files.dated(c.select(F.col("_source_file").alias("source_uri")).distinct())


query("src7", f"SELECT DISTINCT _source_file AS source_uri, strftime(ChargePeriodStart, '%Y-%m-%d') AS processing_date, billing_month, true AS valid FROM {C}")(over(_files))
query("src8", f"SELECT DISTINCT '/lake/' || _source_file AS uri, true AS inside FROM {C}")(
    over(
        lambda c: c.select(F.concat(F.lit("file:///lake//"), "_source_file").alias("raw"))
        .distinct()
        .select(files.normalized_uri("raw").alias("uri"))
        .select("uri", files.confined("uri", "/lake").alias("inside"))
    )
)


def _states(s, d):
    from .checks import month_status

    c = charges(s, d)
    return files.classified(_files(c), c.where("SkuId = '7'").select("_source_file"), month_status(s))


_STATES = f"""SELECT source_uri, billing_month, CASE WHEN billing_month IN ('{M}', '1998-05') THEN 'CLOSED' WHEN loaded THEN 'LOADED' ELSE 'NEW' END AS state
    FROM (SELECT _source_file AS source_uri, billing_month, bool_or(SkuId = '7') AS loaded FROM {C} GROUP BY ALL)"""
query("src9", _STATES)(lambda s, d: _states(s, d).select("source_uri", "billing_month", "state"))
query("src10", f"SELECT source_uri FROM ({_STATES}) WHERE state = 'NEW' ORDER BY 1 LIMIT 1")(lambda s, d: files.next_file(_states(s, d)).select("source_uri"))


def month_range(s, d):
    """All months from the first to the last of the charges."""
    first, last = charges(s, d).agg(F.min("billing_month"), F.max("billing_month")).first()
    return files.months_between(s, first, last)


query("src11", f"SELECT strftime(unnest(generate_series(min(BillingPeriodStart), max(BillingPeriodStart), INTERVAL 1 MONTH)), '%Y-%m') AS billing_month FROM {C}")(month_range)
query("src12", "SELECT CAST(max(event_id) FILTER (value > 20) AS VARCHAR) AS run_id FROM events WHERE date_trunc('second', ts) = (SELECT max(date_trunc('second', ts)) FROM events WHERE value > 20)")(
    lambda s, d: files.newest_export(
        table(s, d, "events").select(
            F.lit("2").alias("schema_version"), F.lit("daily").alias("granularity"), F.col("event_id").cast("string").alias("run_id"),
            F.date_trunc("second", F.col("ts").cast("timestamp")).cast("string").alias("extracted_at"), F.lit("10").alias("row_count"),
            F.when(F.col("value") > 20, "COMPLETED").otherwise("RUNNING").alias("status"),
        ),
        F.lit(str(table(s, d, "events").agg(F.max(F.col("ts").cast("timestamp").cast("string"))).first()[0])).cast("timestamp"),
    ).select("run_id")
)
query("src13", f"SELECT count(*) AS lines, CAST({len(GRANTS)} AS BIGINT) AS grants FROM {C}")(
    lambda s, d: charges(s, d).agg(F.count("*").alias("lines")).crossJoin(F.broadcast(grants(s).agg(F.count("*").alias("grants"))))
)
query("src14", """SELECT 'places' AS layer, CAST(2 AS BIGINT) AS tables, 'region' AS "table", count(*) AS rows FROM region UNION ALL SELECT 'places', 2, 'nation', count(*) FROM nation
    UNION ALL SELECT 'sales', 3, 'part', count(*) FROM part UNION ALL SELECT 'sales', 3, 'orders', count(*) FROM orders UNION ALL SELECT 'sales', 3, 'lineitem', count(*) FROM lineitem""")(
    lambda s, d: files.layer_counts({"places": {n: table(s, d, n) for n in ("region", "nation")}, "sales": {n: table(s, d, n) for n in ("part", "orders", "lineitem")}})
)
