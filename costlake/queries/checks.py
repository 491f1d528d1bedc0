"""Queries of controls and of row-level scoping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.expressions import UNKNOWN, surrogate_key
from ..operators import audit, contract, scoping
from ..operators.joins import differences
from ..plans import finance, gold, marts, serving
from ..sources.charges import charges, table
from ..sources.files import CLOSED
from ..sources.usage import usage
from .finance import _CONSUMPTION, _export, consumption, merged
from .products import M, _SUM, rounded
from .registry import lines, query, star


def broken(s, d):
    """Lines with faults: no service on the first lines, a period the wrong way round, a foreign currency, a free-text fallback."""
    first = F.col("x_ChargeId").rlike(r"^\d+-\d+-\d+-1-")
    base = charges(s, d).withColumn("ChargeDescription", F.when(F.col("ResourceId").rlike("-1$"), F.concat(F.lit("svc "), F.col("ServiceName"))))
    return base.withColumns(
        {
            "ServiceName": F.when(first, None).otherwise(F.col("ServiceName")),
            "ChargePeriodEnd": F.when(F.col("SkuId") == "7", F.col("ChargePeriodStart") - F.expr("interval 1 day")).otherwise(F.col("ChargePeriodEnd")),
            "BillingCurrency": F.when(F.col("SkuId") == "9", "USD").otherwise(F.col("BillingCurrency")),
            "PricingCategory": F.when(F.col("SkuId") == "11", "Spot").otherwise(F.col("PricingCategory")),
        }
    )


_FIRST = "regexp_matches(x_ChargeId, '^\\d+-\\d+-\\d+-1-')"
_FILLED = f"({_FIRST} AND NOT (ChargeCategory = 'Adjustment' AND ResourceId LIKE '%-1'))"
_RULES = contract.rule_names()
query(
    "dq1",
    "SELECT "
    + ", ".join(
        {
            "not_null_ServiceName": f"count(*) FILTER {_FILLED} AS not_null_ServiceName",
            "allowed_values_BillingCurrency": "count(*) FILTER (SkuId = '9') AS allowed_values_BillingCurrency",
            "allowed_values_PricingCategory": "count(*) FILTER (SkuId = '11') AS allowed_values_PricingCategory",
            "expected_BillingCurrency": "count(*) FILTER (SkuId = '9') AS expected_BillingCurrency",
            "ordered_ChargePeriod": "count(*) FILTER (SkuId = '7') AS ordered_ChargePeriod",
        }.get(r, f"CAST(0 AS BIGINT) AS {r}")
        for r in _RULES
    )
    + " FROM charges",
)(lambda s, d: contract.count_violations(contract.conform(broken(s, d)), contract.rules()))
_BROKEN = {
    "not_null_ServiceName": _FILLED,
    "allowed_values_BillingCurrency": "SkuId = '9'",
    "allowed_values_PricingCategory": "SkuId = '11'",
    "expected_BillingCurrency": "SkuId = '9'",
    "ordered_ChargePeriod": "SkuId = '7'",
}
_VIOLATIONS = " UNION ALL ".join(f"SELECT '{r}' AS rule, _source_file AS file FROM charges WHERE {w}" for r, w in _BROKEN.items())
query(
    "prj18",
    f"""WITH c AS (SELECT rule, file, count(*) AS violations FROM ({_VIOLATIONS}) GROUP BY ALL),
    t AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY violations DESC, file) AS place FROM c)
    SELECT rule, file, violations, unnest(range(1, least(violations, 2) + 1)) AS sample FROM t WHERE place <= 3""",
)(
    lambda s, d: contract.diagnose(contract.conform(broken(s, d)), contract.rules(), ["ServiceName", "BillingCurrency", "PricingCategory"]).select(
        "rule", "file", "violations", "sample"
    )
)
query(
    "dq17",
    f"SELECT billing_month, count(*) FILTER ({_FIRST}) AS source_nulls, count(*) FILTER {_FILLED} AS clean_nulls FROM charges GROUP BY ALL",
)(lambda s, d: audit.fallback_effect(broken(s, d), contract.conform(broken(s, d))))
query("dq2", r"""SELECT count(*) FILTER (regexp_matches(text, '[a-zA-Z0-9_.+%-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}') OR regexp_matches(text, '(?i)apache')) AS text,
    CAST(0 AS BIGINT) AS lang, CAST(0 AS BIGINT) AS source FROM documents""")(lambda s, d: audit.privacy_counts(table(s, d, "documents"), "(?i)apache", "^nobody@"))
query("dq3", r"SELECT count(*) FILTER (regexp_matches(html, '[a-zA-Z0-9_.+%-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')) AS html FROM pages")(
    lambda s, d: audit.privacy_counts(table(s, d, "pages"), columns=["html"])
)


def guarded(spark, cases):
    """Outcome of guards: what each returns, or that it refused."""
    out = []
    for name, guard in cases.items():
        try:
            out.append((name, str(guard())))
        except audit.ControlError:
            out.append((name, "refused"))
    return spark.createDataFrame(out, "case string, outcome string")


query("dq4", f"SELECT 'one month' AS case, max(billing_month) AS outcome FROM charges WHERE billing_month = '{M}' UNION ALL SELECT 'all months', CASE WHEN count(DISTINCT billing_month) > 1 THEN 'refused' END FROM charges")(
    lambda s, d: guarded(
        s,
        {
            "one month": lambda: audit.one_value(charges(s, d).where(F.col("billing_month") == M), "billing_month"),
            "all months": lambda: audit.one_value(charges(s, d), F.date_format(F.to_date("BillingPeriodStart"), "yyyy-MM")),
        },
    )
)
query("dq5", f"SELECT 'one day' AS case, max(_source_file) AS outcome FROM charges WHERE CAST(ChargePeriodStart AS DATE) = DATE '{M}-02' UNION ALL SELECT 'one month', CASE WHEN count(DISTINCT _source_file) > 1 THEN 'refused' END FROM charges WHERE billing_month = '{M}'")(
    lambda s, d: guarded(
        s,
        {
            "one day": lambda: audit.one_value(charges(s, d).where(F.to_date("ChargePeriodStart") == F.lit(f"{M}-02").cast("date")), "_source_file"),
            "one month": lambda: audit.one_value(charges(s, d).where(F.col("billing_month") == M), "_source_file"),
        },
    )
)
_STATUS = f"(VALUES ('{M}', 'CLOSED'), ('1998-04', 'OPEN'), ('1998-05', 'CLOSED_ARCHIVE_PENDING')) AS st(m, status)"


def month_status(s):
    return s.createDataFrame([(M, "CLOSED"), ("1998-04", "OPEN"), ("1998-05", "CLOSED_ARCHIVE_PENDING")], "billing_month string, status string")


def closed_lines(s, d):
    shut = month_status(s).where(F.col("status").isin("CLOSED", "CLOSED_DATA_LOADED", "CLOSED_ARCHIVE_PENDING"))
    return charges(s, d).join(shut, "billing_month", "left_semi").groupBy("billing_month").agg(F.count("*").alias("rows"))


query("jn18", f"SELECT billing_month, count(*) AS rows FROM charges WHERE billing_month IN (SELECT m FROM {_STATUS} WHERE status <> 'OPEN') GROUP BY ALL")(closed_lines)

_SNAP = f"""SELECT billing_month, count(*) AS row_count, CAST(sum(CAST(BilledCost AS DECIMAL(38,6))) AS DOUBLE) AS billed_cost_total,
    CAST(sum(CAST(EffectiveCost AS DECIMAL(38,6))) AS DOUBLE) AS effective_cost_total, CAST(sum(CAST(ListCost AS DECIMAL(38,6))) AS DOUBLE) AS list_cost_total,
    count(DISTINCT BillingAccountId) AS distinct_accounts, count(DISTINCT ResourceId) AS distinct_resources, CAST(0 AS BIGINT) AS null_critical_count,
    CAST(min(ChargePeriodStart) AS VARCHAR) AS min_charge_period, CAST(max(ChargePeriodEnd) AS VARCHAR) AS max_charge_period, CAST(0 AS BIGINT) AS duplicate_charge_ids
    FROM charges GROUP BY billing_month"""
_DUP = "(SELECT billing_month AS bm, count(*) AS c FROM (SELECT billing_month, x_ChargeId FROM charges GROUP BY ALL HAVING count(*) > 1) GROUP BY ALL)"
for _name in ("dq7",):
    query(_name, f"SELECT v.* REPLACE (coalesce(c, 0) AS duplicate_charge_ids) FROM ({_SNAP}) v LEFT JOIN {_DUP} ON bm = billing_month")(
        lambda s, d: audit.snapshot(lines(s, d), ["billing_month"])
    )


def reconciled(s, d):
    """A replacement that loses one SKU's lines, in months where there are any."""
    keys, all_ = ["billing_month"], lines(s, d)
    stored = all_.where("SkuId <> '7'")
    return audit.reconcile(audit.snapshot(stored, keys), audit.snapshot(all_, keys), audit.snapshot(stored, keys), keys)


_RECONCILED = """SELECT billing_month, count(*) FILTER (SkuId <> '7') AS before_rows, count(*) AS source_rows, count(*) FILTER (SkuId <> '7') AS after_rows,
    round(CAST(coalesce(sum(BilledCost) FILTER (SkuId = '7'), 0) AS DOUBLE), 6) AS billing_daily_difference,
    round(0 - CAST(coalesce(sum(BilledCost) FILTER (SkuId = '7'), 0) AS DOUBLE), 6) AS after_billing_difference,
    CASE WHEN count(*) FILTER (SkuId = '7') = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM charges GROUP BY ALL"""
query("dq9", _RECONCILED)(
    lambda s, d: rounded(
        reconciled(s, d).withColumns({c: F.col(c).cast("double") + 0.0 for c in ("billing_daily_difference", "after_billing_difference")}), "billing_daily_difference", "after_billing_difference"
    )
)
query("dq12", f"SELECT billing_month, status FROM ({_RECONCILED}) WHERE status <> 'PASSED'")(lambda s, d: reconciled(s, d).where("status <> 'PASSED'").select("billing_month", "status"))
query("dq16", f"SELECT count(*) FILTER (null_critical_count = 0) AS clean, count(*) AS months FROM ({_SNAP})")(
    lambda s, d: audit.snapshot(lines(s, d), ["billing_month"]).agg(F.count_if(F.col("null_critical_count") == 0).alias("clean"), F.count("*").alias("months"))
)


def layered(s, d):
    g = star(s, d)
    raw = charges(s, d)
    return audit.layers({"bronze": raw, "silver": g.lines, "gold": g.fact}, {"bronze": "BilledCost", "silver": "BilledCost", "gold": "billed_cost"})


_LAYERS = ", ".join(f"count(*) AS {n}_rows, {_SUM} AS {n}_cost" for n in ("bronze", "silver", "gold"))
for _name in ("dq11", "jn6"):
    query(_name, f"SELECT billing_month, {_LAYERS}, true AS agree FROM charges GROUP BY ALL")(layered)


def runs(s, d):
    """A run log out of the events: type as pipeline, user modulo 3 as environment."""
    return table(s, d, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("env"), (F.col("user_id") % 3).cast("string")).alias("environment"),
        F.col("event_type").alias("pipeline_name"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM").alias("billing_month"),
        F.when(F.col("value") > 20, "SUCCESS").otherwise("FAILED").alias("status"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("started_at"),
        (F.date_trunc("second", F.col("ts").cast("timestamp")) + F.expr("interval 5 minutes")).alias("finished_at"),
        F.lit(None).cast("string").alias("message"),
    )


_RUNS = """(SELECT CAST(event_id AS VARCHAR) AS run_id, 'env' || (user_id % 3) AS environment, event_type AS pipeline_name, strftime(ts, '%Y-%m') AS billing_month,
    CASE WHEN value > 20 THEN 'SUCCESS' ELSE 'FAILED' END AS status, date_trunc('second', ts) AS started_at FROM events)"""
_NEWEST = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY environment, pipeline_name, billing_month ORDER BY started_at DESC, run_id DESC) AS n FROM {_RUNS}) WHERE n = 1)"""


def newest_runs(s, d):
    return serving.latest(runs(s, d), ["environment", "pipeline_name", "billing_month"], "started_at", "run_id")


query("dq13", f"SELECT environment, pipeline_name, billing_month, run_id FROM {_NEWEST} WHERE status <> 'SUCCESS'")(
    lambda s, d: newest_runs(s, d).where("status <> 'SUCCESS'").select("environment", "pipeline_name", "billing_month", "run_id")
)
query("win5", f"SELECT environment, pipeline_name, billing_month, run_id, status FROM {_NEWEST}")(
    lambda s, d: newest_runs(s, d).select("environment", "pipeline_name", "billing_month", "run_id", "status")
)
query("qry21", f"""SELECT run_id, pipeline_name, billing_month, status, CAST(started_at AS VARCHAR) AS started_at, CAST(started_at + INTERVAL 5 MINUTE AS VARCHAR) AS finished_at,
    CAST(NULL AS VARCHAR) AS message FROM {_NEWEST} WHERE environment = 'env1' ORDER BY started_at DESC, run_id LIMIT 30""")(lambda s, d: serving.latest_runs(runs(s, d), "env1"))
query("qry23", f"""SELECT environment, count(*) AS total_runs, count(*) FILTER (status = 'SUCCESS') AS successful_runs, CAST(max(started_at) AS VARCHAR) AS latest_run
    FROM {_RUNS} GROUP BY ALL""")(lambda s, d: serving.run_counts(runs(s, d)))


def reconciliations(s, d):
    at = F.date_trunc("second", F.col("ts").cast("timestamp"))
    return table(s, d, "events").select(
        F.col("event_id").alias("run_id"), F.concat(F.lit("env"), (F.col("user_id") % 3).cast("string")).alias("environment"), F.date_format(at, "yyyy-MM").alias("billing_month"),
        F.when(F.col("value") > 20, "PASSED").otherwise("FAILED").alias("status"), F.col("user_id").alias("billing_rows"), F.col("user_id").alias("after_rows"),
        F.lit(0).cast("decimal(38,6)").alias("after_billing_difference"), at.alias("reconciled_at"),
    )


_REC = """(SELECT * FROM (SELECT 'env' || (user_id % 3) AS environment, strftime(ts, '%Y-%m') AS billing_month, CASE WHEN value > 20 THEN 'PASSED' ELSE 'FAILED' END AS status,
    user_id, date_trunc('second', ts) AS seen, row_number() OVER (PARTITION BY user_id % 3, strftime(ts, '%Y-%m') ORDER BY date_trunc('second', ts) DESC, event_id DESC) AS n FROM events) WHERE n = 1)"""
query("win6", f"SELECT environment, billing_month, status, CAST(seen AS VARCHAR) AS reconciled_at FROM {_REC}")(
    lambda s, d: serving.latest(reconciliations(s, d), ["environment", "billing_month"], "reconciled_at", "run_id").select("environment", "billing_month", "status", "reconciled_at")
)
query("qry22", f"""SELECT billing_month, status, user_id AS billing_rows, user_id AS after_rows, CAST(0 AS DOUBLE) AS after_billing_difference, CAST(seen AS VARCHAR) AS reconciled_at
    FROM {_REC} WHERE environment = 'env1' ORDER BY 1 DESC LIMIT 24""")(lambda s, d: serving.latest_reconciliations(reconciliations(s, d), "env1"))


def ingested(s, d):
    """Charges with the run that brought each: a day's file comes with one run, but the lines of one SKU came with a second, and those of another again with the first's rerun."""
    run = F.concat(F.lit("run-"), F.col("_source_file"), F.when(F.col("SkuId") == "7", "-late").when(F.col("SkuId") == "9", "-rerun").otherwise(""))
    return charges(s, d).withColumn("_ingestion_run_id", run)


query(
    "dq14",
    """SELECT _source_file, count(DISTINCT r) AS runs, CAST(sum(n) AS BIGINT) AS rows FROM (SELECT _source_file, CASE SkuId WHEN '7' THEN 'late' WHEN '9' THEN 'rerun' ELSE '' END AS r, count(*) AS n
    FROM charges GROUP BY ALL) GROUP BY ALL HAVING count(DISTINCT r) <> 1""",
)(lambda s, d: audit.runs_of_files(ingested(s, d)))
_TWICE = "SELECT x_ChargeId, CAST(2 AS BIGINT) AS copies FROM charges WHERE SkuId = '7'"
for _name in ("dq15", "agg10"):
    query(_name, _TWICE)(lambda s, d: audit.duplicates(charges(s, d).union(charges(s, d).where("SkuId = '7'")), ["x_ChargeId"]))
query("dq15b", "SELECT count(*) AS rows, count(*) AS keys FROM charges")(lambda s, d: gold.fact_cost_usage(lines(s, d)).agg(F.count("*").alias("rows"), F.countDistinct("cost_usage_sk").alias("keys")))
query("dq19", f"SELECT billing_month AS period, count(*) AS rows, {_SUM} AS BilledCost, CAST(sum(ListCost) AS DOUBLE) AS ListCost FROM charges GROUP BY ALL")(
    lambda s, d: audit.money_snapshot(charges(s, d).select("billing_month", "BilledCost", "ListCost"))
)
query("dq20", "SELECT billing_month AS period, count(*) FILTER (SkuId <> '7') AS right_rows, count(*) AS left_rows FROM charges GROUP BY ALL HAVING count(*) FILTER (SkuId = '7') > 0")(
    lambda s, d: audit.compare_money(
        audit.money_snapshot(charges(s, d).select("billing_month", "BilledCost")), audit.money_snapshot(charges(s, d).where("SkuId <> '7'").select("billing_month", "BilledCost"))
    ).select("period", "left_rows", "right_rows")
)
query("dq21", """SELECT billing_month AS subject, 'daily and monthly' AS finding FROM charges GROUP BY billing_month HAVING count(DISTINCT SkuId = '7') > 1
    UNION ALL SELECT billing_month, 'several monthly files' FROM charges WHERE SkuId = '7' GROUP BY billing_month HAVING count(DISTINCT _source_file) > 1""")(
    lambda s, d: audit.lineage(charges(s, d).withColumn("_source_type", F.when(F.col("SkuId") == "7", "MONTHLY").otherwise("DAILY")))
)
query("dq22", "SELECT count(*) AS orphans FROM (SELECT DISTINCT ResourceId, t FROM (SELECT ResourceId, unnest([application_code, env_tag]) AS t, SkuId FROM charges) GROUP BY ALL HAVING bool_and(t = 'e0'))")(
    lambda s, d: audit.orphans(gold.bridge_resource_tag(lines(s, d)), gold.dim_tag(lines(s, d)).where("tag_value <> 'e0'"), "tag_sk").agg(F.count("*").alias("orphans"))
)
query("jn11", "SELECT count(*) AS orphans FROM charges WHERE SkuId = '7'")(
    lambda s, d: audit.orphans(star(s, d).fact, gold.dim_sku(lines(s, d)).where("sku_id <> '7'"), "sku_sk").agg(F.count("*").alias("orphans"))
)


def wrong_keys(s, d):
    """A dimension in which one category's keys are those of another version, and another's rows stand twice."""
    dimension = gold.dim_charge_type(lines(s, d))
    key = F.when(F.col("charge_category") == "Usage", F.sha2("charge_type_sk", 256)).otherwise(F.col("charge_type_sk"))
    faulty = dimension.withColumn("charge_type_sk", key).union(dimension.where("charge_category = 'Adjustment'"))
    return audit.rehash(faulty, "charge_type_sk", surrogate_key("charge_type", "charge_category", F.lit(UNKNOWN), "charge_frequency"))


query("dq23", """WITH k AS (SELECT DISTINCT ChargeCategory AS c, sha256('charge_type||' || ChargeCategory || '||Unknown||' || ChargeFrequency) AS k FROM charges)
    SELECT sha256(k) AS charge_type_sk, 'wrong hash' AS finding FROM k WHERE c = 'Usage' UNION ALL SELECT k, 'not unique' FROM k WHERE c = 'Adjustment'""")(wrong_keys)
query("dq24", f"SELECT count(*) AS rows, {_SUM} AS billed_cost, CAST(0 AS BIGINT) AS orphans FROM charges")(
    lambda s, d: star(s, d)
    .fact.join(gold.dim_charge_type(lines(s, d)).select("charge_type_sk", F.lit(True).alias("_has")), "charge_type_sk", "left")
    .agg(F.count("*").alias("rows"), F.sum("billed_cost").alias("billed_cost"), F.count_if(F.col("_has").isNull()).alias("orphans"))
)


def conserved(s, d):
    g = star(s, d)
    month = lambda df, c, n: df.groupBy("billing_month").agg(F.sum(c).alias(n))
    out = month(g.lines, "BilledCost", "silver_cost")
    for df, c, n in ((g.fact, "billed_cost", "fact_cost"), (g.allocation, "BilledCost", "view_cost"), (marts.cost_by_scope_service_month(g), "total_billed_cost", "mart_cost")):
        out = out.join(month(df, c, n), "billing_month", "full_outer")
    return out


query("dq25", f"SELECT billing_month, {', '.join(f'{_SUM} AS {n}_cost' for n in ('silver', 'fact', 'view', 'mart'))} FROM charges GROUP BY ALL")(conserved)
query("dq26", f"""SELECT billing_month, round(100 * CAST(sum(measured_usage_rows) AS DOUBLE) / sum(usage_rows), 2) AS coverage_percent,
    CASE WHEN sum(measured_usage_rows) = sum(usage_rows) THEN 'COMPLETE' WHEN sum(measured_usage_rows) = 0 THEN 'NONE' ELSE 'PARTIAL' END AS coverage_status
    FROM ({_CONSUMPTION}) GROUP BY ALL""")(lambda s, d: finance.coverage(consumption(s, d)).select("billing_month", "coverage_percent", "coverage_status"))
query("agg20", f"SELECT billing_month, round(100 * CAST(sum(measured_usage_rows) AS DOUBLE) / sum(usage_rows), 2) AS coverage_percent FROM ({_CONSUMPTION}) GROUP BY ALL")(
    lambda s, d: finance.coverage(consumption(s, d)).select("billing_month", "coverage_percent")
)
_KEYS = ["billing_month", "application_code", "service_name", "sku_id", "consumed_unit"]


def changed_consumption(s, d):
    """Differences after the quantity of one SKU is doubled and another's rows are lost; null units are equal to null units."""
    left = consumption(s, d)
    right = left.where("sku_id <> '9'").withColumn("consumed_quantity", F.when(F.col("sku_id") == "7", F.col("consumed_quantity") * 2).otherwise(F.col("consumed_quantity")))
    return differences(left, right, _KEYS, ["consumed_quantity"]).select(*_KEYS, "difference")


_CHANGED = f"""SELECT {', '.join(_KEYS)}, CASE WHEN sku_id = '9' THEN 'left only' ELSE 'changed' END AS difference FROM ({_CONSUMPTION})
    WHERE sku_id = '9' OR (sku_id = '7' AND consumed_quantity IS NOT NULL AND consumed_quantity <> 0)"""
for _name in ("dq27", "jn8"):
    query(_name, _CHANGED)(changed_consumption)
_USAGE = ", ".join(finance.USAGE_KEYS)
query(
    "dq28",
    f"""SELECT {_USAGE}, 'left only' AS difference, CAST(1 AS BIGINT) AS left_count, CAST(0 AS BIGINT) AS right_count FROM
    (SELECT *, strftime(usage_start_time, '%Y-%m') AS usage_month FROM usage WHERE record_type = 'RETRACTION') GROUP BY ALL""",
)(
    lambda s, d: differences(
        finance.net_usage(usage(s, d)), finance.net_usage(usage(s, d).where("record_type = 'ORIGINAL'")), finance.USAGE_KEYS, ["net_quantity", "billing_records"]
    ).select(*finance.USAGE_KEYS, "difference", "left_count", "right_count")
)


def faulty_platform(s, d):
    """Daily costs with one service's rows doubled, and months that lack another service."""
    days = merged(s, d)
    months = finance.monthly_from_daily(days).where("service <> 'view'")
    return audit.platform_findings(days.union(days.where("service = 'click'")), months, finance.monthly_from_daily, finance.COST_KEYS)


query("dq29", """WITH p(provider) AS (VALUES ('GCP'), ('Databricks')), u AS (SELECT sku_name, CAST(usage_start_time AS DATE) AS day, strftime(usage_start_time, '%Y-%m') AS month FROM usage)
    SELECT 'duplicate day' AS finding, provider, count(DISTINCT day) AS rows FROM u, p WHERE sku_name = 'click' GROUP BY ALL
    UNION ALL SELECT 'months differ from days', provider, count(DISTINCT (month, sku_name)) FROM u, p WHERE sku_name IN ('click', 'view') GROUP BY ALL""")(faulty_platform)


def faulty_bill(s, d):
    """A bill in which a label names somebody, one has a quantity, one provider's label is the other's, and one is of the wrong provider."""
    service = F.col("service")
    return finance.bill_daily(_export(s, d)).withColumns(
        {
            "usage_unit": F.lit(""),
            "usage_quantity": F.when(service == "click", 1).cast("decimal(38,2)"),
            "provider": F.when(service == "error", "Databricks").otherwise(F.col("provider")),
            "service": F.when(service == "view", "a@b").when(service == "signup", "Databricks").otherwise(service),
        }
    )


_FAULTS = {"service": "view", "bill_quantity": "click", "marketplace_label": "error", "own_label": "signup"}
query("dq30", "SELECT " + ", ".join(
    f"count(DISTINCT CAST(usage_start_time AS DATE)) FILTER (sku_name = '{_FAULTS[r]}') AS {r}" if r in _FAULTS else f"CAST(0 AS BIGINT) AS {r}"
    for r in audit.PLATFORM_RULES
) + " FROM usage")(lambda s, d: contract.count_violations(faulty_bill(s, d), audit.platform_cost_rules()))
query("dq31", "SELECT count(*) FILTER (ts BETWEEN TIMESTAMP '2024-01-13 00:00:00' AND TIMESTAMP '2024-01-15 00:05:00') AS fresh, count(*) AS events FROM events")(
    lambda s, d: table(s, d, "events").agg(
        F.count_if(audit.fresh(F.col("ts").cast("timestamp"), F.lit("2024-01-15 00:00:00").cast("timestamp"))).alias("fresh"), F.count("*").alias("events")
    )
)


def changed_copy(s, d):
    """A copy of the orders that lost every tenth and types a column otherwise."""
    orders = table(s, d, "orders")
    return audit.same_copy(orders, orders.where("o_orderkey % 10 <> 0").withColumn("o_custkey", F.col("o_custkey").cast("string")))


query("dq32", """SELECT '*' AS subject, 'rows' AS difference, CAST(count(*) AS VARCHAR) AS here, CAST(count(*) FILTER (o_orderkey % 10 <> 0) AS VARCHAR) AS there FROM orders
    UNION ALL SELECT 'o_custkey', 'changed', 'bigint', 'string'""")(changed_copy)
query("dq33", f"SELECT m AS billing_month, status AS there FROM {_STATUS} WHERE status <> 'OPEN' AND m NOT IN (SELECT billing_month FROM charges WHERE SkuId = '7')")(
    lambda s, d: audit.closed_elsewhere(
        charges(s, d).where("SkuId = '7'").select("billing_month", F.lit("CLOSED").alias("status")).distinct(), month_status(s), CLOSED
    ).select("billing_month", "there")
)

# --- scoping
NOW = "2024-06-01 00:00:00"
GRANTS = [
    ("demo", "owner", "prod", "APPLICATION_OWNER", "APPLICATION", "APP1", True, None, None),
    ("demo", "owner", "prod", "APPLICATION_OWNER", "APPLICATION", "APP2", True, "2024-01-01", "2024-12-31"),
    ("demo", "owner", "prod", "APPLICATION_OWNER", "APPLICATION", "APP3", True, "2025-01-01", None),
    ("demo", "owner", "prod", "DOMAIN_MANAGER", "DOMAIN", "D1", True, None, None),
    ("demo", "owner", "prod", "SUBDOMAIN_MANAGER", "SUBDOMAIN", "S7", False, None, None),
    ("demo", "admin", "prod", "FINOPS_ADMIN", "ALL", "*", True, None, None),
]


def grants(s):
    rows = s.createDataFrame(
        GRANTS, "identity_provider string, principal_id string, environment string, role string, scope_type string, scope_id string, is_active boolean, valid_from string, valid_to string"
    )
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in ("valid_from", "valid_to")})


def scopes(s, d):
    return scopes_of(serving_rows(s, d).select("application_code").distinct())


def scopes_of(apps):
    """Applications of the lines: domain by number modulo 3, subdomain modulo 10; APP4 is mapped twice."""
    number = F.regexp_extract("application_code", r"\d+", 0).cast("int")
    one = apps.select(
        F.lit("prod").alias("environment"), "application_code", F.concat(F.lit("D"), (number % 3).cast("string")).alias("domain_id"),
        F.concat(F.lit("S"), (number % 10).cast("string")).alias("subdomain_id"), F.lit(True).alias("is_active"),
    )
    return one.union(one.where("application_code = 'APP4'").withColumn("domain_id", F.lit("D2")))


def serving_rows(s, d):
    return serving.serving_lines(star(s, d).allocation)


def mine(s, principal: str):
    return scoping.entitlements_of(grants(s), "demo", principal, "prod", F.lit(NOW).cast("timestamp"))


# APP1, APP2 by grant; D1 holds numbers 1, 4, 7, ..., 19, but APP4 is ambiguous
_VISIBLE = "application_code IN ('APP1', 'APP2', 'APP7', 'APP10', 'APP13', 'APP16', 'APP19')"
query("sec1", f"SELECT billing_month, count(*) AS charge_lines, {_SUM} AS billed_cost FROM charges WHERE {_VISIBLE} GROUP BY ALL")(
    lambda s, d: scoping.scoped(serving_rows(s, d), mine(s, "owner"), scopes(s, d), "prod")
    .groupBy("billing_month")
    .agg(F.count("*").alias("charge_lines"), F.sum("billed_cost").alias("billed_cost"))
)
query("sec1b", f"SELECT count(*) AS charge_lines, {_SUM} AS billed_cost FROM charges")(
    lambda s, d: scoping.scoped(serving_rows(s, d), mine(s, "admin"), scopes(s, d), "prod").agg(F.count("*").alias("charge_lines"), F.sum("billed_cost").alias("billed_cost"))
)
query("sec4", f"SELECT count(*) AS charge_lines, {_SUM} AS billed_cost FROM charges WHERE application_code = 'APP7'")(
    lambda s, d: scoping.scoped(serving_rows(s, d), mine(s, "owner"), scopes(s, d), "prod")
    .where("application_code = 'APP7'")
    .agg(F.count("*").alias("charge_lines"), F.sum("billed_cost").alias("billed_cost"))
)
_APPS = f"SELECT DISTINCT application_code FROM charges WHERE {_VISIBLE}"
for _name in ("jn13", "jn14", "agg12"):
    query(_name, _APPS)(lambda s, d: scoping.visible_applications(mine(s, "owner"), scopes(s, d), "prod"))


def entitlements(s, d):
    """An entitlement for each customer, by its number, with wrong types, padded and starred scopes, and some twice."""
    n = F.col("c_custkey")
    pick = lambda *values: F.element_at(F.array(*values), (n % len(values) + 1).cast("int"))
    at = lambda day: F.lit(day).cast("timestamp")
    scope = pick(F.concat(F.lit("APP"), n % 20), F.concat(F.lit("D"), n % 3), F.concat(F.lit("S"), n % 10), F.lit("*"))
    copies = F.explode(F.when(n % 19 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")
    return table(s, d, "customer").select("c_custkey", copies).select(
        F.lit("demo").alias("identity_provider"),
        F.concat(F.lit("p"), n).alias("principal_id"),
        F.lit("prod").alias("environment"),
        pick(*map(F.lit, ("APPLICATION_OWNER", "DOMAIN_MANAGER", "SUBDOMAIN_MANAGER", "FINOPS_ADMIN"))).alias("role"),
        F.when(n % 11 == 0, "DOMAIN").otherwise(pick(*map(F.lit, ("APPLICATION", "DOMAIN", "SUBDOMAIN", "ALL")))).alias("scope_type"),
        F.concat(F.when(n % 13 == 0, " ").otherwise(""), F.when(n % 17 == 0, "*").otherwise(scope)).alias("scope_id"),
        (n % 7 != 0).alias("is_active"),
        F.when(n % 5 == 0, at("2025-01-01")).when(n % 5 != 1, at("2024-01-01")).alias("valid_from"),
        F.when(n % 6 == 0, at("2024-03-01")).when(n % 6 != 1, at("2024-12-31")).alias("valid_to"),
    )


def now():
    return F.lit(NOW).cast("timestamp")


query("sec2", """WITH m AS (SELECT principal_id, role, scope_type, scope_id, count(*) AS n FROM live_entitlements GROUP BY ALL),
    t(role, kind) AS (VALUES ('FINOPS_ADMIN', 'ALL'), ('APPLICATION_OWNER', 'APPLICATION'), ('DOMAIN_MANAGER', 'DOMAIN'), ('SUBDOMAIN_MANAGER', 'SUBDOMAIN'))
    SELECT * FROM (SELECT principal_id, scope_type, scope_id, CASE WHEN scope_type <> kind THEN 'role and scope type' WHEN scope_id <> trim(scope_id) THEN 'scope'
      WHEN (role = 'FINOPS_ADMIN') <> (scope_id = '*') THEN 'star' WHEN n > 1 THEN 'duplicate' END AS finding FROM m JOIN t USING (role)) WHERE finding IS NOT NULL""")(
    lambda s, d: scoping.invalid_entitlements(entitlements(s, d).where(scoping.live(now())), "principal_id").select("principal_id", "scope_type", "scope_id", "finding")
)
query("sec3", "SELECT application_code, CAST(2 AS BIGINT) AS mappings FROM charges WHERE application_code = 'APP4' GROUP BY ALL")(lambda s, d: scoping.ambiguous_scopes(scopes(s, d), "prod"))
query("flt4", "SELECT role, count(*) AS live FROM live_entitlements GROUP BY ALL")(
    lambda s, d: entitlements(s, d).where(scoping.live(now())).groupBy("role").agg(F.count("*").alias("live"))
)
_MATCHES = """SELECT 'p' || c_custkey AS principal_id, (SELECT count(*) FROM live_entitlements e WHERE e.principal_id = 'p' || c_custkey
    AND e.role = 'APPLICATION_OWNER' AND e.scope_type = 'APPLICATION' AND e.scope_id = 'APP' || (c_custkey % 20)) AS matches FROM customer WHERE c_custkey % 4 = 0"""


def assignments(s, d):
    """Every fourth customer should own an application; how many live entitlements say so."""
    n = F.col("c_custkey")
    expected = table(s, d, "customer").where(n % 4 == 0).select(
        F.lit("demo").alias("identity_provider"), F.concat(F.lit("p"), n).alias("principal_id"), F.lit("prod").alias("environment"),
        F.lit("APPLICATION_OWNER").alias("role"), F.lit("APPLICATION").alias("scope_type"), F.concat(F.lit("APP"), n % 20).alias("scope_id"),
    )
    return scoping.assignment_matches(expected, entitlements(s, d), now()).select("principal_id", "matches")


query("jn17", _MATCHES)(assignments)
query("sec5", f"SELECT * FROM ({_MATCHES}) WHERE matches <> 1")(lambda s, d: assignments(s, d).where("matches <> 1"))


def served(s, d):
    """Serving rows against their source: rows and four cost columns, by center."""
    a = star(s, d).allocation.groupBy(F.col("cost_center_allocated").alias("cost_center")).agg(F.count("*").alias("rows"), *(F.sum(c).alias(c) for c in audit.MONEY))
    renamed = dict(zip(("billed_cost", "effective_cost", "list_cost", "contracted_cost"), audit.MONEY))
    b = serving_rows(s, d).groupBy("cost_center").agg(F.count("*").alias("rows"), *(F.sum(c).alias(n) for c, n in renamed.items()))
    return a.join(b, "cost_center", "left_semi").select("cost_center", "rows", "BilledCost", F.lit(differences(a, b, ["cost_center"], ["rows", *audit.MONEY]).isEmpty()).alias("equal"))


for _name in ("sec6", "jn7"):
    query(_name, f"SELECT cost_center, count(*) AS rows, {_SUM} AS BilledCost, true AS equal FROM allocation GROUP BY ALL")(served)
