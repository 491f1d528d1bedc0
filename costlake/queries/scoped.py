"""The reports of one viewer: every serving query over the lines that scoping leaves, with the twin over the same lines.

The viewer holds two applications by name and a domain; an admin-only report is registered
for an admin and, with the suffix _refused, for this viewer, who gets no row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import scoping
from ..plans import finance, serving
from .checks import mine, reconciliations, runs, scopes, serving_rows
from .finance import _CONSUMPTION, consumption
from .products import M, _SAVINGS, _SUM, _SUMMARY, rounded
from .registry import query


def viewer_rows(s, d, principal: str = "owner"):
    return scoping.scoped(serving_rows(s, d), mine(s, principal), scopes(s, d), "prod")


def viewer_consumption(s, d, principal: str = "owner"):
    rows = consumption(s, d).withColumn("environment", F.lit("prod"))
    return scoping.scoped(rows, mine(s, principal), scopes(s, d), "prod").drop("environment")


#: Columns of a report that are compared to six decimals.
RATES = {
    "executive_summary": ("month_change", "month_change_rate", "average_cost_per_resource", "average_cost_per_service"),
    "savings_summary": ("savings_rate",),
    "monthly_savings": ("savings_rate",),
}


def report(name: str):
    return lambda s, d: rounded(serving.VIEWER_REPORTS[name](viewer_rows(s, d), M), *RATES.get(name, ()))


def totals(columns: str, keys: str, where: str = "", limit: int | None = None, more: str = "", rows: str = "mine_charges") -> str:
    cut = f"ORDER BY sum(BilledCost) DESC, {keys} LIMIT {limit}" if limit else ""
    return f"SELECT {columns}, {_SUM} AS total_billed_cost{more} FROM {rows} {where} GROUP BY ALL {cut}"


_MONTH = f"WHERE billing_month = '{M}'"
_RESOURCE = "x_ResourceGroupName AS resource_group_name, 'Unknown' AS resource_name, Region AS region"
_COUNT = ", count(DISTINCT ResourceId) AS resource_count"
_OWNER = "'Unknown' AS application_owner_id, 'Unknown' AS application_owner_email, 'Unknown' AS application_business_owner, application_code, 'Unknown' AS application_name"
_HISTORY = f"""WITH m AS (SELECT billing_month, {_SUMMARY} FROM mine_charges GROUP BY ALL), h AS (SELECT *, lag(billed_cost) OVER (ORDER BY billing_month) AS p FROM m)
    SELECT charge_lines, active_resources AS resources, consumed_services AS services, billed_cost, effective_cost, list_cost, total_savings_vs_list AS savings_vs_list,
    p AS previous_billed_cost, round(billed_cost - p, 6) AS month_change, round(100 * ((billed_cost - p) / abs(nullif(p, 0))), 6) AS month_change_rate,
    round(billed_cost / active_resources, 6) AS average_cost_per_resource, round(billed_cost / consumed_services, 6) AS average_cost_per_service
    FROM h WHERE billing_month = '{M}'"""
_SAVED = f"(SELECT billing_month, {_SAVINGS} FROM mine_allocation GROUP BY ALL)"

TWINS_OF_REPORTS = {
    "qry1": ("months", "SELECT DISTINCT billing_month FROM mine_charges"),
    "qry4": ("executive_summary", _HISTORY),
    "qry5": ("monthly_trend", f"SELECT billing_month, {_SUM} AS monthly_billed_cost FROM mine_charges GROUP BY ALL"),
    "qry6": (
        "executive_history",
        f"""SELECT billing_month, count(*) AS charge_lines, {_SUM} AS billed_cost, CAST(sum(EffectiveCost) AS DOUBLE) AS effective_cost,
        CAST(sum(ListCost) AS DOUBLE) AS list_cost, CAST(sum(ListCost) - sum(EffectiveCost) AS DOUBLE) AS savings_vs_list FROM mine_charges GROUP BY ALL""",
    ),
    "qry7": ("daily_trend", f"SELECT CAST(CAST(ChargePeriodStart AS DATE) AS VARCHAR) AS date, {_SUM} AS daily_billed_cost FROM mine_charges {_MONTH} GROUP BY ALL"),
    "qry8": (
        "savings_summary",
        f"SELECT list_cost, contracted_cost, effective_cost, negotiated_savings, total_savings_vs_list AS total_savings, savings_rate FROM {_SAVED} {_MONTH}",
    ),
    "qry9": ("monthly_savings", f"SELECT *, total_savings_vs_list AS total_savings FROM {_SAVED}"),
    "qry10": ("services", totals("ServiceName AS service_name", "1", _MONTH, 15)),
    "qry11": ("cost_centers", totals("cost_center", "1", _MONTH, 20, rows="mine_allocation")),
    "qry12": ("charge_types", totals("ChargeCategory AS charge_category, ChargeFrequency AS charge_frequency", "1, 2", _MONTH)),
    "qry13": ("resources", totals(_RESOURCE, "1, 2, 3 NULLS FIRST", _MONTH, 25)),
    "qry14": ("resource_groups", totals("x_ResourceGroupName AS resource_group_name", "1", _MONTH, 25, _COUNT)),
    "qry15": ("subscriptions", totals("SubAccountId AS subscription_id, 'Unknown' AS subscription_name", "1", _MONTH, more=_COUNT)),
    "qry16": ("application_owners", totals(_OWNER, "1, 2, 3, 4, 5", _MONTH, 50, _COUNT)),
    "qry17": ("portfolio_services", totals("ServiceName AS service_name", "1", limit=30)),
    "qry18": ("portfolio_resources", totals(_RESOURCE, "1, 2, 3 NULLS FIRST", limit=30)),
    "qry19": ("sku_costs", totals("SkuId AS sku_id, CAST(NULL AS VARCHAR) AS meter_category, CAST(NULL AS VARCHAR) AS meter_name", "1", limit=50)),
}
for _name, (_report, _sql) in TWINS_OF_REPORTS.items():
    query(f"{_name}_scoped", _sql)(report(_report))

_MINE = f"(SELECT * FROM ({_CONSUMPTION.replace('FROM allocation', 'FROM mine_allocation')}))"
query("qry2_scoped", f"SELECT DISTINCT billing_month FROM {_MINE}")(lambda s, d: serving.months(viewer_consumption(s, d)))
query(
    "qry3_scoped",
    f"""SELECT service_name, consumed_unit, sum(consumed_quantity) AS consumed_quantity, CAST(sum(usage_rows) AS BIGINT) AS usage_rows,
    CAST(sum(measured_usage_rows) AS BIGINT) AS measured_usage_rows, CAST(sum(missing_measurement_rows) AS BIGINT) AS missing_measurement_rows,
    CAST(sum(negative_quantity_rows) AS BIGINT) AS negative_quantity_rows, min(first_loaded_charge_date) AS first_loaded_charge_date,
    max(last_loaded_charge_date) AS last_loaded_charge_date FROM {_MINE} WHERE billing_month BETWEEN '1998-01' AND '1998-12' GROUP BY ALL""",
)(lambda s, d: finance.reaggregate(serving.in_year(viewer_consumption(s, d), 1998), ["service_name", "consumed_unit"]))

# --- for admins only
_QUALITY = f"""SELECT count(*) AS total_rows, count(*) FILTER (BilledCost IS NULL) AS billed_cost_nulls, count(*) FILTER (BillingCurrency IS NULL) AS currency_nulls,
    count(*) FILTER (ServiceName IS NULL) AS service_nulls, CAST(1 AS BIGINT) AS batches, '2024-01-01 00:00:00' AS latest_silver_load,
    CAST(100 AS DOUBLE) AS critical_completeness_rate FROM charges {_MONTH}"""
_LOG = """(SELECT 'env' || (user_id % 3) AS environment, event_type AS pipeline_name, strftime(ts, '%Y-%m') AS billing_month,
    CASE WHEN value > 20 THEN 'SUCCESS' ELSE 'FAILED' END AS status, date_trunc('second', ts) AS started_at, event_id FROM events WHERE user_id % 3 = 1)"""
ADMIN_REPORTS = {
    "qry20": (_QUALITY, lambda s, d, who: serving.quality_of(viewer_rows(s, d, who), M)),
    "qry21": (
        f"""SELECT CAST(event_id AS VARCHAR) AS run_id, pipeline_name, status FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name, billing_month
        ORDER BY started_at DESC, CAST(event_id AS VARCHAR) DESC) AS n FROM {_LOG}) WHERE n = 1 ORDER BY started_at DESC, run_id LIMIT 30""",
        lambda s, d, who: serving.latest_runs(runs(s, d), "env1").select("run_id", "pipeline_name", "status"),
    ),
    "qry22": (
        f"""SELECT billing_month, CASE status WHEN 'SUCCESS' THEN 'PASSED' ELSE 'FAILED' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY billing_month
        ORDER BY started_at DESC, event_id DESC) AS n FROM {_LOG}) WHERE n = 1 ORDER BY 1 DESC LIMIT 24""",
        lambda s, d, who: serving.latest_reconciliations(reconciliations(s, d), "env1").select("billing_month", "status"),
    ),
    "qry23": (
        f"""SELECT environment, count(*) AS total_runs, count(*) FILTER (status = 'SUCCESS') AS successful_runs, CAST(max(started_at) AS VARCHAR) AS latest_run
        FROM {_LOG} GROUP BY ALL""",
        lambda s, d, who: serving.run_counts(runs(s, d).where("environment = 'env1'")),
    ),
}
for _name, (_sql, _build) in ADMIN_REPORTS.items():
    query(f"{_name}_scoped", _sql)(lambda s, d, build=_build: scoping.for_admins(build(s, d, "admin"), mine(s, "admin")))
    query(f"{_name}_refused", f"SELECT count(*) AS shown FROM ({_sql}) WHERE false")(
        lambda s, d, build=_build: scoping.for_admins(build(s, d, "owner"), mine(s, "owner")).agg(F.count("*").alias("shown"))
    )
