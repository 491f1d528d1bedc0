"""Queries of consumption, priced usage, platform costs and the carbon scenario."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, scoping
from ..plans import finance, marts, serving
from ..sources.usage import RUN_END, RUN_START, list_prices, run_windows, usage
from .products import rounded
from .registry import query, star

_CONSUMPTION = """SELECT billing_month, application_code, ServiceName AS service_name, SkuId AS sku_id, unit AS consumed_unit,
    CAST(sum(CASE WHEN unit IS NOT NULL THEN ConsumedQuantity END) AS DOUBLE) AS consumed_quantity, count(*) AS usage_rows,
    count(*) FILTER (unit IS NOT NULL) AS measured_usage_rows, count(*) FILTER (unit IS NULL) AS missing_measurement_rows,
    count(*) FILTER (ConsumedQuantity < 0 AND unit IS NOT NULL) AS negative_quantity_rows, CAST(CAST(min(ChargePeriodStart) AS DATE) AS VARCHAR) AS first_loaded_charge_date,
    CAST(CAST(max(ChargePeriodStart) AS DATE) AS VARCHAR) AS last_loaded_charge_date
    FROM allocation WHERE ChargeCategory = 'Usage' GROUP BY ALL"""


def consumption(s, d):
    return finance.consumption(star(s, d).allocation)


query("fin1", _CONSUMPTION)(consumption)
query("qry2", "SELECT DISTINCT billing_month FROM charges WHERE ChargeCategory = 'Usage' ORDER BY 1 DESC")(lambda s, d: serving.months(consumption(s, d)))
query(
    "qry3",
    f"""SELECT service_name, consumed_unit, sum(consumed_quantity) AS consumed_quantity, CAST(sum(usage_rows) AS BIGINT) AS usage_rows,
    CAST(sum(measured_usage_rows) AS BIGINT) AS measured_usage_rows, CAST(sum(missing_measurement_rows) AS BIGINT) AS missing_measurement_rows,
    CAST(sum(negative_quantity_rows) AS BIGINT) AS negative_quantity_rows, min(first_loaded_charge_date) AS first_loaded_charge_date,
    max(last_loaded_charge_date) AS last_loaded_charge_date FROM ({_CONSUMPTION}) WHERE billing_month BETWEEN '1998-01' AND '1998-12' GROUP BY ALL""",
)(lambda s, d: finance.reaggregate(serving.in_year(consumption(s, d), 1998), ["service_name", "consumed_unit"]))
query("fin2", f"SELECT * FROM ({_CONSUMPTION}) WHERE billing_month = (SELECT max(billing_month) FROM allocation WHERE ChargeCategory = 'Usage') ORDER BY ALL NULLS FIRST LIMIT 20")(
    lambda s, d: finance.latest_month_sample(consumption(s, d))
)
query(
    "qry29",
    f"""SELECT billing_month, CAST(sum(usage_rows) AS BIGINT) AS usage_rows, CAST(sum(measured_usage_rows) AS BIGINT) AS measured_usage_rows,
    round(100 * CAST(sum(measured_usage_rows) AS DOUBLE) / sum(usage_rows), 2) AS coverage_percent,
    CASE WHEN sum(measured_usage_rows) = sum(usage_rows) THEN 'COMPLETE' WHEN sum(measured_usage_rows) = 0 THEN 'NONE' ELSE 'PARTIAL' END AS coverage_status
    FROM ({_CONSUMPTION}) GROUP BY ALL""",
)(lambda s, d: finance.coverage(consumption(s, d)))
_ECONOMY = "service_name = 'ECONOMY' AND consumed_unit = 'GB'"


def single_series(s, d):
    """One service, SKU and unit; the SKU is the first by name that the service has in this unit."""
    rows = consumption(s, d).where(_ECONOMY)
    first = rows.agg(F.min("sku_id").alias("sku_id"))
    return rows.join(F.broadcast(first), "sku_id", "left_semi").orderBy("billing_month").select("billing_month", "application_code", "sku_id", "consumed_quantity")


query("qry30", f"""WITH e AS (SELECT * FROM ({_CONSUMPTION}) WHERE {_ECONOMY})
    SELECT billing_month, application_code, sku_id, consumed_quantity FROM e WHERE sku_id = (SELECT min(sku_id) FROM e)""")(single_series)
LABELS, FREE = {0: "North", 1: "South"}, ("view",)
query(
    "fin3",
    """SELECT strftime(usage_start_time, '%Y-%m') AS usage_month, workspace_id, sku_name, billing_origin_product, usage_unit, CAST(sum(usage_quantity) AS DOUBLE) AS net_quantity,
    count(*) AS billing_records, CAST(CAST(min(usage_start_time) AS DATE) AS VARCHAR) AS first_available_usage_date,
    CAST(CAST(max(usage_start_time) AS DATE) AS VARCHAR) AS last_available_usage_date,
    CASE workspace_id WHEN 0 THEN 'North' WHEN 1 THEN 'South' END AS workspace_label, sku_name = 'view' AS is_free_usage FROM usage GROUP BY ALL""",
)(lambda s, d: finance.net_usage(usage(s, d), LABELS, FREE))
_TELEMETRY = """SELECT strftime(usage_start_time, '%Y-%m') AS usage_month, CAST(sum(usage_quantity) AS DOUBLE) AS net_quantity, count(*) AS billing_records FROM usage GROUP BY ALL"""


def telemetry(s, d, principal):
    from .checks import mine

    return scoping.for_admins(serving.telemetry_by_month(finance.net_usage(usage(s, d), LABELS, FREE)), mine(s, principal))


query("qry24", _TELEMETRY)(lambda s, d: telemetry(s, d, "admin"))
query("qry24_refused", f"SELECT count(*) AS shown FROM ({_TELEMETRY}) WHERE false")(lambda s, d: telemetry(s, d, "owner").agg(F.count("*").alias("shown")))
query(
    "fin4",
    """SELECT workspace_id, count(*) AS billing_records, count(*) FILTER (record_type <> 'ORIGINAL') AS correction_records,
    count(*) FILTER (usage_quantity < 0) AS negative_records, CAST(min(usage_start_time) AS VARCHAR) AS first_usage, CAST(max(usage_end_time) AS VARCHAR) AS last_usage
    FROM usage GROUP BY ALL""",
)(lambda s, d: finance.usage_availability(usage(s, d)))
query(
    "fin5",
    """SELECT user_id, u.sku_name, 'DBU' AS usage_unit, CASE WHEN p.sku_name IS NOT NULL THEN 'USD' END AS currency_code, CAST(round(sum(usage_quantity), 6) AS DOUBLE) AS consumed_units,
    CAST(round(sum(usage_quantity * price), 4) AS DOUBLE) AS list_cost
    FROM usage u LEFT JOIN list_prices p ON u.sku_name = p.sku_name AND usage_end_time >= price_start_time AND (price_end_time IS NULL OR usage_end_time < price_end_time)
    GROUP BY ALL""",
)(lambda s, d: finance.exact_run_cost(usage(s, d), list_prices(s)))
query(
    "fin6",
    f"""WITH o AS (SELECT *, CAST(usage_quantity AS DOUBLE) * (epoch(least(usage_end_time, TIMESTAMP '{RUN_END}')) - epoch(greatest(usage_start_time, TIMESTAMP '{RUN_START}'))) / 3600 AS e
    FROM usage WHERE usage_end_time > TIMESTAMP '{RUN_START}' AND usage_start_time < TIMESTAMP '{RUN_END}')
    SELECT CAST(1 AS BIGINT) AS run_id, o.sku_name, 'DBU' AS usage_unit, CASE WHEN p.sku_name IS NOT NULL THEN 'USD' END AS currency_code, round(sum(e), 6) AS estimated_units,
    round(sum(e * CAST(price AS DOUBLE)), 4) AS estimated_list_cost
    FROM o LEFT JOIN list_prices p ON o.sku_name = p.sku_name AND usage_end_time >= price_start_time AND (price_end_time IS NULL OR usage_end_time < price_end_time) GROUP BY ALL""",
)(lambda s, d: finance.prorated_run_cost(usage(s, d), run_windows(s), list_prices(s)))

_RUNS = """WITH t AS (SELECT user_id AS job_id, date_trunc('day', ts) AS run_id, date_trunc('second', ts) AS a, event_type FROM events)"""


def _timeline(s, d):
    u = usage(s, d)
    return u.select(
        F.col("user_id").alias("job_id"),
        F.to_date("usage_start_time").alias("run_id"),
        F.col("usage_start_time").alias("period_start_time"),
        F.col("usage_end_time").alias("period_end_time"),
        F.col("sku_name").alias("result_state"),
    )


def _definitions(s, d):
    """Three versions of each job; the newest of every fifth job is deleted."""
    ids = usage(s, d).select(F.col("user_id").alias("job_id")).distinct()
    versions = ids.select("job_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("version"))
    return versions.select(
        "job_id",
        F.concat(F.lit("job-"), F.col("job_id").cast("string"), F.lit("-v"), F.col("version").cast("string")).alias("name"),
        F.col("version").alias("change_time"),
        F.when((F.col("job_id") % 5 == 0) & (F.col("version") == 3), 1).alias("delete_time"),
    )


query(
    "fin7",
    f"""{_RUNS} SELECT job_id, CAST(CAST(run_id AS DATE) AS VARCHAR) AS run_id, CAST(min(a) AS VARCHAR) AS run_start_time, CAST(max(a) + INTERVAL 1 HOUR AS VARCHAR) AS run_end_time,
    arg_max(event_type, (a, event_type)) AS result_state, 'job-' || job_id || '-v3' AS name, CAST(epoch(max(a)) - epoch(min(a)) + 3600 AS BIGINT) AS elapsed_seconds
    FROM t WHERE job_id % 5 <> 0 GROUP BY job_id, t.run_id ORDER BY min(a) DESC, job_id, t.run_id LIMIT 20""",
)(lambda s, d: finance.recent_runs(_timeline(s, d), _definitions(s, d)))
query(
    "fin8",
    """SELECT event_type AS task_key, CAST(min(date_trunc('second', ts)) AS VARCHAR) AS task_start_time, CAST(max(date_trunc('second', ts)) + INTERVAL 1 HOUR AS VARCHAR) AS task_end_time,
    CAST(count(*) * 3600 AS BIGINT) AS execution_seconds, CAST(list_sort(list(DISTINCT 'c' || (user_id % 3))) AS VARCHAR) AS compute_ids FROM events GROUP BY ALL""",
)(
    lambda s, d: finance.task_durations(
        usage(s, d).select(
            F.col("sku_name").alias("task_key"),
            F.col("usage_start_time").alias("period_start_time"),
            F.col("usage_end_time").alias("period_end_time"),
            F.col("record_type").alias("result_state"),
            F.array(F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string"))).alias("compute_ids"),
        )
    ).select("task_key", "task_start_time", "task_end_time", "execution_seconds", F.concat(F.lit("["), F.array_join("compute_ids", ", "), F.lit("]")).alias("compute_ids"))
)
_DAILY_EXACT = """SELECT CAST(day AS VARCHAR) AS usage_date, strftime(day, '%Y-%m') AS month, sku_name AS service,
    CASE WHEN count(*) FILTER (unit_price IS NULL) > 0 THEN NULL ELSE sum(usage_quantity * unit_price) END AS cost_before_credits,
    sum(usage_quantity) AS usage_quantity FROM (
      SELECT record_id, CAST(usage_start_time AS DATE) AS day, u.sku_name, usage_quantity, CASE WHEN count(p.sku_name) = 1 AND min(p.price) = round(min(p.price), 9) THEN min(p.price) END AS unit_price
      FROM usage u LEFT JOIN list_prices p ON u.sku_name = p.sku_name AND usage_start_time >= price_start_time
        AND (price_end_time IS NULL OR (usage_start_time < price_end_time AND usage_end_time <= price_end_time)) GROUP BY ALL) GROUP BY ALL"""
_DAILY = f"SELECT * REPLACE (CAST(cost_before_credits AS DOUBLE) AS cost_before_credits, CAST(usage_quantity AS DOUBLE) AS usage_quantity) FROM ({_DAILY_EXACT})"


def daily(s, d):
    return finance.priced_daily(usage(s, d), list_prices(s))


query("fin9", _DAILY)(lambda s, d: daily(s, d).select("usage_date", "month", "service", "cost_before_credits", "usage_quantity"))


def _export(s, d):
    """A bill over the events: half of the value is credited in two parts for purchases."""
    value = F.col("usage_quantity").cast("decimal(18,2)")
    credit = lambda share: F.struct((value * F.lit(share).cast("decimal(4,2)")).cast("decimal(18,4)").alias("amount"))
    return usage(s, d).select(
        F.to_date("usage_start_time").alias("usage_date"),
        F.col("sku_name").alias("service"),
        F.lit("EUR").alias("currency"),
        value.alias("cost"),
        F.when(F.col("sku_name") == "purchase", F.array(credit("-0.25"), credit("-0.25"))).alias("credits"),
    )


_BILL_EXACT = """SELECT CAST(CAST(usage_start_time AS DATE) AS VARCHAR) AS usage_date, strftime(usage_start_time, '%Y-%m') AS month, sku_name AS service, 'EUR' AS currency,
    sum(usage_quantity) AS cost_before_credits, sum(CASE WHEN sku_name = 'purchase' THEN usage_quantity * CAST(-0.5 AS DECIMAL(4,2)) ELSE 0 END) AS credits,
    'GCP' AS provider, 'billing_export' AS cost_basis, 'partial' AS period_status FROM usage GROUP BY ALL"""
_BILL = f"SELECT * REPLACE (CAST(cost_before_credits AS DOUBLE) AS cost_before_credits, CAST(credits AS DOUBLE) AS credits) FROM ({_BILL_EXACT})"
query("fin10", _BILL)(lambda s, d: finance.bill_daily(_export(s, d)))
query(
    "src16",
    """SELECT sku_name AS service, CAST(sum(CASE WHEN sku_name = 'purchase' THEN usage_quantity * CAST(-0.5 AS DECIMAL(4,2)) ELSE 0 END) AS DOUBLE) AS net_credit FROM usage GROUP BY ALL""",
)(lambda s, d: _export(s, d).groupBy("service").agg(F.sum(finance.row_net_credit()).alias("net_credit")))
def exactly(df, digits, *amounts):
    """Decimal amounts rounded as decimals and cast last, so that a tie does not fall either way."""
    return df.withColumns({c: F.round(c, digits).cast("double") for c in amounts})


query(
    "fin11",
    f"""SELECT month, service, CAST(CASE WHEN count(*) FILTER (cost_before_credits IS NULL) > 0 THEN NULL ELSE round(sum(cost_before_credits), 6) END AS DOUBLE) AS cost_before_credits,
    CAST(NULL AS DOUBLE) AS credits, CAST(round(sum(usage_quantity), 6) AS DOUBLE) AS usage_quantity, 'partial' AS period_status FROM ({_DAILY_EXACT}) GROUP BY ALL""",
)(
    lambda s, d: exactly(finance.monthly_from_daily(daily(s, d)).select("month", "service", "cost_before_credits", "credits", "usage_quantity", "period_status"), 6, "cost_before_credits", "credits", "usage_quantity")
)


def merged(s, d):
    """Bill and estimate in one frame, each row in the columns of both."""
    return finance.bill_daily(_export(s, d)).unionByName(daily(s, d), allowMissingColumns=True)


query(
    "fin12",
    f"""SELECT provider, cost_basis, count(*) AS rows, count(DISTINCT month) AS months, bool_and(period_status = 'partial') AS partial_only FROM
    (SELECT provider, cost_basis, month, period_status FROM ({_BILL}) UNION ALL SELECT 'Databricks', 'list_estimate', month, 'partial' FROM ({_DAILY})) GROUP BY ALL""",
)(
    lambda s, d: merged(s, d)
    .groupBy("provider", "cost_basis")
    .agg(F.count("*").alias("rows"), F.countDistinct("month").alias("months"), F.bool_and(F.col("period_status") == "partial").alias("partial_only"))
)


def faulty_sources(s, d):
    """A manifest of 10 rows, one service billed as an estimate, clicks of another provider, errors declared closed."""
    bill = finance.bill_daily(_export(s, d)).withColumn("cost_basis", F.when(F.col("service") == "view", "list_estimate").otherwise(F.col("cost_basis")))
    estimate = daily(s, d).withColumns(
        {"provider": F.when(F.col("service") == "click", "GCP").otherwise(F.col("provider")), "period_status": F.when(F.col("service") == "error", "closed").otherwise("partial")}
    )
    return audit.export_findings(bill, estimate, 10)


query(
    "fin12b",
    f"""WITH b AS (SELECT * FROM ({_BILL})), e AS (SELECT * FROM ({_DAILY}))
    SELECT 'export' AS source, 'cost basis' AS finding, count(*) AS count FROM b WHERE service = 'view' UNION ALL SELECT 'export', 'rows beside the manifest', abs(count(*) - 10) FROM b
    UNION ALL SELECT 'estimate', 'provider', count(*) FROM e WHERE service = 'click' UNION ALL SELECT 'estimate', 'period status', count(*) FROM e WHERE service = 'error'""",
)(faulty_sources)
query(
    "fin13",
    f"""SELECT 'GCP' AS provider, CAST(round(sum(cost_before_credits + credits), 4) AS DOUBLE) AS total, true AS comparable FROM ({_BILL_EXACT})
    UNION ALL SELECT 'Databricks', CAST(CASE WHEN count(*) FILTER (cost_before_credits IS NULL) > 0 THEN NULL ELSE round(sum(cost_before_credits), 4) END AS DOUBLE), true FROM ({_DAILY_EXACT})""",
)(lambda s, d: exactly(finance.provider_totals(merged(s, d)), 4, "total"))
query("fin13b", f"SELECT CAST(NULL AS DOUBLE) AS billed_total, CAST(1 AS BIGINT) AS providers FROM (SELECT count(*) FROM ({_BILL}))")(
    lambda s, d: finance.billed_total(merged(s, d))
)
query(
    "fin14",
    f"""WITH c AS (SELECT month, currency, provider, CAST(cost_before_credits AS DECIMAL(38,12)) AS cost_before_credits FROM ({_BILL_EXACT})
    UNION ALL SELECT month, 'USD', 'Databricks', CAST(cost_before_credits AS DECIMAL(38,12)) FROM ({_DAILY_EXACT}))
    SELECT month, currency, CAST(round(sum(cost_before_credits) FILTER (provider = 'GCP'), 4) AS DOUBLE) AS gcp_cost,
    CAST(round(sum(cost_before_credits) FILTER (provider = 'Databricks'), 4) AS DOUBLE) AS databricks_cost, CAST(NULL AS DOUBLE) AS total_cost FROM c GROUP BY ALL""",
)(lambda s, d: exactly(finance.totals_by_month(merged(s, d)).select("month", "currency", "gcp_cost", "databricks_cost", "total_cost"), 4, "gcp_cost", "databricks_cost", "total_cost"))
for _name, _period, _form, _step in (("fin15", "day", "%Y-%m-%d", "1 DAY"), ("fin15_month", "month", "%Y-%m", "1 MONTH"), ("fin15_year", "year", "%Y", "1 YEAR")):
    query(
        _name,
        f"""WITH g AS (SELECT strftime(unnest(generate_series(date_trunc('{_period}', TIMESTAMP '2022-11-25'), TIMESTAMP '2024-04-10', INTERVAL {_step})), '{_form}') AS period),
        t AS (SELECT strftime(CAST(usage_date AS DATE), '{_form}') AS period, sum(cost_before_credits) AS total FROM ({_BILL_EXACT}) WHERE usage_date BETWEEN '2022-11-25' AND '2024-04-10' GROUP BY ALL)
        SELECT 'GCP' AS provider, g.period, CAST(round(total, 4) AS DOUBLE) AS total FROM g LEFT JOIN t ON g.period = t.period""",
    )(
        lambda s, d, period=_period: exactly(finance.calendar_series(finance.bill_daily(_export(s, d)), "2022-11-25", "2024-04-10", period), 4, "total")
    )
query("fin16", f"SELECT provider, service, CAST(round(sum(cost_before_credits + credits), 4) AS DOUBLE) AS total FROM ({_BILL_EXACT}) GROUP BY ALL")(
    lambda s, d: finance.bill_daily(_export(s, d))
    .groupBy("provider", "service")
    .agg(F.round(F.sum(finance.reported_cost()), 4).cast("double").alias("total"))
    .orderBy("provider", F.desc("total"), "service")
)
_SCENARIO = f"""SELECT *, CASE WHEN scenario_status = 'Modelled' THEN usage_rows ELSE 0 END AS modelled_usage_rows, CASE WHEN scenario_status = 'Modelled' THEN consumed_quantity END AS vm_hours
    FROM (SELECT *, CASE WHEN service_name NOT IN ('ECONOMY', 'STANDARD') THEN 'unsupported service' WHEN consumed_unit IS DISTINCT FROM 'Hours' THEN 'unsupported unit'
      WHEN negative_quantity_rows > 0 OR consumed_quantity < 0 THEN 'signed correction' WHEN missing_measurement_rows > 0 OR consumed_quantity IS NULL THEN 'incomplete measurements'
      ELSE 'Modelled' END AS scenario_status FROM ({_CONSUMPTION}))"""
_KG = """round(sum(vm_hours), 6) AS vm_hours, round(sum(vm_hours * 50 / 1000 * 1.2), 6) AS energy_kwh, round(sum(vm_hours * 50 / 1000 * 1.2 * 126 / 1000), 6) AS kg_co2e,
    round(sum(vm_hours * 50 / 1000 * 1.2 * 276 / 1000), 6) AS comparison_kg_co2e"""


def scenario(s, d):
    return finance.carbon_scenario(consumption(s, d), ("ECONOMY", "STANDARD"))


query(
    "fin18",
    f"""SELECT billing_month, application_code, service_name, sku_id, consumed_unit, scenario_status, CAST(modelled_usage_rows AS BIGINT) AS modelled_usage_rows,
    round(vm_hours * 50 / 1000 * 1.2 * 126 / 1000, 6) AS kg_co2e FROM ({_SCENARIO})""",
)(lambda s, d: rounded(scenario(s, d).select(*finance.CONSUMPTION_KEYS, "scenario_status", "modelled_usage_rows", "kg_co2e"), "kg_co2e"))
query(
    "fin19",
    f"""SELECT billing_month, CAST(sum(usage_rows) AS BIGINT) AS usage_rows, CAST(sum(modelled_usage_rows) AS BIGINT) AS modelled_usage_rows,
    min(first_loaded_charge_date) AS first_loaded_charge_date, max(last_loaded_charge_date) AS last_loaded_charge_date, {_KG},
    CASE WHEN min(first_loaded_charge_date) <> billing_month || '-01' OR max(last_loaded_charge_date) <> CAST(last_day(CAST(billing_month || '-01' AS DATE)) AS VARCHAR)
      THEN 'partial dates' ELSE 'full window' END AS period_status FROM ({_SCENARIO}) GROUP BY billing_month""",
)(lambda s, d: rounded(finance.carbon_monthly(scenario(s, d)), *finance.CARBON))
query(
    "fin20",
    f"""SELECT service_name, scenario_status, CAST(sum(usage_rows) AS BIGINT) AS usage_rows, CAST(sum(modelled_usage_rows) AS BIGINT) AS modelled_usage_rows, {_KG}
    FROM ({_SCENARIO}) GROUP BY ALL""",
)(lambda s, d: rounded(finance.carbon_by(scenario(s, d), ["service_name", "scenario_status"]), *finance.CARBON))


def _allocated(s, d):
    """Totals by center next to the source's by month; the allocation neither loses nor adds cost."""
    g = star(s, d)
    by_mart = marts.cost_by_scope_service_month(g).groupBy("billing_month").agg(F.sum("total_billed_cost").alias("mart_cost"))
    by_line = g.lines.groupBy("billing_month").agg(F.sum("BilledCost").alias("source_cost"), F.count("*").alias("source_rows"))
    return by_line.join(by_mart, "billing_month", "full_outer").withColumn("difference", F.col("source_cost") - F.col("mart_cost"))


query(
    "fin21",
    """SELECT billing_month, CAST(sum(BilledCost) AS DOUBLE) AS mart_cost, CAST(sum(BilledCost) AS DOUBLE) AS source_cost, count(*) AS source_rows, CAST(0 AS DOUBLE) AS difference
    FROM charges GROUP BY ALL""",
)(_allocated)
