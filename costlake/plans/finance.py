"""Consumption, priced usage, platform costs and the carbon scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import APPLICATION_TAGS, blank_to_null, month_of, normalized_unit, sum_or_null, tag_map
from ..operators.joins import overlap_join, validity_join
from .serving import latest

CONSUMPTION_KEYS = ["billing_month", "application_code", "service_name", "sku_id", "consumed_unit"]


def consumption(allocation: DataFrame, application_tags: dict[str, str] = APPLICATION_TAGS) -> DataFrame:
    """Net usage by month, application, service, SKU and unit. A quantity without a unit is no measurement, not zero."""
    rows = allocation.where(F.col("ChargeCategory") == "Usage").select(
        "billing_month",
        blank_to_null(F.element_at(tag_map(), F.lit(application_tags["application_code"]))).alias("application_code"),
        F.col("ServiceName").alias("service_name"),
        F.col("SkuId").alias("sku_id"),
        normalized_unit("ConsumedUnit").alias("consumed_unit"),
        F.col("ConsumedQuantity").alias("quantity"),
        F.to_date("ChargePeriodStart").alias("day"),
    )
    unit, quantity = F.col("consumed_unit"), F.col("quantity")
    return rows.groupBy(*CONSUMPTION_KEYS).agg(
        F.sum(F.when(unit.isNotNull(), quantity)).alias("consumed_quantity"),
        F.count("*").alias("usage_rows"),
        F.count_if(quantity.isNotNull() & unit.isNotNull()).alias("measured_usage_rows"),
        F.count_if(quantity.isNull() | unit.isNull()).alias("missing_measurement_rows"),
        F.count_if((quantity < 0) & unit.isNotNull()).alias("negative_quantity_rows"),
        F.min("day").alias("first_loaded_charge_date"),
        F.max("day").alias("last_loaded_charge_date"),
    )


def reaggregate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """consumption() by fewer keys: sums of sums, least and greatest dates."""
    return rows.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in ("consumed_quantity", "usage_rows", "measured_usage_rows", "missing_measurement_rows", "negative_quantity_rows")),
        F.min("first_loaded_charge_date").alias("first_loaded_charge_date"),
        F.max("last_loaded_charge_date").alias("last_loaded_charge_date"),
    )


def latest_month_sample(rows: DataFrame, limit: int = 20) -> DataFrame:
    """The first groups of the newest month; the newest month is one row."""
    newest = rows.agg(F.max("billing_month").alias("billing_month"))
    return rows.join(F.broadcast(newest), "billing_month", "left_semi").orderBy(*(F.asc_nulls_first(k) for k in CONSUMPTION_KEYS)).limit(limit)


def coverage(rows: DataFrame) -> DataFrame:
    """How many usage rows were measured, by month; mixed units are counted, never summed."""
    sums = rows.groupBy("billing_month").agg(F.sum("usage_rows").alias("usage_rows"), F.sum("measured_usage_rows").alias("measured_usage_rows"))
    percent = F.round(100 * F.col("measured_usage_rows").cast("double") / F.nullif("usage_rows", F.lit(0)), 2)
    label = F.when(F.col("usage_rows") == 0, "EMPTY").when(F.col("measured_usage_rows") == F.col("usage_rows"), "COMPLETE").when(
        F.col("measured_usage_rows") == 0, "NONE"
    )
    return sums.withColumns({"coverage_percent": percent, "coverage_status": label.otherwise("PARTIAL")})


#: What a row of net_usage() stands for.
USAGE_KEYS = ["usage_month", "workspace_id", "sku_name", "billing_origin_product", "usage_unit"]


def net_usage(records: DataFrame, labels: dict[int, str] | None = None, free_skus: tuple[str, ...] = ()) -> DataFrame:
    """Net quantity by month, workspace, SKU and product; corrections stay in the sum. Workspaces without a label have none."""
    label = F.lit(None).cast("string")
    for workspace, name in (labels or {}).items():
        label = F.when(F.col("workspace_id") == workspace, name).otherwise(label)
    return (
        records.withColumn("usage_month", month_of("usage_start_time"))
        .groupBy(*USAGE_KEYS)
        .agg(
            F.sum("usage_quantity").alias("net_quantity"),
            F.count("*").alias("billing_records"),
            F.min(F.to_date("usage_start_time")).alias("first_available_usage_date"),
            F.max(F.to_date("usage_start_time")).alias("last_available_usage_date"),
        )
        .withColumns({"workspace_label": label, "is_free_usage": F.col("sku_name").isin(*free_skus) if free_skus else F.lit(False)})
    )


def usage_availability(records: DataFrame) -> DataFrame:
    return records.groupBy("workspace_id").agg(
        F.count("*").alias("billing_records"),
        F.count_if(F.col("record_type") != "ORIGINAL").alias("correction_records"),
        F.count_if(F.col("usage_quantity") < 0).alias("negative_records"),
        F.min("usage_start_time").alias("first_usage"),
        F.max("usage_end_time").alias("last_usage"),
    )


PRICE_KEYS = ["cloud", "sku_name", "usage_unit"]


def unit_prices(records: DataFrame, prices: DataFrame, currency: str = "USD") -> DataFrame:
    """Each record with unit_price: that of the one price row that covers the whole record.

    Null where no row or several match, a matching row counting whether or not it names a
    price, or where nine decimals cannot hold the price exactly.
    """
    offered = prices.where(F.col("currency_code") == currency).withColumn("_matched", F.lit(True))
    joined = validity_join(records, offered, PRICE_KEYS, "usage_start_time", "price_start_time", "price_end_time", "usage_end_time")
    exact, wide = F.min(F.col("price").try_cast("decimal(18,9)")), F.min(F.col("price").try_cast("decimal(38,18)"))
    return joined.groupBy("record_id", F.to_date("usage_start_time").alias("usage_date"), "sku_name", "usage_quantity").agg(
        F.when((F.count("_matched") == 1) & (exact == wide), exact).alias("unit_price")
    )


def priced_daily(records: DataFrame, prices: DataFrame, currency: str = "USD") -> DataFrame:
    """Daily cost at list prices; a day with a record without a unit price is unknown, that is, null."""
    by_record = unit_prices(records, prices, currency)
    cost = F.col("usage_quantity").try_cast("decimal(30,18)") * F.col("unit_price")
    return by_record.groupBy("usage_date", month_of("usage_date").alias("month"), F.col("sku_name").alias("service")).agg(
        sum_or_null(cost).cast("decimal(38,16)").alias("cost_before_credits"), F.sum("usage_quantity").alias("usage_quantity")
    ).withColumns(
        {
            "provider": F.lit("Databricks"),
            "currency": F.lit(currency),
            "credits": F.lit(None).cast("decimal(38,12)"),
            "usage_unit": F.lit("DBU"),
            "cost_basis": F.lit("list_estimate"),
            "period_status": F.lit("partial"),
        }
    )


def exact_run_cost(records: DataFrame, prices: DataFrame, run: str = "user_id") -> DataFrame:
    """Units and list cost of each run by SKU, priced at the end of usage."""
    joined = validity_join(records, prices, PRICE_KEYS, "usage_end_time", "price_start_time", "price_end_time")
    cost = F.col("usage_quantity").cast("decimal(18,2)") * F.col("price")
    return joined.groupBy(run, "sku_name", "usage_unit", "currency_code").agg(
        F.round(F.sum("usage_quantity"), 6).alias("consumed_units"), F.round(F.sum(cost), 4).alias("list_cost")
    )


def prorated_run_cost(records: DataFrame, windows: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage in the share that overlaps a run's window, then priced."""
    shared = overlap_join(records, windows, "usage_start_time", "usage_end_time", "run_start_time", "run_end_time")
    length = F.greatest(F.lit(1), F.unix_timestamp("usage_end_time") - F.unix_timestamp("usage_start_time"))
    estimated = shared.withColumn("estimated", F.col("usage_quantity").cast("double") * F.col("overlap_seconds") / length)
    joined = validity_join(estimated, prices, PRICE_KEYS, "usage_end_time", "price_start_time", "price_end_time")
    return joined.groupBy("run_id", "sku_name", "usage_unit", "currency_code").agg(
        F.round(F.sum("estimated"), 6).alias("estimated_units"), F.round(F.sum(F.col("estimated") * F.col("price").cast("double")), 4).alias("estimated_list_cost")
    )


def recent_runs(timeline: DataFrame, definitions: DataFrame, limit: int = 20) -> DataFrame:
    """timeline: job_id, run_id, period_start_time, period_end_time, result_state; definitions: job_id, name, change_time, delete_time."""
    current = latest(definitions, ["job_id"], "change_time").where("delete_time is null").select("job_id", "name")
    runs = timeline.groupBy("job_id", "run_id").agg(
        F.min("period_start_time").alias("run_start_time"),
        F.max("period_end_time").alias("run_end_time"),
        F.max_by("result_state", F.struct("period_end_time", "result_state")).alias("result_state"),
    )
    elapsed = F.unix_timestamp("run_end_time") - F.unix_timestamp("run_start_time")
    return runs.join(current, "job_id").withColumn("elapsed_seconds", elapsed).orderBy(F.desc("run_start_time"), "job_id", "run_id").limit(limit)


def task_durations(tasks: DataFrame) -> DataFrame:
    """tasks: task_key, period_start_time, period_end_time, result_state, compute_ids (array)."""
    return tasks.groupBy("task_key").agg(
        F.min("period_start_time").alias("task_start_time"),
        F.max("period_end_time").alias("task_end_time"),
        F.sum(F.unix_timestamp("period_end_time") - F.unix_timestamp("period_start_time")).alias("execution_seconds"),
        F.max_by("result_state", F.struct("period_end_time", "result_state")).alias("result_state"),
        F.sort_array(F.flatten(F.collect_set("compute_ids"))).alias("compute_ids"),
    )


def row_net_credit(credits: str = "credits"):
    """Sum of the amounts in an array of credits; 0 for none."""
    return F.aggregate(F.coalesce(F.col(credits), F.array()), F.lit(0).cast("decimal(38,9)"), lambda a, c: (a + c["amount"]).cast("decimal(38,9)"))


def bill_daily(export: DataFrame, provider: str = "GCP") -> DataFrame:
    """export: usage_date, service, currency, cost, credits (array of struct<amount>)."""
    return (
        export.withColumn("_credit", row_net_credit())
        .groupBy("usage_date", month_of("usage_date").alias("month"), "service", "currency")
        .agg(F.sum("cost").alias("cost_before_credits"), F.sum("_credit").alias("credits"))
        .withColumns({"provider": F.lit(provider), "cost_basis": F.lit("billing_export"), "period_status": F.lit("partial")})
    )


COST_KEYS = ["month", "provider", "service", "currency", "cost_basis"]


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """Months of daily rows: an unknown day makes its month unknown, a partial day makes it partial."""
    return daily.groupBy(*COST_KEYS).agg(
        *(sum_or_null(F.col(c)).alias(c) for c in ("cost_before_credits", "credits", "usage_quantity")),
        F.when(F.max(F.when(F.col("period_status") == "partial", 1).otherwise(0)) == 1, "partial").otherwise("closed").alias("period_status"),
    )


def reported_cost():
    """Cost after credits for a bill; the estimate itself otherwise."""
    return F.when(F.col("cost_basis") == "billing_export", F.col("cost_before_credits") + F.col("credits")).otherwise(F.col("cost_before_credits"))


def provider_totals(rows: DataFrame) -> DataFrame:
    """Total by provider: null if any part is unknown or if bases or currencies would be mixed."""
    one = (F.countDistinct("cost_basis") == 1) & (F.countDistinct("currency") == 1)
    return rows.withColumn("_cost", reported_cost()).groupBy("provider").agg(F.when(one, sum_or_null(F.col("_cost"))).alias("total"), one.alias("comparable"))


def billed_total(rows: DataFrame, providers: tuple[str, ...] = ("GCP", "Databricks")) -> DataFrame:
    """One row: the billed total, null unless every provider billed in one currency. Estimates never count."""
    billed = rows.where(F.col("cost_basis") == "billing_export").withColumn("_cost", reported_cost())
    whole = (F.countDistinct(F.when(F.col("provider").isin(*providers), F.col("provider"))) == len(providers)) & (F.countDistinct("currency") == 1)
    return billed.agg(F.when(whole, sum_or_null(F.col("_cost"))).alias("billed_total"), F.countDistinct("provider").alias("providers"))


def totals_by_month(rows: DataFrame) -> DataFrame:
    """Month and currency with each provider's cost; a total only where both have one."""
    part = lambda p: F.sum(F.when(F.col("provider") == p, F.col("cost_before_credits")))
    return rows.groupBy("month", "currency").agg(part("GCP").alias("gcp_cost"), part("Databricks").alias("databricks_cost")).withColumn(
        "total_cost", F.col("gcp_cost") + F.col("databricks_cost")
    )


# How a day of each calendar is named, and the step between its periods.
PERIODS = {"day": ("yyyy-MM-dd", "1 day"), "month": ("yyyy-MM", "1 month"), "year": ("yyyy", "1 year")}


def calendar_series(daily: DataFrame, start: str, end: str, period: str = "day", day: str = "usage_date") -> DataFrame:
    """Every day, month or year of the calendar by provider with its total; periods without rows stay null, never zero,
    and one with an unknown amount is unknown."""
    form, step = PERIODS[period]
    within = daily.where(F.col(day).between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    summed = within.groupBy("provider", F.date_format(day, form).alias("period")).agg(sum_or_null(F.col("cost_before_credits")).alias("total"))
    first = F.trunc(F.to_date(F.lit(start)), period) if period != "day" else F.to_date(F.lit(start))
    # providers are a handful of names: the calendar is repeated for each
    days = F.explode(F.sequence(first, F.to_date(F.lit(end)), F.expr(f"interval {step}")))
    grid = daily.select("provider").distinct().select("provider", days.alias("_day")).select("provider", F.date_format("_day", form).alias("period"))
    return grid.join(summed, ["provider", "period"], "left")


# Services that run virtual machines, grid intensities (g CO2e per kWh), and the wording of a status.
VM_SERVICES = ("Virtual Machines", "Virtual Machine Scale Sets")
GRID = {"europe-west1": 126, "europe-west3": 276, "europe-west9": 16}
MODELLED = "Modelled"


def carbon_scenario(
    rows: DataFrame, services: tuple[str, ...] = VM_SERVICES, watts: float = 50.0, pue: float = 1.2, region: str = "europe-west1", other: str = "europe-west3"
) -> DataFrame:
    """consumption() rows with the first reason that excludes them, else hours, energy and emissions on two grids."""
    n = {c: F.col(c) for c in ("usage_rows", "measured_usage_rows", "missing_measurement_rows", "negative_quantity_rows")}
    counters = (
        (n["usage_rows"] > 0)
        & (n["measured_usage_rows"] >= 0)
        & (n["missing_measurement_rows"] >= 0)
        & (n["negative_quantity_rows"] >= 0)
        & (n["measured_usage_rows"] + n["missing_measurement_rows"] == n["usage_rows"])
        & (n["negative_quantity_rows"] <= n["measured_usage_rows"])
    )
    quantity = F.col("consumed_quantity").cast("double")
    no_sku = F.col("sku_id").isNull() | F.lower(F.trim("sku_id")).isin("", "unknown")
    status = (
        F.when(~F.coalesce(F.col("service_name").isin(*services), F.lit(False)), "unsupported service")
        .when(~F.coalesce(F.col("consumed_unit") == "Hours", F.lit(False)), "unsupported unit")
        .when(no_sku, "missing SKU")
        .when(~F.coalesce(counters, F.lit(False)), "invalid counters")
        .when((n["negative_quantity_rows"] > 0) | F.coalesce(quantity < 0, F.lit(False)), "signed correction")
        .when((n["missing_measurement_rows"] > 0) | quantity.isNull(), "incomplete measurements")
        .otherwise(MODELLED)
    )
    hours = F.when(F.col("scenario_status") == MODELLED, quantity)
    return (
        rows.withColumn("scenario_status", status)
        .withColumns({"modelled_usage_rows": F.when(F.col("scenario_status") == MODELLED, F.col("usage_rows")).otherwise(0), "vm_hours": hours})
        .withColumn("energy_kwh", F.col("vm_hours") * watts / 1000 * pue)
        .withColumns({"kg_co2e": F.col("energy_kwh") * GRID[region] / 1000, "comparison_kg_co2e": F.col("energy_kwh") * GRID[other] / 1000})
    )


CARBON = ["vm_hours", "energy_kwh", "kg_co2e", "comparison_kg_co2e"]


def carbon_monthly(scenario: DataFrame) -> DataFrame:
    """Months of the scenario; a month with nothing modelled stays null. The status tells whether loaded dates span the month."""
    sums = scenario.groupBy("billing_month").agg(
        F.sum("usage_rows").alias("usage_rows"),
        F.sum("modelled_usage_rows").alias("modelled_usage_rows"),
        F.min("first_loaded_charge_date").alias("first_loaded_charge_date"),
        F.max("last_loaded_charge_date").alias("last_loaded_charge_date"),
        *(F.sum(c).alias(c) for c in CARBON),
    )
    first, last = F.col("first_loaded_charge_date"), F.col("last_loaded_charge_date")
    start = F.to_date(F.concat("billing_month", F.lit("-01")))
    status = (
        F.when(first.isNull() | last.isNull(), "dates unavailable").when((first != start) | (last != F.last_day(start)), "partial dates").otherwise("full window")
    )
    return sums.withColumn("period_status", status)


def carbon_by(scenario: DataFrame, keys: list[str]) -> DataFrame:
    return scenario.groupBy(*keys).agg(F.sum("usage_rows").alias("usage_rows"), F.sum("modelled_usage_rows").alias("modelled_usage_rows"), *(F.sum(c).alias(c) for c in CARBON))
