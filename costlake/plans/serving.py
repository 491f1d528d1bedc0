"""Serving queries: reports over scoped charge lines, or over marts of the same shape.

A report never sees rows outside the viewer's scope: scoping happens on lines, before any
aggregate. Top-k reports carry k as a parameter and end ties by the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.expressions import APPLICATION_TAGS, UNKNOWN, blank_to_null, cost_component, displayed_center, known, ratio, tag_map
from .marts import OWNER, savings_of, top



def serving_lines(allocation: DataFrame, environment: str = "prod", application_tags: dict[str, str] = APPLICATION_TAGS) -> DataFrame:
    """Charge lines as the reports read them; the tags are parsed once a line."""
    tagged = allocation.withColumn("_tags", tag_map())
    tag = lambda name: blank_to_null(F.element_at("_tags", F.lit(application_tags[name])))
    return tagged.select(
        F.lit(environment).alias("environment"),
        "billing_month",
        F.to_date("ChargePeriodStart").alias("date"),
        F.col("ResourceId").alias("resource_id"),
        known("ResourceName").alias("resource_name"),
        known("x_ResourceGroupName").alias("resource_group_name"),
        F.col("Region").alias("region"),
        F.col("ServiceName").alias("service_name"),
        F.col("cost_center_allocated").alias("cost_center"),
        "cost_center_source",
        "allocation_method",
        "allocation_policy_version",
        known("SubAccountId").alias("subscription_id"),
        known("SubAccountName").alias("subscription_name"),
        F.col("SkuId").alias("sku_id"),
        F.col("x_SkuMeterCategory").alias("meter_category"),
        F.col("x_SkuMeterName").alias("meter_name"),
        F.col("ChargeCategory").alias("charge_category"),
        F.col("ChargeFrequency").alias("charge_frequency"),
        tag("application_code").alias("application_code"),
        *(F.coalesce(tag(n), F.lit(UNKNOWN)).alias(n) for n in application_tags if n != "application_code"),
        F.col("BilledCost").alias("billed_cost"),
        F.col("EffectiveCost").alias("effective_cost"),
        F.col("ListCost").alias("list_cost"),
        F.col("ContractedCost").alias("contracted_cost"),
        F.col("BillingCurrency").alias("billing_currency"),
        F.col("_ingestion_run_id").alias("ingestion_run_id"),
        F.col("_ingested_at").alias("ingested_at"),
        cost_component().alias("effective_cost_component"),
    )


def months(rows: DataFrame) -> DataFrame:
    return rows.where("billing_month is not null").select("billing_month").distinct().orderBy(F.desc("billing_month"))


def in_month(rows: DataFrame, month: str) -> DataFrame:
    """A predicate on the partition column itself."""
    return rows.where(F.col("billing_month") == month)


def in_year(rows: DataFrame, year: int) -> DataFrame:
    """A range on the partition column, so that other years are not read."""
    return rows.where((F.col("billing_month") >= f"{year:04}-01") & (F.col("billing_month") <= f"{year:04}-12"))


def executive_summary(summary: DataFrame, month: str) -> DataFrame:
    """One month of the executive mart with its change against the month before. The window runs over one row a month."""
    history = summary.withColumn("previous_billed_cost", F.lag("billed_cost").over(W.orderBy("billing_month")))
    change = F.col("billed_cost") - F.col("previous_billed_cost")
    return in_month(history, month).select(
        "charge_lines",
        F.col("active_resources").alias("resources"),
        F.col("consumed_services").alias("services"),
        "billed_cost",
        "effective_cost",
        "list_cost",
        F.col("total_savings_vs_list").alias("savings_vs_list"),
        "previous_billed_cost",
        change.alias("month_change"),
        (100 * ratio(change, F.abs("previous_billed_cost"))).alias("month_change_rate"),
        ratio(F.col("billed_cost"), F.col("active_resources"), 0.0).alias("average_cost_per_resource"),
        ratio(F.col("billed_cost"), F.col("consumed_services"), 0.0).alias("average_cost_per_service"),
    )


def executive_history(summary: DataFrame) -> DataFrame:
    return summary.select(
        "billing_month", "charge_lines", "billed_cost", "effective_cost", "list_cost", F.col("total_savings_vs_list").alias("savings_vs_list")
    ).orderBy("billing_month")


def daily_trend(daily: DataFrame, month: str) -> DataFrame:
    """Days of a month by a date range, so that other days are not read."""
    first = F.to_date(F.lit(month + "-01"))
    return daily.where((F.col("date") >= first) & (F.col("date") < F.add_months(first, 1))).orderBy("date")


def savings_summary(savings: DataFrame, month: str) -> DataFrame:
    return in_month(savings, month).select(
        "list_cost", "contracted_cost", "effective_cost", "negotiated_savings", F.col("total_savings_vs_list").alias("total_savings"), "savings_rate"
    )


def monthly_savings(savings: DataFrame) -> DataFrame:
    return savings.withColumn("total_savings", F.col("total_savings_vs_list")).orderBy("billing_month")


def totals(rows: DataFrame, keys: list[str], amount: str = "billed_cost", limit: int | None = None) -> DataFrame:
    """Totals by keys, largest first; nulls of a key are a group."""
    summed = rows.groupBy(*keys).agg(F.sum(amount).alias("total_billed_cost"))
    return top(summed, limit, *keys) if limit else summed.orderBy(F.desc("total_billed_cost"), *(F.asc_nulls_first(k) for k in keys))


def cost_centers(by_scope: DataFrame, month: str, limit: int = 20) -> DataFrame:
    return totals(in_month(by_scope, month).withColumn("cost_center", displayed_center("cost_center")), ["cost_center"], "total_billed_cost", limit)


def data_quality(quality: DataFrame, month: str) -> DataFrame:
    nulls = F.col("billed_cost_nulls") + F.col("currency_nulls") + F.col("service_nulls")
    rate = F.when(F.col("total_rows") == 0, 0.0).otherwise(100 * (1 - nulls.cast("double") / (3 * F.col("total_rows"))))
    return in_month(quality, month).drop("billing_month").withColumn("critical_completeness_rate", rate)


def latest(rows: DataFrame, keys: list[str], at: str, *ties: str) -> DataFrame:
    """The newest row of each key."""
    order = W.partitionBy(*keys).orderBy(F.desc(at), *(F.desc(t) for t in ties))
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def latest_runs(runs: DataFrame, environment: str, limit: int = 30) -> DataFrame:
    newest = latest(runs.where(F.col("environment") == environment), ["environment", "pipeline_name", "billing_month"], "started_at", "run_id")
    return top(newest, limit, "run_id", by="started_at").select("run_id", "pipeline_name", "billing_month", "status", "started_at", "finished_at", "message")


def latest_reconciliations(found: DataFrame, environment: str, limit: int = 24) -> DataFrame:
    newest = latest(found.where(F.col("environment") == environment), ["environment", "billing_month"], "reconciled_at", "run_id")
    return top(newest, limit, by="billing_month").select(
        "billing_month", "status", "billing_rows", "after_rows", "after_billing_difference", "reconciled_at"
    )


def run_counts(runs: DataFrame) -> DataFrame:
    return (
        runs.groupBy("environment")
        .agg(F.count("*").alias("total_runs"), F.count_if(F.col("status") == "SUCCESS").alias("successful_runs"), F.max("started_at").alias("latest_run"))
        .orderBy("environment")
    )


def comparable_years(monthly: DataFrame, base_year: int, year: int) -> DataFrame:
    """Totals of two years over the month numbers that both have, and the change against the base; null if the base is 0."""
    split = monthly.select(F.substring("billing_month", 1, 4).alias("year"), F.substring("billing_month", 6, 2).alias("month"), "monthly_billed_cost")
    both = split.where(F.col("year").isin(str(base_year), str(year)))
    shared = both.groupBy("month").agg(F.countDistinct("year").alias("n")).where("n = 2").select("month")
    kept = both.join(shared, "month", "left_semi")
    side = lambda y: F.sum(F.when(F.col("year") == str(y), F.col("monthly_billed_cost")))
    sums = kept.agg(F.countDistinct("month").alias("months"), side(base_year).alias("base_total"), side(year).alias("total"))
    return sums.withColumn("change_rate", 100 * ratio(F.col("total") - F.col("base_total"), F.abs("base_total")))


def top_service_share(by_service: DataFrame) -> DataFrame:
    """The largest service of a month and its share of the month's total; by_service has one row a service."""
    total = by_service.agg(F.sum("total_billed_cost").alias("month_total"))
    first = top(by_service, 1, "service_name")
    return first.crossJoin(F.broadcast(total)).withColumn("share", 100 * ratio(F.col("total_billed_cost"), F.abs("month_total")))


def center_coverage(by_center: DataFrame) -> DataFrame:
    """Share of the total that has a cost center."""
    allocated = F.sum(F.when(F.col("cost_center") != "Unallocated Costs", F.col("total_billed_cost")))
    sums = by_center.agg(F.coalesce(allocated, F.lit(0)).alias("allocated_cost"), F.sum("total_billed_cost").alias("total_cost"))
    return sums.withColumn("coverage", 100 * ratio(F.col("allocated_cost"), F.abs("total_cost")))


def concentration(resources: DataFrame, first: int = 5) -> DataFrame:
    """Share of the first resources in the total of the resources shown; resources is a bounded top-k report."""
    shown = resources.agg(F.sum("total_billed_cost").alias("shown_total"))
    leading = top(resources, first, "resource_group_name", "resource_name", "region").agg(F.sum("total_billed_cost").alias("leading_total"))
    return leading.crossJoin(F.broadcast(shown)).withColumn("concentration", 100 * ratio(F.col("leading_total"), F.abs("shown_total")))


def cost_bridge(savings: DataFrame) -> DataFrame:
    """From list to effective cost in steps, and whether the steps can be stacked, that is, none is negative."""
    steps = F.array(
        F.struct(F.lit(1).alias("step"), F.lit("list_cost").alias("name"), F.col("list_cost").cast("double").alias("amount")),
        F.struct(F.lit(2).alias("step"), F.lit("negotiated_savings").alias("name"), (-F.col("negotiated_savings")).cast("double").alias("amount")),
        F.struct(F.lit(3).alias("step"), F.lit("commitment_savings").alias("name"), (-F.col("commitment_savings")).cast("double").alias("amount")),
        F.struct(F.lit(4).alias("step"), F.lit("effective_cost").alias("name"), F.col("effective_cost").cast("double").alias("amount")),
    )
    stackable = F.least("list_cost", "negotiated_savings", "commitment_savings", "effective_cost") >= 0
    return savings.select("billing_month", stackable.alias("stackable"), F.inline(steps))


# --- the same reports for one viewer: rows are serving lines that scoping has restricted to what the viewer may see


def summary_of(rows: DataFrame) -> DataFrame:
    """The executive mart's columns over the viewer's lines."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    sums = rows.where("billing_month is not null").groupBy("billing_month").agg(
        F.count("*").alias("charge_lines"),
        F.countDistinct("resource_id").alias("active_resources"),
        F.countDistinct("service_name").alias("consumed_services"),
        *map(total, ("billed_cost", "effective_cost", "list_cost")),
    )
    return sums.withColumn("total_savings_vs_list", F.col("list_cost") - F.col("effective_cost"))


def savings_by_month(rows: DataFrame) -> DataFrame:
    return savings_of(
        rows.where("billing_month is not null"), ["billing_month"], F.col("effective_cost_component"), ("list_cost", "contracted_cost", "effective_cost")
    )


def monthly_billing_of(rows: DataFrame) -> DataFrame:
    sums = rows.where("billing_month is not null").groupBy("billing_month")
    return sums.agg(F.coalesce(F.sum("billed_cost"), F.lit(0)).alias("monthly_billed_cost")).orderBy("billing_month")


def daily_billing_of(rows: DataFrame, month: str) -> DataFrame:
    return in_month(rows, month).groupBy("date").agg(F.sum("billed_cost").alias("daily_billed_cost")).orderBy("date")


def grouped_resources(rows: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """totals() with the number of distinct resources."""
    sums = rows.groupBy(*keys).agg(F.sum("billed_cost").alias("total_billed_cost"), F.countDistinct("resource_id").alias("resource_count"))
    return top(sums, limit, *keys) if limit else sums.orderBy(F.desc("total_billed_cost"), *(F.asc_nulls_first(k) for k in keys))


def centers_of(rows: DataFrame, month: str, limit: int = 20) -> DataFrame:
    return totals(in_month(rows, month).withColumn("cost_center", displayed_center("cost_center")), ["cost_center"], limit=limit)


def quality_of(rows: DataFrame, month: str) -> DataFrame:
    """Nulls and batches of a month's lines; one row, of zeros where the viewer has none."""
    nulls = lambda c: F.count_if(F.col(c).isNull())
    counted = in_month(rows, month).agg(
        F.lit(month).alias("billing_month"),
        F.count("*").alias("total_rows"),
        nulls("billed_cost").alias("billed_cost_nulls"),
        nulls("billing_currency").alias("currency_nulls"),
        nulls("service_name").alias("service_nulls"),
        F.countDistinct("ingestion_run_id").alias("batches"),
        F.max("ingested_at").alias("latest_silver_load"),
    )
    return data_quality(counted, month)


RESOURCES = ["resource_group_name", "resource_name", "region"]
#: Reports of one viewer by their name: functions of the viewer's lines and a month.
VIEWER_REPORTS = {
    "months": lambda rows, month: months(rows),
    "executive_summary": lambda rows, month: executive_summary(summary_of(rows), month),
    "monthly_trend": lambda rows, month: monthly_billing_of(rows),
    "executive_history": lambda rows, month: executive_history(summary_of(rows)),
    "daily_trend": daily_billing_of,
    "savings_summary": lambda rows, month: savings_summary(savings_by_month(rows), month),
    "monthly_savings": lambda rows, month: monthly_savings(savings_by_month(rows)),
    "services": lambda rows, month: totals(in_month(rows, month), ["service_name"], limit=15),
    "cost_centers": centers_of,
    "charge_types": lambda rows, month: totals(in_month(rows, month), ["charge_category", "charge_frequency"]),
    "resources": lambda rows, month: totals(in_month(rows, month), RESOURCES, limit=25),
    "resource_groups": lambda rows, month: grouped_resources(in_month(rows, month), ["resource_group_name"], 25),
    "subscriptions": lambda rows, month: grouped_resources(in_month(rows, month), ["subscription_id", "subscription_name"]),
    "application_owners": lambda rows, month: grouped_resources(in_month(rows, month), OWNER, 50),
    "portfolio_services": lambda rows, month: totals(rows, ["service_name"], limit=30),
    "portfolio_resources": lambda rows, month: totals(rows, RESOURCES, limit=30),
    "sku_costs": lambda rows, month: totals(rows, ["sku_id", "meter_category", "meter_name"], limit=50),
}


def telemetry_by_month(usage_view: DataFrame) -> DataFrame:
    """net_usage() by month; to be shown to admins only (scoping.for_admins)."""
    return usage_view.groupBy("usage_month").agg(F.sum("net_quantity").alias("net_quantity"), F.sum("billing_records").alias("billing_records")).orderBy(
        F.desc("usage_month")
    )
