"""The fourteen marts. Each is one aggregate over the fact table, the allocation or the clean lines.

For refreshes the sums over facts are kept as states by month and surrogate keys (STATES),
which add up: a refresh replaces the states of its months, and a mart over all months or over
dimensions that change is made from states, never from the facts of other months.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import cost_component, known, ratio
from . import gold


@dataclass
class Gold:
    """The star schema of some lines; frames are built on first use."""

    lines: DataFrame

    @cached_property
    def fact(self) -> DataFrame:
        """Without the keys of its rows, which no mart reads."""
        return gold.fact_cost_usage(self.lines, keys=False)

    @cached_property
    def allocation(self) -> DataFrame:
        return gold.cost_allocation(self.lines)

    def dimension(self, name: str) -> DataFrame:
        return gold.DIMENSIONS[name](self.lines)

    def sums(self, *keys: str) -> DataFrame:
        """billed_cost summed by keys of the facts."""
        return self.fact.groupBy(*keys).agg(F.sum("billed_cost").alias("billed_cost"))

    def summed(self, joins: list[tuple[str, str]], *kept: str, take: list[str]) -> DataFrame:
        """billed_cost summed by the keys of joins (dimension, key) and kept, with the attributes take of the dimensions.

        The sums come first: a dimension meets a row for each of its keys, not each line. Keys
        are said by their parts, which take far fewer bytes than hashes, and attributes that
        are parts need no dimension; only Type 1 attributes are looked up.
        """
        out = self.summed_parts(joins, *kept)
        for name, key in joins:
            more = self.looked_up(name, key, take)
            if more:
                out = out.join(gold.newest(self.lines, key, more), list(gold.PARTS[key]()))
        return out

    def summed_parts(self, joins: list[tuple[str, str]], *kept: str) -> DataFrame:
        parts = {n: c for _, key in joins for n, c in gold.PARTS[key]().items()}
        cost = F.col("BilledCost").alias("billed_cost")
        return self.lines.select(*kept, *(c.alias(n) for n, c in parts.items()), cost).groupBy(*kept, *parts).agg(F.sum("billed_cost").alias("billed_cost"))

    @staticmethod
    def looked_up(name: str, key: str, take: list[str]) -> list[str]:
        """Those of take that the dimension has and the parts of its key do not tell."""
        return [n for n in take if n in TYPE1.get(name, ()) and n not in gold.PARTS[key]()]


#: Type 1 attributes of the dimensions that have some.
TYPE1 = {"dim_resource": (*gold.RESOURCE, *gold.APPLICATION_TAGS), "dim_billing_scope": (*gold.SCOPE,)}
#: States of the facts, by month and these keys. Sums over fewer keys are sums of the smallest state that has them.
STATES = {
    "state_day": ["charge_period_start_date_sk"],
    "state_service": ["service_sk"],
    "state_sku": ["sku_sk"],
    "state_charge_type": ["charge_type_sk"],
    "state_resource": ["resource_sk", "location_sk", "billing_scope_sk"],
}


def state(fact: DataFrame, name: str) -> DataFrame:
    return fact.groupBy("billing_month", *STATES[name]).agg(F.sum("billed_cost").alias("billed_cost"))


def state_resource(lines: DataFrame) -> DataFrame:
    """The largest state from lines, by the parts of its keys, brought together by month before they become hashes."""
    keys = STATES["state_resource"]
    sums = Gold(lines).summed_parts([("", key) for key in keys], "billing_month").hint("rebalance", "billing_month")
    return sums.select("billing_month", *(gold.key_of_parts(key).alias(key) for key in keys), "billed_cost")


def state_for(keys: tuple[str, ...]) -> str:
    """The state with the fewest keys that has these."""
    return min((n for n, own in STATES.items() if set(keys) <= {"billing_month", *own}), key=lambda n: len(STATES[n]))


RESOURCE, LOCATION, SERVICE = ("dim_resource", "resource_sk"), ("dim_location", "location_sk"), ("dim_service", "service_sk")


def _billed(name: str = "total_billed_cost") -> Column:
    return F.sum("billed_cost").alias(name)


def monthly_billing(g: Gold) -> DataFrame:
    return g.sums("billing_month").withColumnRenamed("billed_cost", "monthly_billed_cost")


def daily_billing(g: Gold) -> DataFrame:
    # aggregated by key first: the join then meets a row a day
    by_key = g.sums("charge_period_start_date_sk").withColumnsRenamed({"charge_period_start_date_sk": "date_sk", "billed_cost": "daily_billed_cost"})
    return by_key.join(g.dimension("dim_date"), "date_sk").select("date", "daily_billed_cost")


def cost_by_scope_service_month(g: Gold) -> DataFrame:
    keys = [
        "billing_month",
        F.col("cost_center_allocated").alias("cost_center"),
        known("x_CustomerName").alias("customer_name"),
        known("ServiceCategory").alias("service_category"),
        known("ServiceName").alias("service_name"),
    ]
    return g.allocation.groupBy(*keys).agg(F.sum("BilledCost").alias("total_billed_cost"))


def top(df: DataFrame, limit: int, *ties: str, by: str = "total_billed_cost") -> DataFrame:
    """The rows with the largest amounts; ties end by the given columns."""
    return df.orderBy(F.desc(by), *(F.asc_nulls_first(t) for t in ties)).limit(limit)


def top_services(g: Gold, limit: int = 30) -> DataFrame:
    keys = ["service_category", "service_name"]
    return top(g.summed([SERVICE], take=keys).groupBy(*keys).agg(_billed()), limit, *keys)


def top_resources(g: Gold, limit: int = 100) -> DataFrame:
    keys = ["resource_group_name", "resource_name", "region"]
    return top(g.summed([RESOURCE, LOCATION], take=keys).groupBy(*keys).agg(_billed()), limit, *keys)


def cost_by_charge_type(g: Gold) -> DataFrame:
    keys = ["charge_category", "charge_frequency"]
    return g.summed([("dim_charge_type", "charge_type_sk")], "billing_month", take=keys).groupBy("billing_month", *keys).agg(_billed())


def sku_cost(g: Gold, limit: int = 100) -> DataFrame:
    keys = ["sku_id", "meter_category", "meter_name"]
    return top(g.summed([("dim_sku", "sku_sk")], take=keys).groupBy(*keys).agg(_billed()), limit, *keys)


def savings_of(
    lines: DataFrame, keys: list[str], component: Column | None = None, costs: tuple[str, str, str] = ("ListCost", "ContractedCost", "EffectiveCost")
) -> DataFrame:
    """List, contracted and effective cost by keys, their differences, and the effective cost by component."""
    component = cost_component() if component is None else component
    part = lambda name: F.coalesce(F.sum(F.when(component == name, F.col(costs[2])).otherwise(0)), F.lit(0))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = lines.groupBy(*keys).agg(
        *(total(c).alias(n) for c, n in zip(costs, ("list_cost", "contracted_cost", "effective_cost"))),
        *(part(c).alias(c) for c in ("reservation", "savings_plan", "usage_on_demand", "usage_dynamic", "adjustment")),
        part("other").alias("other_effective_cost"),
    )
    saved = F.col("list_cost") - F.col("effective_cost")
    return sums.withColumns(
        {
            "negotiated_savings": F.col("list_cost") - F.col("contracted_cost"),
            "commitment_savings": F.col("contracted_cost") - F.col("effective_cost"),
            "total_savings_vs_list": saved,
            "savings_rate": 100 * ratio(saved, F.col("list_cost"), 0.0),
        }
    )


def savings_monthly(g: Gold) -> DataFrame:
    return savings_of(g.lines.where("billing_month is not null"), ["billing_month"])


def executive_summary_monthly(g: Gold) -> DataFrame:
    """Distinct resources and services are rows of sums by resource and by service, so that no line is expanded."""
    costs = {"billed_cost": "BilledCost", "effective_cost": "EffectiveCost", "list_cost": "ListCost"}
    both = g.lines.where("billing_month is not null").groupBy("billing_month", "ResourceId", "ServiceName").agg(
        F.count("*").alias("charge_lines"), *(F.sum(c).alias(n) for n, c in costs.items())
    )
    sums = lambda df, *keys: df.groupBy("billing_month", *keys)
    by_resource = sums(both, "ResourceId").agg(F.sum("charge_lines").alias("charge_lines"), *(F.sum(n).alias(n) for n in costs))
    resources = sums(by_resource).agg(
        F.sum("charge_lines").alias("charge_lines"), F.count("ResourceId").alias("active_resources"), *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in costs)
    )
    services = sums(both.select("billing_month", "ServiceName").distinct()).agg(F.count("ServiceName").alias("consumed_services"))
    return resources.join(services, "billing_month").select(
        "billing_month", "charge_lines", "active_resources", "consumed_services", *costs, (F.col("list_cost") - F.col("effective_cost")).alias("total_savings_vs_list")
    )


def top_resources_monthly(g: Gold) -> DataFrame:
    keys = ["resource_group_name", "resource_name", "region"]
    return g.summed([RESOURCE, LOCATION], "billing_month", take=keys).groupBy("billing_month", *keys).agg(_billed())


def data_quality_monthly(g: Gold) -> DataFrame:
    nulls = lambda c: F.count_if(F.col(c).isNull())
    return (
        g.lines.where("billing_month is not null")
        .groupBy("billing_month")
        .agg(
            F.count("*").alias("total_rows"),
            nulls("BilledCost").alias("billed_cost_nulls"),
            nulls("BillingCurrency").alias("currency_nulls"),
            nulls("ServiceName").alias("service_nulls"),
            F.countDistinct("_ingestion_run_id").alias("batches"),
            F.max("_ingested_at").alias("latest_silver_load"),
        )
    )


def _with_resources(g: Gold, keys: dict[str, str], *joins: tuple[str, str]) -> DataFrame:
    """Cost and resources by month and keys, attributes with the names that they get."""
    out = g.summed([RESOURCE, *joins], "billing_month", take=["resource_id", *keys])
    return out.groupBy("billing_month", *(F.col(a).alias(n) for a, n in keys.items())).agg(_billed(), F.countDistinct("resource_id").alias("resource_count"))


def cost_by_resource_group_month(g: Gold) -> DataFrame:
    return _with_resources(g, {"resource_group_name": "resource_group_name"})


def cost_by_subscription_month(g: Gold) -> DataFrame:
    return _with_resources(g, {"sub_account_id": "subscription_id", "sub_account_name": "subscription_name"}, ("dim_billing_scope", "billing_scope_sk"))


OWNER = ["application_owner_id", "application_owner_email", "application_business_owner", "application_code", "application_name"]


def cost_by_application_owner_month(g: Gold) -> DataFrame:
    return _with_resources(g, {n: n for n in OWNER})


MARTS: dict[str, Callable[[Gold], DataFrame]] = {
    "dm_monthly_billing": monthly_billing,
    "dm_daily_billing": daily_billing,
    "dm_cost_by_scope_service_month": cost_by_scope_service_month,
    "dm_top_services": top_services,
    "dm_top_resources": top_resources,
    "dm_cost_by_charge_type": cost_by_charge_type,
    "dm_sku_cost": sku_cost,
    "dm_savings_monthly": savings_monthly,
    "dm_executive_summary_monthly": executive_summary_monthly,
    "dm_top_resources_monthly": top_resources_monthly,
    "dm_data_quality_monthly": data_quality_monthly,
    "dm_cost_by_resource_group_month": cost_by_resource_group_month,
    "dm_cost_by_subscription_month": cost_by_subscription_month,
    "dm_cost_by_application_owner_month": cost_by_application_owner_month,
}

#: Marts by month from the lines of the month; by month from states and dimensions; over all months from states and dimensions.
OF_LINES = ("dm_cost_by_scope_service_month", "dm_savings_monthly", "dm_executive_summary_monthly", "dm_data_quality_monthly")
OF_MONTHS = (
    "dm_monthly_billing dm_cost_by_charge_type dm_top_resources_monthly dm_cost_by_resource_group_month dm_cost_by_subscription_month dm_cost_by_application_owner_month"
).split()
OF_ALL = ("dm_daily_billing", "dm_top_services", "dm_top_resources", "dm_sku_cost")
