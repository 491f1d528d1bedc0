"""Registered queries and their SQL twins.

A query's frame is reported in plain types: decimals as doubles, dates and times as text,
integers as long. Its twin casts alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contract import canonical, conform
from ..plans.marts import Gold
from ..sources.charges import charges

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    def cast(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            return c.cast("double").alias(name)
        if kind in ("date", "timestamp", "timestamp_ntz"):
            return c.cast("string").alias(name)
        return c.cast("long").alias(name) if kind in ("int", "smallint", "tinyint") else c

    return df.select(*(cast(n, k) for n, k in df.dtypes))


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir); sql is its twin, which may use the relations of BASE."""

    def add(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql:
            TWINS[name] = twin(sql)
        return f

    return add


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean lines of the test tables, as the daily load leaves them."""
    loaded = charges(spark, sf_dir).withColumns(
        {"_ingestion_run_id": F.concat(F.lit("run-"), F.col("billing_month")), "_ingested_at": F.lit("2024-01-01 00:00:00").cast("timestamp")}
    )
    return canonical(conform(loaded))


def star(spark: SparkSession, sf_dir: str) -> Gold:
    return Gold(lines(spark, sf_dir))


# The relations of the twins. Their names, labels and lists are those of sources/charges.py, sources/usage.py and
# functions/expressions.py, said once more in SQL, so that a change there shows as a difference.
CHARGES = """
charges AS (
  SELECT
    l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-' || strftime(l_shipdate, '%Y-%m-%d') AS x_ChargeId,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS BillingPeriodStart,
    CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS BillingPeriodEnd,
    CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ChargePeriodStart,
    CAST(CAST(l_shipdate AS DATE) + 1 AS TIMESTAMP) AS ChargePeriodEnd,
    strftime(l_shipdate, '%Y-%m') AS billing_month,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS ListCost,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS ContractedCost,
    CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 - CAST(l_tax AS DECIMAL(4,2))) AS EffectiveCost,
    CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS BilledCost,
    CASE WHEN l_returnflag = 'R' THEN 'Adjustment' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Purchase' ELSE 'Usage' END AS ChargeCategory,
    CASE WHEN l_returnflag = 'R' THEN 'One-Time' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'Recurring' ELSE 'Usage-Based' END AS ChargeFrequency,
    CASE l_linenumber % 3 WHEN 0 THEN 'On-Demand' WHEN 1 THEN 'Commitment-Based' ELSE 'Dynamic' END AS PricingCategory,
    CASE WHEN l_linenumber % 3 = 1 THEN CASE WHEN l_suppkey % 2 = 0 THEN 'Reservation' ELSE 'Savings Plan' END END AS CommitmentDiscountType,
    p_type AS ServiceName, p_brand AS ServiceCategory, CAST(l_partkey AS VARCHAR) AS SkuId,
    'res-' || l_suppkey || '-' || (l_partkey % 50) AS ResourceId, 'rg-' || (l_suppkey % 10) AS x_ResourceGroupName,
    CAST(o_custkey AS VARCHAR) AS SubAccountId, n_name AS BillingAccountId,
    CASE r_name WHEN 'EUROPE' THEN ' West Europe ' WHEN 'AMERICA' THEN 'Global' WHEN 'ASIA' THEN 'South India' WHEN 'MIDDLE EAST' THEN 'UAE North' END AS Region,
    CASE c_mktsegment WHEN 'BUILDING' THEN ' CostCenter_APAC ' WHEN 'MACHINERY' THEN 'Unknown' WHEN 'FURNITURE' THEN '' END AS x_CostCenter,
    CASE p_size % 4 WHEN 0 THEN 'Hours' WHEN 1 THEN 'GB' WHEN 2 THEN ' Unknown ' END AS ConsumedUnit,
    CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS DECIMAL(18,2)) AS ConsumedQuantity,
    'APP' || (o_custkey % 20) AS application_code, 'e' || (o_custkey % 3) AS env_tag,
    '{"application-code":"APP' || (o_custkey % 20) || '","env":" e' || (o_custkey % 3) || ' "}' AS Tags,
    'EUR' AS BillingCurrency, 'Microsoft' AS ProviderName,
    'daily/' || strftime(l_shipdate, '%Y/%m/%Y-%m-%d') || '.parquet' AS _source_file
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

ALLOCATION = """
allocation AS (
  SELECT *,
    CASE allocation_method WHEN 'SOURCE' THEN trim(x_CostCenter) WHEN 'REGION_EUROPE' THEN 'CostCenter_Europe'
      WHEN 'GLOBAL_CORPORATE' THEN 'CostCenter_Corporate' ELSE 'Unallocated Costs' END AS cost_center
  FROM (
    SELECT *,
      CASE WHEN lower(trim(coalesce(x_CostCenter, ''))) NOT IN ('', 'unknown', 'unallocated', 'unallocated costs', 'no cost center assigned') THEN 'SOURCE'
        WHEN lower(trim(coalesce(Region, ''))) IN ('west europe', 'north europe', 'france central', 'sweden central', 'uk south') THEN 'REGION_EUROPE'
        WHEN lower(trim(coalesce(Region, ''))) = 'global' THEN 'GLOBAL_CORPORATE' ELSE 'UNALLOCATED' END AS allocation_method,
      coalesce(nullif(trim(Region), ''), 'Unknown') AS region_name,
      CASE WHEN ChargeCategory = 'Adjustment' THEN 'adjustment'
        WHEN ChargeCategory = 'Usage' AND PricingCategory = 'Commitment-Based' AND CommitmentDiscountType = 'Reservation' THEN 'reservation'
        WHEN ChargeCategory = 'Usage' AND PricingCategory = 'Commitment-Based' AND CommitmentDiscountType = 'Savings Plan' THEN 'savings_plan'
        WHEN ChargeCategory = 'Usage' AND PricingCategory = 'On-Demand' THEN 'usage_on_demand'
        WHEN ChargeCategory = 'Usage' AND PricingCategory = 'Dynamic' THEN 'usage_dynamic' ELSE 'other' END AS component,
      CASE WHEN lower(trim(ConsumedUnit)) = 'unknown' THEN NULL ELSE nullif(trim(ConsumedUnit), '') END AS unit
    FROM charges
  )
)"""

USAGE = """
usage AS (
  SELECT event_id AS record_id, event_type AS sku_name, user_id % 5 AS workspace_id, date_trunc('second', ts) AS usage_start_time,
    date_trunc('second', ts) + INTERVAL 1 HOUR AS usage_end_time,
    CAST(CASE WHEN event_type = 'error' THEN -1 ELSE 1 END * CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS usage_quantity,
    CASE WHEN event_type = 'error' THEN 'RETRACTION' ELSE 'ORIGINAL' END AS record_type, 'DBU' AS usage_unit, 'GCP' AS cloud,
    CASE WHEN user_id % 2 = 0 THEN 'JOBS' ELSE 'SQL' END AS billing_origin_product, user_id
  FROM events
),
list_prices(sku_name, price_start_time, price_end_time, price) AS (
  SELECT a, CAST(b AS TIMESTAMP), CAST(c AS TIMESTAMP), CAST(d AS DECIMAL(18,10)) FROM (VALUES
    ('click', '2023-01-01', '2024-01-10', '0.150000000'), ('click', '2024-01-10', NULL, '0.175000000'),
    ('error', '2023-01-01', NULL, '0.070000000'), ('error', '2024-01-12', '2024-01-14', NULL),
    ('purchase', '2023-01-01', '2024-01-20', '0.400000000'), ('purchase', '2024-01-20', '2024-01-25', '0.4000000001'),
    ('signup', '2023-01-01', NULL, '0.300000000'), ('signup', '2024-01-15', NULL, '0.310000000')) AS v(a, b, c, d)
)"""


# what the viewer of the scoped reports may see: APP1 and APP2 by name, domain D1 holds numbers 1, 4, 7, ..., 19, but APP4 is ambiguous
VISIBLE = "application_code IN ('APP1', 'APP2', 'APP7', 'APP10', 'APP13', 'APP16', 'APP19')"
MINE = f"""
mine_charges AS (SELECT * FROM charges WHERE {VISIBLE}),
mine_allocation AS (SELECT * FROM allocation WHERE {VISIBLE})"""

ENTITLEMENTS = """
entitlements AS (
  SELECT 'demo' AS identity_provider, 'p' || c_custkey AS principal_id, 'prod' AS environment,
    CASE c_custkey % 4 WHEN 0 THEN 'APPLICATION_OWNER' WHEN 1 THEN 'DOMAIN_MANAGER' WHEN 2 THEN 'SUBDOMAIN_MANAGER' ELSE 'FINOPS_ADMIN' END AS role,
    CASE WHEN c_custkey % 11 = 0 THEN 'DOMAIN' ELSE CASE c_custkey % 4 WHEN 0 THEN 'APPLICATION' WHEN 1 THEN 'DOMAIN' WHEN 2 THEN 'SUBDOMAIN' ELSE 'ALL' END END AS scope_type,
    CASE WHEN c_custkey % 13 = 0 THEN ' ' ELSE '' END || CASE WHEN c_custkey % 17 = 0 THEN '*' ELSE
      CASE c_custkey % 4 WHEN 0 THEN 'APP' || (c_custkey % 20) WHEN 1 THEN 'D' || (c_custkey % 3) WHEN 2 THEN 'S' || (c_custkey % 10) ELSE '*' END END AS scope_id,
    c_custkey % 7 <> 0 AS is_active,
    CASE c_custkey % 5 WHEN 0 THEN TIMESTAMP '2025-01-01' WHEN 1 THEN NULL ELSE TIMESTAMP '2024-01-01' END AS valid_from,
    CASE c_custkey % 6 WHEN 0 THEN TIMESTAMP '2024-03-01' WHEN 1 THEN NULL ELSE TIMESTAMP '2024-12-31' END AS valid_to
  FROM customer, (VALUES (1), (2)) AS v(copy) WHERE copy = 1 OR c_custkey % 19 = 0
),
live_entitlements AS (
  SELECT * FROM entitlements WHERE is_active AND (valid_from IS NULL OR valid_from <= TIMESTAMP '2024-06-01') AND (valid_to IS NULL OR TIMESTAMP '2024-06-01' < valid_to)
)"""


def twin(sql: str) -> str:
    """sql with the relations it names in front."""
    need = []
    if "allocation" in sql or "charges" in sql:
        need.append(CHARGES)
    if "allocation" in sql:
        need.append(ALLOCATION)
    if "mine_" in sql:
        need = [CHARGES, ALLOCATION, MINE]
    if "entitlements" in sql:
        need.append(ENTITLEMENTS)
    if "usage" in sql or "list_prices" in sql:
        need.append(USAGE)
    body = sql.strip()
    if not need:
        return body
    return "WITH " + ",".join(need) + ("," + body[5:] if body.upper().startswith("WITH ") else "\n" + body)
