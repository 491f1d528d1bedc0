"""Charge lines over the test tables: one row per line item, no row lost.

The shape is the cost-and-usage format that the contract describes; the values are chosen
so that every rule, category and null case of the model occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import APPLICATION_TAGS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension tables are joined by key; Spark broadcasts those that are small at run time.

    Customers meet the orders and nations the suppliers first, so that lines, the widest and most, are dealt for as few joins as can be.
    """
    t = lambda name: table(spark, sf_dir, name)
    orders = t("orders").select("o_orderkey", "o_custkey").join(t("customer").select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = t("supplier").select("s_suppkey", "s_nationkey").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    joined = (
        t("lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t("part").select("p_partkey", "p_type", "p_brand", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    text = lambda c: F.col(c).cast("string")
    day = F.to_date("l_shipdate")
    month_start = F.trunc(day, "month")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept, untaxed = 1 - F.col("l_discount").cast("decimal(4,2)"), 1 - F.col("l_tax").cast("decimal(4,2)")
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    category = (
        F.when(F.col("l_returnflag") == "R", "Adjustment")
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), "Purchase")
        .otherwise("Usage")
    )
    commitment = F.col("l_linenumber") % 3 == 1
    size = F.col("p_size") % 4
    ident = [text(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")] + [F.date_format(day, "yyyy-MM-dd")]
    return joined.select(
        F.concat_ws("-", *ident).alias("x_ChargeId"),
        month_start.alias("BillingPeriodStart"),
        F.add_months(month_start, 1).alias("BillingPeriodEnd"),
        day.cast("timestamp").alias("ChargePeriodStart"),
        F.date_add(day, 1).cast("timestamp").alias("ChargePeriodEnd"),
        F.date_format(day, "yyyy-MM").alias("billing_month"),
        price.alias("ListCost"),
        (price * kept).alias("ContractedCost"),
        (price * kept * untaxed).alias("EffectiveCost"),
        (sign * price * kept).alias("BilledCost"),
        category.alias("ChargeCategory"),
        F.when(category == "Usage", "Usage-Based").when(category == "Purchase", "Recurring").otherwise("One-Time").alias("ChargeFrequency"),
        F.when(F.col("l_linenumber") % 3 == 0, "On-Demand").when(commitment, "Commitment-Based").otherwise("Dynamic").alias("PricingCategory"),
        F.when(commitment, F.when(F.col("l_suppkey") % 2 == 0, "Reservation").otherwise("Savings Plan")).alias("CommitmentDiscountType"),
        F.col("p_type").alias("ServiceName"),
        F.col("p_brand").alias("ServiceCategory"),
        text("l_partkey").alias("SkuId"),
        F.concat(F.lit("res-"), text("l_suppkey"), F.lit("-"), (F.col("l_partkey") % 50).cast("string")).alias("ResourceId"),
        F.concat(F.lit("rg-"), (F.col("l_suppkey") % 10).cast("string")).alias("x_ResourceGroupName"),
        text("o_custkey").alias("SubAccountId"),
        F.col("n_name").alias("BillingAccountId"),
        F.when(F.col("r_name") == "EUROPE", " West Europe ")
        .when(F.col("r_name") == "AMERICA", "Global")
        .when(F.col("r_name") == "ASIA", "South India")
        .when(F.col("r_name") == "MIDDLE EAST", "UAE North")
        .alias("Region"),
        F.when(F.col("c_mktsegment") == "BUILDING", " CostCenter_APAC ")
        .when(F.col("c_mktsegment") == "MACHINERY", "Unknown")
        .when(F.col("c_mktsegment") == "FURNITURE", "")
        .alias("x_CostCenter"),
        F.when(size == 0, "Hours").when(size == 1, "GB").when(size == 2, " Unknown ").alias("ConsumedUnit"),
        (sign * F.col("l_quantity").cast("decimal(18,2)")).alias("ConsumedQuantity"),
        F.concat(
            F.lit(f'{{"{APPLICATION_TAGS["application_code"]}":"APP'),
            (F.col("o_custkey") % 20).cast("string"),
            F.lit('","env":" e'),
            (F.col("o_custkey") % 3).cast("string"),
            F.lit(' "}'),
        ).alias("Tags"),
        F.lit("EUR").alias("BillingCurrency"),
        F.lit("Microsoft").alias("ProviderName"),
        F.concat(F.lit("daily/"), F.date_format(day, "yyyy/MM/yyyy-MM-dd"), F.lit(".parquet")).alias("_source_file"),
    )
