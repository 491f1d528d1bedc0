"""Usage records, prices, runs and entitlements derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .charges import table

# List prices with their validity; two click prices adjoin, two signup prices overlap, an error price is doubled
# by a row without an amount for some days, one purchase price has more than nine decimals, views have none.
PRICES = [
    ("click", "2023-01-01", "2024-01-10", "0.150000000"),
    ("click", "2024-01-10", None, "0.175000000"),
    ("error", "2023-01-01", None, "0.070000000"),
    ("error", "2024-01-12", "2024-01-14", None),
    ("purchase", "2023-01-01", "2024-01-20", "0.400000000"),
    ("purchase", "2024-01-20", "2024-01-25", "0.4000000001"),
    ("signup", "2023-01-01", None, "0.300000000"),
    ("signup", "2024-01-15", None, "0.310000000"),
]
RUN_START, RUN_END = "2024-01-05 06:30:00", "2024-01-09 18:15:00"


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A usage record for each event, to the second; errors are retractions with a negative quantity."""
    start = F.date_trunc("second", F.col("ts").cast("timestamp"))
    correction = F.col("event_type") == "error"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"),
        F.col("event_type").alias("sku_name"),
        (F.col("user_id") % 5).alias("workspace_id"),
        start.alias("usage_start_time"),
        (start + F.expr("interval 1 hour")).alias("usage_end_time"),
        (F.when(correction, -1).otherwise(1) * F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)").alias("usage_quantity"),
        F.when(correction, "RETRACTION").otherwise("ORIGINAL").alias("record_type"),
        F.lit("DBU").alias("usage_unit"),
        F.lit("GCP").alias("cloud"),
        F.when(F.col("user_id") % 2 == 0, "JOBS").otherwise("SQL").alias("billing_origin_product"),
        "user_id",
    )


def list_prices(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(PRICES, "sku_name string, price_start_time string, price_end_time string, price string")
    return rows.select(
        "sku_name", F.col("price_start_time").cast("timestamp"), F.col("price_end_time").cast("timestamp"), F.col("price").cast("decimal(18,10)"),
        F.lit("GCP").alias("cloud"), F.lit("DBU").alias("usage_unit"), F.lit("USD").alias("currency_code"),
    )


def run_windows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, RUN_START, RUN_END)], "run_id long, a string, b string").select(
        "run_id", F.col("a").cast("timestamp").alias("run_start_time"), F.col("b").cast("timestamp").alias("run_end_time")
    )
