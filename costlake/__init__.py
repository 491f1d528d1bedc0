"""Cloud-cost analytics as Spark DataFrame operators."""
