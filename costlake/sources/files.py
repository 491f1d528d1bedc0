"""Daily and monthly source files: inventory, dates in paths, state, choice, and lineage columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# States of a month that refuse daily loads.
CLOSED = ("CLOSED_DATA_LOADED", "CLOSED_ARCHIVE_PENDING", "CLOSED")


class SourceError(ValueError):
    pass


def read_monthly(spark: SparkSession, root: str, month: str) -> DataFrame:
    return spark.read.parquet(f"{root}/monthly/{month}.parquet")


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """One daily file; refuses one without rows."""
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise SourceError(f"no rows in {path}")
    return df


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/data-*.parquet")


def with_lineage(df: DataFrame, run_id: str, source_type: str, status: str) -> DataFrame:
    """df read from files, with source, type, run, time of ingestion and status of each row.

    A source is a file, or a folder of part files that were written together.
    """
    return df.select(
        "*",
        F.regexp_replace(F.col("_metadata.file_path"), r"/part-[^/]*$", "").alias("_source_file"),
        F.lit(source_type).alias("_source_type"),
        F.lit(run_id).alias("_ingestion_run_id"),
        F.current_timestamp().alias("_ingested_at"),
        F.lit(status).alias("_data_status"),
    )


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files below root. Only paths are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(root).select(F.col("path").alias("source_uri"))


def normalized_uri(c: str):
    """One spelling of a location: file: and s3a: prefixes as written by different readers, without repeated slashes."""
    short = F.regexp_replace(F.regexp_replace(F.col(c), r"^dbfs:/+", "/"), r"^file:/+", "/")
    return F.regexp_replace(F.regexp_replace(short, r"^s3[an]://", "s3://"), r"(?<!:)/{2,}", "/")


def confined(c: str, root: str):
    """Whether a path lies below root without . or .. parts."""
    parts = F.split(F.col(c), "/")
    return F.startswith(F.col(c), F.lit(root.rstrip("/") + "/")) & ~F.arrays_overlap(parts, F.array(F.lit("."), F.lit("..")))


def dated(files: DataFrame, c: str = "source_uri") -> DataFrame:
    """Files named daily/YYYY/MM/YYYY-MM-DD.parquet with their date and month; valid is false if folder and name disagree."""
    pattern = r"daily/(\d{4})/(\d{2})/((\d{4})-(\d{2})-\d{2})\.parquet$"
    part = lambda i: F.regexp_extract(F.col(c), pattern, i)
    day = part(3).try_cast("date")
    return files.where(F.col(c).rlike(r"/?daily/.*\.parquet$")).select(
        "*",
        day.alias("processing_date"),
        F.date_format(day, "yyyy-MM").alias("billing_month"),
        F.coalesce(day.isNotNull() & (part(1) == part(4)) & (part(2) == part(5)), F.lit(False)).alias("valid"),
    )


def classified(files: DataFrame, loaded: DataFrame, month_status: DataFrame) -> DataFrame:
    """files with state: CLOSED if the month is, else LOADED if the file was, else NEW."""
    done = loaded.select(F.col("_source_file").alias("source_uri")).distinct().withColumn("_done", F.lit(True))
    shut = month_status.where(F.col("status").isin(*CLOSED)).select("billing_month").distinct().withColumn("_shut", F.lit(True))
    state = F.when(F.col("_shut"), "CLOSED").when(F.col("_done"), "LOADED").otherwise("NEW")
    return files.join(shut, "billing_month", "left").join(done, "source_uri", "left").withColumn("state", state).drop("_done", "_shut")


def next_file(files: DataFrame, day: str | None = None, uri: str | None = None) -> DataFrame:
    """The oldest new file, or a given day's, or a given one that may not be closed."""
    if uri is not None:
        chosen = files.where((F.col("source_uri") == uri) & (F.col("state") != "CLOSED"))
        if chosen.isEmpty():
            raise SourceError(f"{uri} is absent or closed")
        return chosen.limit(1)
    new = files.where("valid and state = 'NEW'")
    if day is not None:
        new = new.where(F.col("processing_date") == F.to_date(F.lit(day)))
    return new.orderBy("processing_date", "source_uri").limit(1)


def months_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    if first > last:
        raise SourceError(f"{first} is after {last}")
    days = F.sequence(F.to_date(F.lit(first + "-01")), F.to_date(F.lit(last + "-01")), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(days).alias("_day")).select(F.date_format("_day", "yyyy-MM").alias("billing_month"))


def newest_export(manifests: DataFrame, now, fields: tuple[str, ...] = ("schema_version", "granularity", "run_id", "extracted_at", "row_count", "status")) -> DataFrame:
    """The newest complete export of valid manifests: known version, bounded row count, fresh. Unfinished ones are passed over."""
    missing = sorted(set(fields) - set(manifests.columns))
    if missing:
        raise SourceError(f"manifest without {missing}")
    rows = F.col("row_count").try_cast("long")
    at = F.col("extracted_at").try_cast("timestamp")
    age = F.unix_timestamp(now) - F.unix_timestamp(at)
    valid = (F.col("status") == "COMPLETED") & F.col("schema_version").try_cast("int").between(1, 3) & rows.between(1, 10_000) & age.between(-300, 48 * 3600)
    return manifests.where(valid).orderBy(at.desc(), F.desc("run_id")).limit(1)


def layer_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """Layer, number of its tables, table and its rows."""
    out = None
    for layer, tables in layers.items():
        counted = table_counts(tables).select(F.lit(layer).alias("layer"), F.lit(len(tables)).alias("tables"), "table", "rows")
        out = counted if out is None else out.unionByName(counted)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, as one frame."""
    counts = [df.agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
