"""Controls: privacy gate, snapshots, reconciliation and consistency checks.

Each control is a frame of findings or counters; require_empty turns findings into an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import bag, differences

# Columns of the snapshots, the tolerance of a reconciliation, and what counts as an address.
CRITICAL = ["BilledCost", "BillingCurrency", "BillingPeriodStart", "ChargePeriodStart", "ProviderName", "ServiceName"]
MONEY = ["BilledCost", "EffectiveCost", "ListCost", "ContractedCost"]
TOLERANCE = 0.005
EMAIL = r"[a-zA-Z0-9_.+%-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"


class ControlError(ValueError):
    pass


def require_empty(findings: DataFrame, what: str, shown: int = 5) -> None:
    rows = findings.limit(shown).collect()
    if rows:
        raise ControlError(f"{what}: {[r.asDict() for r in rows]}")


def names_somebody(c: Column, organizations: str | None, pseudonym: str | None) -> Column:
    """Whether a text names an organization of the pattern, or has an address that is not a pseudonym."""
    found = F.coalesce(c.rlike(organizations), F.lit(False)) if organizations else F.lit(False)
    addresses = F.regexp_extract_all(c, F.lit(EMAIL), F.lit(0))
    real = F.exists(addresses, lambda a: ~a.rlike(pseudonym) if pseudonym else F.lit(True))
    return found | F.coalesce(real, F.lit(False))


def privacy_counts(df: DataFrame, organizations: str | None = None, pseudonym: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """One row: for each text column how many values name somebody. Counts only, never the text; one scan."""
    columns = columns or [n for n, k in df.dtypes if k == "string"]
    return df.agg(*(F.count_if(names_somebody(F.col(f"`{c}`"), organizations, pseudonym)).alias(c) for c in columns))


def enforce_privacy(df: DataFrame, organizations: str | None = None, pseudonym: str | None = None) -> None:
    counts = privacy_counts(df, organizations, pseudonym).first().asDict()
    found = {n: c for n, c in counts.items() if c}
    if found:
        raise ControlError(f"the source names somebody, nothing was written: {found}")


def one_value(df: DataFrame, c: str | Column) -> str:
    """The only value of a column; refuses none and several. Two rows at most reach the driver."""
    rows = df.select((F.col(c) if isinstance(c, str) else c).alias("v")).distinct().limit(2).collect()
    if len(rows) != 1 or rows[0]["v"] is None:
        raise ControlError(f"expected one value, found {[r['v'] for r in rows]}")
    return rows[0]["v"]


#: Metrics of a snapshot: name, columns that it needs, type, and how they are aggregated; where a column is absent, zero or null.
METRICS = (
    ("row_count", (), "bigint", lambda: F.count(F.lit(1))),
    ("billed_cost_total", ("BilledCost",), "decimal(38,6)", lambda c: F.coalesce(F.sum(c.cast("decimal(38,6)")), F.lit(0))),
    ("effective_cost_total", ("EffectiveCost",), "decimal(38,6)", lambda c: F.coalesce(F.sum(c.cast("decimal(38,6)")), F.lit(0))),
    ("list_cost_total", ("ListCost",), "decimal(38,6)", lambda c: F.coalesce(F.sum(c.cast("decimal(38,6)")), F.lit(0))),
    ("distinct_accounts", ("BillingAccountId",), "bigint", F.countDistinct),
    ("distinct_resources", ("ResourceId",), "bigint", F.countDistinct),
    ("min_charge_period", ("ChargePeriodStart",), "timestamp", F.min),
    ("max_charge_period", ("ChargePeriodEnd",), "timestamp", F.max),
)


def snapshot(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """METRICS of df by keys, nulls in the critical columns, and charge ids that occur more than once."""
    keys, has = keys or [], set(df.columns)
    measured = []
    for name, needs, kind, measure in METRICS:
        absent = F.lit(None if kind == "timestamp" else 0)
        measured.append((measure(*map(F.col, needs)) if has.issuperset(needs) else absent).cast(kind).alias(name))
    nulls = F.lit(0).cast("bigint")
    for c in has.intersection(CRITICAL):
        nulls += F.count_if(F.col(c).isNull())
    out = df.groupBy(*keys).agg(*measured, nulls.alias("null_critical_count"))
    if "x_ChargeId" not in has:
        return out.withColumn("duplicate_charge_ids", F.lit(0).cast("bigint"))
    twice = duplicates(df.where("x_ChargeId is not null"), [*keys, "x_ChargeId"]).groupBy(*keys).agg(F.count("*").alias("duplicate_charge_ids"))
    joined = out.join(twice, keys, "left") if keys else out.crossJoin(F.broadcast(twice))  # both one row
    return joined.withColumn("duplicate_charge_ids", F.coalesce("duplicate_charge_ids", F.lit(0)))


def reconcile(before: DataFrame, source: DataFrame, after: DataFrame, keys: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """Snapshots of a replaced month side by side: it passes if what is stored equals the source and has no critical null."""
    take = lambda df, p: df.select(*keys, F.col("row_count").alias(f"{p}_rows"), F.col("billed_cost_total").alias(f"{p}_billed_cost"), F.col("null_critical_count").alias(f"{p}_nulls"))
    joined = take(source, "source").join(take(after, "after"), keys, "left").join(take(before, "before"), keys, "left")
    difference = F.col("after_billed_cost") - F.col("source_billed_cost")
    passed = (F.col("after_rows") == F.col("source_rows")) & (F.abs(difference) < tolerance) & (F.col("after_nulls") == 0)
    return joined.select(
        *keys,
        "before_rows",
        "source_rows",
        "after_rows",
        (F.col("source_billed_cost") - F.col("before_billed_cost")).alias("billing_daily_difference"),
        difference.alias("after_billing_difference"),
        F.when(F.coalesce(passed, F.lit(False)), "PASSED").otherwise("FAILED").alias("status"),
    )


def layers(frames: dict[str, DataFrame], money: dict[str, str], key: str = "billing_month") -> DataFrame:
    """Rows and cost of several layers by month, over the months of all of them, and whether they agree."""
    sums = {n: df.groupBy(key).agg(F.count("*").alias(f"{n}_rows"), F.sum(money[n]).alias(f"{n}_cost")) for n, df in frames.items()}
    names = list(sums)
    months = sums[names[0]].select(key)
    for n in names[1:]:
        months = months.union(sums[n].select(key))
    out = months.distinct()
    for n in names:
        out = out.join(sums[n], key, "left")
    agree = F.lit(True)
    for n in names[1:]:
        agree &= F.col(f"{n}_rows").eqNullSafe(F.col(f"{names[0]}_rows")) & (F.abs(F.col(f"{n}_cost") - F.col(f"{names[0]}_cost")) < TOLERANCE)
    return out.withColumn("agree", F.coalesce(agree, F.lit(False)))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def several(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct value."""
    return df.groupBy(key).agg(F.countDistinct(value).alias("values")).where("values > 1")


def orphans(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    return df.join(dimension.select(key), key, "left_anti")


def rehash(dimension: DataFrame, key: str, expected: Column) -> DataFrame:
    """Rows whose key is not the hash of their attributes, and keys that occur twice."""
    wrong = dimension.where(F.col(key) != expected).select(key, F.lit("wrong hash").alias("finding"))
    return wrong.unionByName(duplicates(dimension, [key]).select(key, F.lit("not unique").alias("finding")))


def lineage(df: DataFrame) -> DataFrame:
    """Months, source types and files, and what is wrong with each: mixed types in a month, several files of a monthly load, a file in several months."""
    files = df.select("billing_month", "_source_type", "_source_file").distinct()
    by_month = files.groupBy("billing_month").agg(F.countDistinct("_source_type").alias("types"), F.count_if(F.col("_source_type") == "MONTHLY").alias("monthly_files"))
    mixed = by_month.where("types > 1").select(F.col("billing_month").alias("subject"), F.lit("daily and monthly").alias("finding"))
    many = by_month.where("monthly_files > 1").select(F.col("billing_month").alias("subject"), F.lit("several monthly files").alias("finding"))
    spread = several(files, "_source_file", "billing_month").select(F.col("_source_file").alias("subject"), F.lit("file in several months").alias("finding"))
    return mixed.unionByName(many).unionByName(spread)


def content_digest(df: DataFrame, by: str, values: tuple[str, ...]) -> DataFrame:
    """One row: rows, rows of each value of by, and a SHA-256 over the number of rows and two order-free sums of their hashes; amounts count by value, not by scale."""
    plain = [F.coalesce(F.col(c).cast("decimal(38,12)").cast("string") if k.startswith("decimal") else F.col(c).cast("string"), F.lit("\0")) for c, k in sorted(df.dtypes)]
    text = F.concat_ws("\x1f", *plain)
    total = lambda seed: F.sum(F.xxhash64(F.lit(seed), text).cast("decimal(38,0)")).cast("string")
    return df.agg(
        F.count("*").alias("rows"),
        *(F.count_if(F.col(by) == v).alias(f"{v.lower()}_rows") for v in values),
        F.sha2(F.concat_ws(":", F.count("*").cast("string"), total("a"), total("b")), 256).alias("content_digest"),
    )


def runs_of_files(df: DataFrame) -> DataFrame:
    """Source files whose rows are not of exactly one ingestion run, with their runs and rows. Rows are summed by file and run first."""
    by_run = df.groupBy("_source_file", "_ingestion_run_id").agg(F.count("*").alias("rows"))
    return by_run.groupBy("_source_file").agg(F.count("_ingestion_run_id").alias("runs"), F.sum("rows").alias("rows")).where("runs <> 1")


def money_snapshot(df: DataFrame, period: str | None = None) -> DataFrame:
    """Rows and the sum of each cost column by period; both are found by name if not given."""
    period = period or next(c for c in ("billing_month", "month", "usage_month", "date", "usage_date") if c in df.columns)
    costs = [n for n, k in df.dtypes if k.startswith("decimal") and "cost" in n.lower()]
    return df.groupBy(F.col(period).cast("string").alias("period")).agg(F.count("*").alias("rows"), *(F.sum(F.col(c).cast("decimal(38,12)")).alias(c) for c in costs))


def compare_money(left: DataFrame, right: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Periods whose rows differ, or whose amounts differ by the tolerance or in being null."""
    costs = [c for c in left.columns if c not in ("period", "rows")]
    found = differences(left, right, ["period"], ["rows", *costs])
    off = (F.col("difference") != "changed") | ~F.col("left_rows").eqNullSafe(F.col("right_rows"))
    for c in costs:
        a, b = F.col(f"left_{c}"), F.col(f"right_{c}")
        off |= (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) >= tolerance, F.lit(False))
    return found.where(off)


def fallback_effect(before: DataFrame, after: DataFrame, c: str = "ServiceName", key: str = "billing_month") -> DataFrame:
    """Nulls by month before and after the contract's fallbacks."""
    count = lambda df, n: df.groupBy(key).agg(F.count_if(F.col(c).isNull()).alias(n))
    return count(before, "source_nulls").join(count(after, "clean_nulls"), key, "full_outer").na.fill(0, ["source_nulls", "clean_nulls"])


def platform_cost_rules() -> dict[str, Column]:
    """Rules of a platform cost row by name; true is a violation."""
    estimate, bill = F.col("cost_basis") == "list_estimate", F.col("cost_basis") == "billing_export"
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    checks = {
        "month": ~text("month").rlike(r"^\d{4}-(0[1-9]|1[0-2])$"),
        "date_in_month": F.date_format("usage_date", "yyyy-MM") != F.col("month"),
        "provider": ~text("provider").isin("GCP", "Databricks"),
        "currency": ~text("currency").rlike("^[A-Z]{3}$"),
        "service": (F.trim(text("service")) == "") | (F.length("service") > 160) | text("service").rlike(r"@|://|[\n\r<>]"),
        "period_status": ~text("period_status").isin("partial", "closed"),
        "basis": ~(bill | (estimate & (F.col("provider") == "Databricks"))),
        "estimate_credits": estimate & F.col("credits").isNotNull(),
        "estimate_unit": estimate & ~F.col("usage_unit").eqNullSafe(F.lit("DBU")),
        "bill_amounts": bill & (F.col("cost_before_credits").isNull() | F.col("credits").isNull()),
        "bill_unit": bill & (text("usage_unit") != ""),
        "bill_quantity": bill & F.col("usage_quantity").isNotNull(),
        "marketplace_label": bill & (F.col("provider") == "Databricks") & (text("service") != "Databricks"),
        "own_label": bill & (F.col("provider") == "GCP") & (text("service") == "Databricks"),
        "magnitude": F.abs("cost_before_credits") >= F.lit(10).cast("decimal(38,0)") * 10**14,
    }
    return {n: F.coalesce(c, F.lit(True)) if n in ("date_in_month", "basis") else F.coalesce(c, F.lit(False)) for n, c in checks.items()}


#: Names of the rules in their order; needs no session.
PLATFORM_RULES = (
    "month date_in_month provider currency service period_status basis estimate_credits estimate_unit bill_amounts bill_unit bill_quantity "
    "marketplace_label own_label magnitude"
).split()


def platform_findings(
    daily: DataFrame, monthly: DataFrame, monthly_of: Callable[[DataFrame], DataFrame], keys: list[str], providers: tuple[str, ...] = ("GCP", "Databricks")
) -> DataFrame:
    """What is wrong with the stored platform costs: a provider without rows, days that occur twice, months that their days do not give."""
    spark = daily.sparkSession
    wanted = spark.createDataFrame([(p,) for p in providers], "provider string")
    none = wanted.join(daily.select("provider").distinct(), "provider", "left_anti").select(F.lit("no rows").alias("finding"), "provider", F.lit(0).cast("bigint").alias("rows"))
    twice = duplicates(daily, ["usage_date", *keys]).groupBy("provider").agg(F.count("*").alias("rows"))
    off = differences(monthly_of(daily), monthly, keys, ["cost_before_credits", "credits", "usage_quantity", "period_status"])
    off = off.groupBy("provider").agg(F.count("*").alias("rows"))
    label = lambda df, name: df.select(F.lit(name).alias("finding"), "provider", "rows")
    return none.unionByName(label(twice, "duplicate day")).unionByName(label(off, "months differ from days"))


def export_findings(export: DataFrame, estimate: DataFrame, manifest_rows: int, marketplace: bool = False) -> DataFrame:
    """What is wrong with two sources before they are merged: row count against the manifest, empty source, role, basis and period."""
    checks = []
    roles = {"export": (export, ("GCP", "Databricks") if marketplace else ("GCP",), "billing_export"), "estimate": (estimate, ("Databricks",), "list_estimate")}
    for source, (df, providers, basis) in roles.items():
        wrong = {
            "provider": ~F.col("provider").isin(*providers),
            "cost basis": F.col("cost_basis") != basis,
            "period status": F.col("period_status") != "partial",
        }
        counted = df.agg(F.count("*").alias("rows"), *(F.count_if(F.coalesce(c, F.lit(True))).alias(n) for n, c in wrong.items()))
        found = [F.struct(F.lit(n).alias("finding"), F.col(f"`{n}`").alias("count")) for n in wrong]
        found.append(F.struct(F.lit("no rows").alias("finding"), (F.col("rows") == 0).cast("bigint").alias("count")))
        if source == "export":
            found.append(F.struct(F.lit("rows beside the manifest").alias("finding"), F.abs(F.col("rows") - manifest_rows).alias("count")))
        checks.append(counted.select(F.lit(source).alias("source"), F.inline(F.array(*found))))
    return checks[0].unionByName(checks[1]).where("count > 0")


def preflight(layers: dict[str, dict[str, DataFrame]], expected: dict[str, int], log: dict[str, DataFrame], environment: str) -> DataFrame:
    """What keeps an environment from a first load: a layer without its number of tables, a table with rows, a log with rows of the environment."""
    spark = next(iter(log.values())).sparkSession
    counts = [(layer, len(tables)) for layer, tables in layers.items()]
    missing = spark.createDataFrame(list(expected.items()), "subject string, wanted long").join(
        spark.createDataFrame(counts, "subject string, count long"), "subject", "left"
    )
    found = missing.where(~F.col("count").eqNullSafe(F.col("wanted"))).select("subject", F.coalesce("count", F.lit(0)).alias("count"), F.lit("tables").alias("finding"))
    full = [(f"{layer}.{n}", df, "table has rows") for layer, tables in layers.items() for n, df in tables.items()]
    full += [(n, df.where(F.col("environment") == environment), "log has rows") for n, df in log.items()]
    for subject, df, finding in full:
        rows = df.agg(F.lit(subject).alias("subject"), F.count("*").alias("count"), F.lit(finding).alias("finding"))
        found = found.unionByName(rows.where("count > 0"))
    return found


def same_copy(source: DataFrame, copy: DataFrame) -> DataFrame:
    """What tells a copied table from its source: columns that one side lacks or types otherwise, the numbers of rows, and where these agree the digests of all rows."""
    spark = source.sparkSession
    a, b = (spark.createDataFrame(df.dtypes, "subject string, kind string") for df in (source, copy))
    columns = differences(a, b, ["subject"], ["kind"]).select("subject", "difference", F.col("left_kind").alias("here"), F.col("right_kind").alias("there"))
    digest = lambda df, name: df.agg(F.count("*").alias(name), bag([c for c in source.columns if c in copy.columns]).alias(f"{name}_bag"))
    counts = digest(source, "here").crossJoin(F.broadcast(digest(copy, "there")))  # one row each
    finding = lambda where, name, a, b: counts.where(where).select(
        F.lit("*").alias("subject"), F.lit(name).alias("difference"), F.col(a).cast("string").alias("here"), F.col(b).cast("string").alias("there")
    )
    rows = finding("here <> there", "rows", "here", "there")
    if dict(source.dtypes) == dict(copy.dtypes):
        rows = rows.unionByName(finding("here = there and not here_bag <=> there_bag", "content", "here_bag", "there_bag"))
    return columns.unionByName(rows)


def closed_elsewhere(here: DataFrame, there: DataFrame, closed: tuple[str, ...]) -> DataFrame:
    """Months closed there but not here (month states of two environments)."""
    mine = here.select("billing_month", F.col("status").alias("here"))
    theirs = there.where(F.col("status").isin(*closed)).select("billing_month", F.col("status").alias("there"))
    return theirs.join(mine, "billing_month", "left").where(~F.coalesce(F.col("here").isin(*closed), F.lit(False)))


def fresh(at: Column, now: Column, hours: int = 48, ahead_minutes: int = 5) -> Column:
    """Whether at is at most so many hours before now and so many minutes after it, to the microsecond."""
    age = F.unix_micros(now) - F.unix_micros(at)
    return age.between(-60_000_000 * ahead_minutes, 3_600_000_000 * hours)


