"""Queries that write: each works in a folder of its own below the shared one and returns what it stored.

Sources are the whole charge-line table, or a day or month of it where that is what the
operator loads.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, scoping
from ..operators.tables import Tables, latest_state
from ..plans import finance, gold, marts, pipelines
from ..plans.pipelines import Lake
from ..sources import files
from ..sources.charges import charges
from ..sources.usage import list_prices, usage
from ..streaming import daily as stream
from .checks import guarded, mine, runs, scopes_of, serving_rows
from .finance import _export
from .products import M, _SUM
from .registry import lines, query


def folder(spark: SparkSession) -> str:
    """A new folder in spark.checkpoint.dir; where that is unset in local mode (tests) in the temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/costlake-lake-{uuid.uuid4().hex}"


def sources(s: SparkSession, d: str) -> DataFrame:
    """Charge lines as a source has them, with their day."""
    return charges(s, d).withColumn("day", F.to_date("ChargePeriodStart")).drop("_source_file")


def month_file(s: SparkSession, d: str, root: str, month: str) -> str:
    """One month's source: a folder of as many part files as its size asks for."""
    path = f"{root}/monthly/{month}.parquet"
    sources(s, d).where(F.col("billing_month") == month).drop("billing_month", "day").hint("rebalance").write.parquet(path)
    return path


def month_files(s: SparkSession, d: str, root: str) -> dict[str, str]:
    """The sources of all months, written at once."""
    path = f"{root}/monthly"
    sources(s, d).drop("day").withColumnRenamed("billing_month", "month").hint("rebalance", "month").write.partitionBy("month").parquet(path)
    months = charges(s, d).select("billing_month").distinct().collect()  # months
    return {r["billing_month"]: f"{path}/month={r['billing_month']}" for r in sorted(months)}


def day_file(s: SparkSession, d: str, root: str, day: str) -> str:
    """One day's source, a file; the joins before it keep their tasks."""
    path = f"{root}/daily/{day[:4]}/{day[5:7]}/{day}.parquet"
    sources(s, d).where(F.col("day") == F.lit(day).cast("date")).drop("billing_month", "day").repartition(1).write.parquet(path)
    return path


def day_files(s: SparkSession, d: str, root: str) -> str:
    """The folder of all days' sources, written at once."""
    path = f"{root}/daily"
    sources(s, d).drop("billing_month").hint("rebalance", "day").write.partitionBy("day").parquet(path)
    return path


def counted(s: SparkSession, **values: int) -> DataFrame:
    return s.createDataFrame([tuple(values.values())], ", ".join(f"{k} long" for k in values))


@query("snk1", "SELECT count(*) AS first_run, CAST(0 AS BIGINT) AS second_run, count(*) AS stored FROM charges")
def snk1(s, d):
    t, c = Tables(s, folder(s)), charges(s, d)
    first, second = (t.append_unseen(c, "bronze", ("billing_month",)) for _ in range(2))
    return counted(s, first_run=first, second_run=second, stored=t.read("bronze").count())


@query("snk2", "SELECT count(*) AS stored FROM orders")
def snk2(s, d):
    t = Tables(s, folder(s))
    t.append(s.read.parquet(f"{d}/orders.parquet"), "orders")
    return t.read("orders").agg(F.count("*").alias("stored"))


_REPLACED = f"""SELECT billing_month, count(*) FILTER (billing_month <> '{M}' OR SkuId <> '7') AS lines FROM charges GROUP BY ALL"""


def replaced(build):
    def run(s, d):
        t, c = Tables(s, folder(s)), build(charges(s, d), lines(s, d))
        t.append(c, "silver", ("billing_month",))
        t.replace_month(c.where((F.col("billing_month") == M) & (F.col("SkuId") != "7")), "silver", M)
        return t.read("silver").groupBy("billing_month").agg(F.count("*").alias("lines"))

    return run


query("snk3", _REPLACED)(replaced(lambda c, _: c))


@query("snk5", f"""SELECT billing_month, count(*) FILTER (billing_month <> '{M}' OR SkuId <> '7') AS rows,
    CAST(sum(BilledCost) FILTER (billing_month <> '{M}' OR SkuId <> '7') AS DOUBLE) AS billed_cost FROM charges GROUP BY ALL""")
def snk5(s, d):
    """The facts of one month replaced by those of its lines, which lost one SKU."""
    t, c = Tables(s, folder(s)), lines(s, d)
    by = ("billing_month",)
    t.append(gold.fact_cost_usage(c, by=by), "fact_cost_usage", by, dealt=True)
    t.replace_month(gold.fact_cost_usage(c.where((F.col("billing_month") == M) & (F.col("SkuId") != "7")), by=by), "fact_cost_usage", M, dealt=True)
    return t.read("fact_cost_usage").groupBy("billing_month").agg(F.count("*").alias("rows"), F.sum("billed_cost").alias("billed_cost"))


@query("snk4", "SELECT x_ChargeId, CAST(BilledCost AS DOUBLE) AS BilledCost FROM charges")
def snk4(s, d):
    from ..operators.tables import align

    c = charges(s, d)
    return align(c.select("BilledCost", "x_ChargeId"), c.select("x_ChargeId", "BilledCost"))


def rebuilt(s, d):
    t, g = Tables(s, folder(s)), marts.Gold(lines(s, d))
    for _ in range(2):
        t.rebuild(marts.monthly_billing(g), "dm_monthly_billing")
    return t.read("dm_monthly_billing")


for _name in ("snk6", "snk12"):
    query(_name, f"SELECT billing_month, {_SUM} AS monthly_billed_cost FROM charges GROUP BY ALL")(rebuilt)


def merged_halves(s, d, dimension, write):
    """A dimension of the lines before a month, then of those from it on, merged into one stored table."""
    t, c = Tables(s, folder(s)), lines(s, d)
    for half in (c.where(F.col("billing_month") < M), c.where(F.col("billing_month") >= M)):
        write(t, dimension(half))
    return t.read("merged")


query("snk7", "SELECT DISTINCT ServiceName AS service_name, ServiceCategory AS service_category FROM charges")(
    lambda s, d: merged_halves(s, d, gold.dim_service, lambda t, f: t.insert_missing(f, "merged", ["service_sk"])).select("service_name", "service_category")
)
query("snk8", """SELECT ResourceId AS resource_id, CAST(min(ChargePeriodStart) AS VARCHAR) AS valid_from, arg_max(application_code, (ChargePeriodStart, Tags)) AS application_code
    FROM charges GROUP BY ResourceId""")(
    lambda s, d: merged_halves(s, d, gold.dim_resource, lambda t, f: t.upsert(f, "merged", ["resource_sk"], ("valid_from",), 64)).select("resource_id", "valid_from", "application_code")
)
query("snk9", """SELECT count(DISTINCT d) AS days FROM (SELECT unnest([BillingPeriodStart, BillingPeriodEnd, CAST(ChargePeriodStart AS DATE), CAST(ChargePeriodEnd AS DATE)]) AS d FROM charges)""")(
    lambda s, d: merged_halves(s, d, gold.dim_date, lambda t, f: t.upsert(f, "merged", ["date_sk"])).agg(F.count("*").alias("days"))
)
query("snk10", """SELECT count(*) AS pairs, CAST(min(a) AS VARCHAR) AS first FROM (SELECT r, k, v, min(a) AS a FROM (
    SELECT ResourceId AS r, 'a' AS k, application_code AS v, ChargePeriodStart AS a FROM charges UNION ALL SELECT ResourceId, 'e', env_tag, ChargePeriodStart FROM charges) GROUP BY ALL)""")(
    lambda s, d: merged_halves(s, d, gold.bridge_resource_tag, lambda t, f: t.upsert(f, "merged", ["resource_sk", "tag_sk"], ("valid_from",), 64)).agg(
        F.count("*").alias("pairs"), F.min("valid_from").alias("first")
    )
)
query("snk11", """SELECT pipeline_name, status FROM (SELECT event_type AS pipeline_name, CASE WHEN value > 20 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('second', ts) DESC, CASE WHEN value > 20 THEN 'SUCCESS' ELSE 'FAILED' END DESC) AS n FROM events) WHERE n = 1""")(
    lambda s, d: latest_state(runs(s, d), "pipeline_name", "started_at").select("pipeline_name", "status")
)


@query("snk14", "SELECT 'customer' AS \"table\", count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders")
def snk14(s, d):
    root = folder(s)
    source, target = Lake(s, f"{root}/a"), Lake(s, f"{root}/b", "prod")
    names = ["customer", "orders"]
    for n in names:
        source.tables.rebuild(s.read.parquet(f"{d}/{n}.parquet"), n)
    return source.promote(target, names)


@query("src1", f"SELECT billing_month, count(*) AS lines FROM charges WHERE billing_month = '{M}' GROUP BY ALL")
def src1(s, d):
    root = folder(s)
    month_file(s, d, root, M)
    return files.read_monthly(s, root, M).groupBy(F.date_format("BillingPeriodStart", "yyyy-MM").alias("billing_month")).agg(F.count("*").alias("lines"))


@query("src2", f"SELECT count(*) AS lines FROM charges WHERE CAST(ChargePeriodStart AS DATE) = DATE '{M}-02'")
def src2(s, d):
    return files.read_daily(s, day_file(s, d, folder(s), f"{M}-02")).agg(F.count("*").alias("lines"))


@query("src3", "SELECT count(*) AS rows FROM customer")
def src3(s, d):
    root = folder(s)
    for i in range(2):
        s.read.parquet(f"{d}/customer.parquet").where(F.col("c_custkey") % 2 == i).write.parquet(f"{root}/data-{i}.parquet")
    return files.read_shards(s, root).agg(F.count("*").alias("rows"))


@query("src5", f"SELECT count(*) AS lines, true AS marked FROM charges WHERE billing_month = '{M}'")
def src5(s, d):
    raw = files.with_lineage(s.read.parquet(month_file(s, d, folder(s), M)), "r1", "MONTHLY", "FINAL")
    marked = F.col("_source_file").contains(f"{M}.parquet") & (F.col("_source_type") == "MONTHLY") & F.col("_ingested_at").isNotNull()
    return raw.agg(F.count("*").alias("lines"), F.bool_and(marked).alias("marked"))


def day_tree(s: SparkSession, d: str, root: str) -> str:
    """All days' sources as daily/YYYY/MM/YYYY-MM-DD.parquet: written at once, then moved to their names."""
    t = Tables(s, root)
    written = day_files(s, d, f"{root}/new")
    for name in t._names_in(written):
        if name.startswith("day="):
            day = name.removeprefix("day=")
            target, fs = t._at(f"{root}/daily/{day[:4]}/{day[5:7]}/{day}.parquet")
            fs.mkdirs(target.getParent())
            fs.rename(t._at(f"{written}/{name}")[0], target)
    return f"{root}/daily"


@query("src6", """SELECT strftime(ChargePeriodStart, '%Y-%m') AS billing_month, true AS valid, count(DISTINCT CAST(ChargePeriodStart AS DATE)) AS files FROM charges GROUP BY ALL
    UNION ALL SELECT '1998-03', false, 1 FROM (SELECT count(*) FROM charges) UNION ALL SELECT NULL, false, 1 FROM (SELECT count(*) FROM charges)""")
def src6(s, d):
    """The inventory of a tree that holds every day's file, a day in another month's folder, a file of another name, and one that is no Parquet."""
    root = folder(s)
    daily = day_tree(s, d, root)
    for stray in ("1998/04/1998-03-05.parquet", "1998/03/summary.parquet"):
        s.range(1).write.parquet(f"{daily}/{stray}")
    s.range(1).select(F.lit("note").alias("value")).write.text(f"{daily}/1998/03/notes.txt")
    found = files.inventory(s, root).select(F.regexp_extract("source_uri", r"(.*/daily/.*?\.parquet)(/part-|$)", 1).alias("source_uri")).distinct()
    return files.dated(found).groupBy("billing_month", "valid").agg(F.count("*").alias("files"))


@query("pip1", f"""SELECT count(*) AS bronze, count(*) AS silver, CAST(0 AS BIGINT) AS again, count(*) AS fact FROM charges WHERE CAST(ChargePeriodStart AS DATE) = DATE '{M}-02'""")
def pip1(s, d):
    root = folder(s)
    lake, path = Lake(s, f"{root}/lake"), day_file(s, d, root, f"{M}-02")
    first, second = lake.load_day(path), lake.load_day(path)
    return counted(s, bronze=first["bronze"], silver=first["silver"], again=second["bronze"] + second["silver"], fact=lake.tables.read("fact_cost_usage").count())


@query("pip2", f"""SELECT billing_month, count(*) AS source_rows, count(*) AS after_rows, 'PASSED' AS status FROM charges WHERE billing_month = '{M}' GROUP BY ALL""")
def pip2(s, d):
    root = folder(s)
    lake = Lake(s, f"{root}/lake")
    return lake.close_month(month_file(s, d, root, M), M).select("billing_month", "source_rows", "after_rows", "status")


def _backfilled(s, d):
    """Every month of the table, from the first to the last, closed from its source."""
    root = folder(s)
    lake, paths = Lake(s, f"{root}/lake"), month_files(s, d, root)
    lake.backfill(paths, min(paths), max(paths))
    return lake, paths


query("pip3", "SELECT billing_month, 'CLOSED_DATA_LOADED' AS status FROM charges GROUP BY ALL")(
    lambda s, d: _backfilled(s, d)[0].month_status().select("billing_month", "status")
)
query("pip4", f"SELECT billing_month, {_SUM} AS monthly_billed_cost FROM charges GROUP BY ALL")(
    lambda s, d: _backfilled(s, d)[0].tables.read("dm_monthly_billing")
)


def cost_sources(s, d):
    """The bill and the estimate of a collection."""
    bill = finance.bill_daily(_export(s, d)).withColumns({"usage_unit": F.lit(""), "usage_quantity": F.lit(None).cast("decimal(28,2)")})
    return bill, finance.priced_daily(usage(s, d), list_prices(s))


@query("pip5", "SELECT strftime(usage_start_time, '%Y-%m') AS month, sku_name AS service FROM usage GROUP BY ALL")
def pip5(s, d):
    lake = Lake(s, folder(s))
    lake.collect_costs(*cost_sources(s, d), publish=True)
    return lake.tables.read("platform_cost_monthly").where("provider = 'GCP'").select("month", "service")


@query("fin17", """WITH n AS (SELECT count(*) AS n FROM (SELECT DISTINCT CAST(usage_start_time AS DATE), sku_name FROM usage))
    SELECT 'SUCCESS' AS status, 2 * n AS rows, n AS gcp_rows, n AS databricks_rows, true AS finished, true AS has_digest, false AS has_message FROM n
    UNION ALL SELECT 'COLLECTION_FAILED', NULL, NULL, NULL, true, false, true FROM n""")
def fin17(s, d):
    """The audit rows of a collection whose bill came twice, which fails, and of one that is published."""
    lake, (bill, estimate) = Lake(s, folder(s)), cost_sources(s, d)
    try:
        lake.collect_costs(bill.union(bill), estimate, publish=True)
    except audit.ControlError:
        pass  # its row is the result
    lake.collect_costs(bill, estimate, publish=True)
    return lake.tables.read("platform_cost_run").select(
        "status", "rows", "gcp_rows", "databricks_rows", (F.col("finished_at") >= F.col("started_at")).alias("finished"),
        F.coalesce(F.length("content_digest") == 64, F.lit(False)).alias("has_digest"), F.col("message").isNotNull().alias("has_message"),
    )


@query("pip6", "SELECT count(DISTINCT billing_month) AS months, count(*) AS rows, CAST(0 AS BIGINT) AS differences FROM charges")
def pip6(s, d):
    """All months but the last come from monthly sources, the last from its days."""
    root = folder(s)
    lake, paths = _backfilled(s, d)
    last = max(paths)
    daily = f"{root}/days"
    sources(s, d).where(F.col("billing_month") == last).drop("billing_month").hint("rebalance", "day").write.partitionBy("day").parquet(daily)
    days = sources(s, d).where(F.col("billing_month") == last).select(F.col("day").cast("string")).distinct().collect()  # days of a month
    target = Lake(s, f"{root}/b")
    found = lake.rebuild_from({m: p for m, p in paths.items() if m != last}, [f"{daily}/day={r['day']}" for r in days], target)
    stored = target.tables.read("silver").agg(F.countDistinct("billing_month").alias("months"), F.count("*").alias("rows"))
    return stored.crossJoin(F.broadcast(found.agg(F.count("*").alias("differences"))))  # one row each


@query("pip7", """SELECT 'dm_monthly_billing' AS "table", count(DISTINCT billing_month) AS rows FROM charges UNION ALL SELECT 'fact_cost_usage', count(*) FROM charges
    UNION ALL SELECT 'silver', count(*) FROM charges UNION ALL SELECT 'dim_sku', count(DISTINCT SkuId) FROM charges UNION ALL SELECT 'dim_resource', count(DISTINCT ResourceId) FROM charges
    UNION ALL SELECT 'dm_daily_billing', count(DISTINCT CAST(ChargePeriodStart AS DATE)) FROM charges""")
def pip7(s, d):
    """Every table of the environment is copied; the report is of those that SQL counts easily."""
    lake, _ = _backfilled(s, d)
    names = [n for n in lake.tables.names() if n == "silver" or n.startswith(("dim_", "bridge_", "fact_", "dm_"))]
    return lake.promote(Lake(s, f"{folder(s)}/b", "prod"), names).where(
        F.col("table").isin("dm_monthly_billing", "fact_cost_usage", "silver", "dim_sku", "dim_resource", "dm_daily_billing")
    )


@query("dq6", f"SELECT m AS case, CASE WHEN status = 'OPEN' THEN 'None' ELSE 'refused' END AS outcome FROM (VALUES ('{M}', 'CLOSED'), ('1998-04', 'OPEN')) AS v(m, status) WHERE m IN (SELECT billing_month FROM charges)")
def dq6(s, d):
    """The month-open guard of a daily load, for a month that was closed from its source and one that is open."""
    root = folder(s)
    lake = Lake(s, f"{root}/lake")
    lake.close_month(month_file(s, d, root, M), M)
    lake.set_months(["1998-04"], "OPEN", "DAILY")
    return guarded(s, {m: lambda m=m: lake.require_open(m) for m in (M, "1998-04")})


@query("dq8", f"""SELECT capture_stage, billing_month, count(*) AS row_count, {_SUM} AS billed_cost_total FROM charges, (VALUES ('BEFORE'), ('SOURCE'), ('AFTER')) AS v(capture_stage)
    WHERE billing_month = '{M}' AND (capture_stage <> 'BEFORE' OR CAST(ChargePeriodStart AS DATE) = DATE '{M}-02') GROUP BY ALL""")
def dq8(s, d):
    """Snapshots kept by a monthly close over a month of which one day was loaded."""
    root = folder(s)
    lake = Lake(s, f"{root}/lake")
    lake.load_day(day_file(s, d, root, f"{M}-02"))
    lake.close_month(month_file(s, d, root, M), M)
    return lake.tables.read("month_snapshot").select("capture_stage", "billing_month", "row_count", "billed_cost_total")


_DAY = f"CAST(ChargePeriodStart AS DATE) = DATE '{M}-02'"


@query("dq10", f"""WITH c AS (SELECT count(*) AS n, count(*) FILTER (SkuId <> '7') AS o FROM charges WHERE {_DAY})
    SELECT 'clean' AS state, 'none' AS finding, 'none' AS expected, 'none' AS found FROM c
    UNION ALL SELECT 'faulty', finding, expected, found FROM (SELECT unnest(['gold rows of the month', 'gold cost of the month', 'duplicate fact keys', 'latest run', 'month state',
      'monthly mart cost', 'rows elsewhere', 'cost elsewhere']) AS finding, unnest([CAST(n AS VARCHAR), '', '0', 'SUCCESS', 'OPEN DAILY', '', CAST(2 * n AS VARCHAR), '']) AS expected,
      unnest([CAST(2 * n AS VARCHAR), '', CAST(n AS VARCHAR), 'FAILED', 'CLOSED MONTHLY', '', CAST(n AS VARCHAR), '']) AS found FROM c)""")
def dq10(s, d):
    """The daily control after a clean load, and after facts were doubled, a later run failed and the month was closed."""
    root = folder(s)
    lake, other = Lake(s, f"{root}/lake"), Lake(s, f"{root}/other", "prod")
    path = day_file(s, d, root, f"{M}-02")
    for one in (lake, other):
        one.load_day(path)
    clean = lake.daily_findings(path, other)
    before = s.createDataFrame([("clean", "none", "none", "none")], "state string, finding string, expected string, found string")
    if not clean.isEmpty():
        before = clean.select(F.lit("clean").alias("state"), "*")
    lake.tables.append(lake.tables.read("fact_cost_usage"), "fact_cost_usage", ("billing_month",))
    lake.log_run("later", "daily_incremental", M, "FAILED", pipelines.now())
    lake.set_months([M], "CLOSED", "MONTHLY")
    amount = F.col("finding").contains("cost")  # amounts are left to the findings themselves
    after = lake.daily_findings(path, other).select(
        F.lit("faulty").alias("state"), "finding", *(F.when(amount, "").otherwise(F.col(c)).alias(c) for c in ("expected", "found"))
    )
    return before.unionByName(after)


@query("dq18", """SELECT 'bronze' AS subject, CAST(0 AS BIGINT) AS count, 'tables' AS finding FROM orders UNION SELECT 'silver.silver', count(*), 'table has rows' FROM orders
    UNION SELECT 'pipeline_run', CAST(1 AS BIGINT), 'log has rows' FROM orders""")
def dq18(s, d):
    """The preflight of an environment that lacks a layer, holds rows in a table and has logged a run; an empty mart is no finding."""
    lake = Lake(s, folder(s), "prod")
    lake.tables.rebuild(s.read.parquet(f"{d}/orders.parquet"), "silver")
    lake.tables.rebuild(s.read.parquet(f"{d}/events.parquet").limit(0), "dm_monthly_billing")
    lake.log_run("r", "daily_incremental", M, "SUCCESS", pipelines.now())
    return lake.preflight({"bronze": 1, "silver": 1, "marts": 1})


@query("st1", f"""SELECT count(*) FILTER (billing_month <> '{M}') AS first_run, CAST(0 AS BIGINT) AS second_run, count(*) FILTER (billing_month <> '{M}') AS fact,
    CAST(0 AS BIGINT) AS closed, count(DISTINCT billing_month) FILTER (billing_month = '{M}') AS refused FROM charges""")
def st1(s, d):
    """Every daily file as a stream, run twice, with one month closed before."""
    root = folder(s)
    lake, daily = Lake(s, f"{root}/lake"), day_files(s, d, root)
    lake.set_months([M], "CLOSED", "MONTHLY")
    schema = s.read.parquet(daily).drop("day").schema
    stored = []
    for _ in range(2):
        stream.start(lake, daily, schema, f"{root}/checkpoint", files_per_batch=10_000).awaitTermination()
        stored.append(lake.tables.read("silver").count())
    closed = lake.tables.read("silver").where(F.col("billing_month") == M).count()
    refused = lake.tables.read("pipeline_run").where(F.col("message") == "closed for daily loads").count()
    fact = lake.tables.read("fact_cost_usage").count()
    return counted(s, first_run=stored[0], second_run=stored[1] - stored[0], fact=fact, closed=closed, refused=refused)


@query("sec1_stored", "SELECT billing_month, count(*) AS charge_lines, CAST(sum(BilledCost) AS DOUBLE) AS billed_cost FROM mine_charges GROUP BY ALL")
def sec1_stored(s, d):
    """The viewer's lines of a stored serving table, of which only the viewer's parts are read."""
    t = Tables(s, folder(s))
    scoping.store(t, serving_rows(s, d), "serving")
    apps = t.read("serving").select("application_code").distinct()
    seen = scoping.scoped_stored(t, "serving", mine(s, "owner"), scopes_of(apps), "prod")
    return seen.groupBy("billing_month").agg(F.count("*").alias("charge_lines"), F.sum("billed_cost").alias("billed_cost"))


@query("dq3_ledger", r"""WITH f AS (SELECT count(*) FILTER (regexp_matches(html, '[a-zA-Z0-9_.+%-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')) AS n,
    count(*) FILTER (page_id % 5 = 0 AND regexp_matches(html, '[a-zA-Z0-9_.+%-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}')) AS m FROM pages)
    SELECT 'first' AS scan, n AS values, CAST(1 AS BIGINT) AS entries FROM f UNION ALL SELECT 'again', n, 1 FROM f UNION ALL SELECT 'more rows', n + m, 2 FROM f""")
def dq3_ledger(s, d):
    """A stored table scanned, scanned again, and after an append: the ledger has an entry for each write that was read."""
    lake, pages = Lake(s, folder(s)), s.read.parquet(f"{d}/pages.parquet")
    lake.tables.append(pages, "pages")
    out = None
    for scan in ("first", "again", "more rows"):
        if scan == "more rows":
            lake.tables.append(pages.where("page_id % 5 = 0"), "pages")
        found = lake.privacy_scan("pages").where("column = 'html'").select(F.lit(scan).alias("scan"), "values")
        entries = lake.tables.read("privacy_ledger").where("column = 'html'").agg(F.count("*").alias("entries"))
        one = found.crossJoin(F.broadcast(entries))  # one row each
        out = one if out is None else out.unionByName(one)
    return out
