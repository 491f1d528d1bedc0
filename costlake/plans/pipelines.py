"""Loads a user calls: a day, a month, a range, refresh of the products, rebuild and promotion."""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit, contract
from ..operators.tables import Tables
from ..sources import files
from . import gold, marts

RUNS = "run_id string, environment string, pipeline_name string, billing_month string, status string, started_at timestamp, finished_at timestamp, message string"
COLLECTIONS = (
    "run_id string, environment string, status string, started_at timestamp, finished_at timestamp, rows long, gcp_rows long, databricks_rows long, "
    "content_digest string, message string"
)
LEDGER = "table string, leaf string, rule string, column string, values long"
STATUS = "billing_month string, status string, authoritative_source string, updated_at timestamp"
#: Tables of a refresh that are written at a time.
AT_ONCE = 4
# How the tables of a layer begin.
LAYERS = {"bronze": "bronze", "silver": "silver", "gold": ("dim_", "bridge_", "fact_"), "marts": "dm_"}
#: Hash buckets of the tables that merges write; the others are small.
MERGE_BUCKETS = {"bridge_resource_tag": 256, "dim_resource": 64, "dim_sku": 16, "dim_billing_scope": 16, "dim_tag": 16}
#: Versions of the rewritten tables that stay for readers.
KEPT_VERSIONS = 3
TYPE1 = {"dim_billing_scope": ["billing_scope_sk"], "dim_resource": ["resource_sk"], "bridge_resource_tag": ["resource_sk", "tag_sk"]}


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Lake:
    """The tables of one environment and the loads that change them."""

    def __init__(self, spark: SparkSession, root: str, environment: str = "dev"):
        self.spark, self.tables, self.environment = spark, Tables(spark, root), environment

    # --- run log and month states: appended events, newest wins
    def log_run(self, run_id: str, pipeline: str, month: str | None, status: str, started: datetime, message: str | None = None) -> None:
        finished = None if status == "RUNNING" else now()
        row = (run_id, self.environment, pipeline, month, status, started, finished, message)
        self.tables.append(self.spark.createDataFrame([row], RUNS), "pipeline_run")

    def set_months(self, months: list[str], status: str, source: str) -> None:
        rows = [(m, status, source, now()) for m in months]
        self.tables.append(self.spark.createDataFrame(rows, STATUS), "month_status")

    def month_status(self) -> DataFrame:
        from .serving import latest

        events = self.tables.read_or_empty("month_status", self.spark.createDataFrame([], STATUS))
        return latest(events, ["billing_month"], "updated_at")

    def closed(self) -> DataFrame:
        """Months that refuse daily loads."""
        return self.month_status().where(F.col("status").isin(*files.CLOSED)).select("billing_month")

    def require_open(self, month: str) -> None:
        audit.require_empty(self.closed().where(F.col("billing_month") == month), "closed for daily loads")

    def logged(self, pipeline: str, month: str | None, work):
        """Run work with a run id; its end or failure is logged, a failure raised again."""
        run_id, started = uuid.uuid4().hex, now()
        self.log_run(run_id, pipeline, month, "RUNNING", started)
        try:
            result = work(run_id)
        except Exception as e:
            self.log_run(run_id, pipeline, month, "FAILED", started, str(e)[:500])
            raise
        self.log_run(run_id, pipeline, month, "SUCCESS", started)
        return result

    # --- loads
    def _clean(self, raw: DataFrame) -> DataFrame:
        """Privacy gate, then contract."""
        audit.enforce_privacy(raw.drop(*(c for c in raw.columns if c.startswith("_"))))
        return contract.canonical(contract.enforce(contract.conform(raw)))

    def load_day(self, path: str) -> dict[str, int]:
        """One daily source of one month, as load_days(); a closed month is an error."""

        def work(run_id: str) -> dict[str, int]:
            raw = files.with_lineage(files.read_daily(self.spark, path), run_id, "DAILY", "PROVISIONAL")
            audit.one_value(raw, "_source_file")
            clean = self._clean(raw)
            self.require_open(audit.one_value(clean, "billing_month"))
            return self._store_days(raw, clean)

        month = audit.one_value(self.spark.read.parquet(path), F.date_format(F.to_date("BillingPeriodStart"), "yyyy-MM"))
        return self.logged("daily_incremental", month, work)

    def load_days(self, raw: DataFrame) -> dict[str, int]:
        """Daily sources of several months with their lineage columns: privacy gate, month-open guard, raw append, contract,
        clean append, refresh of the months' products. Closed months take nothing; each is logged as a failed load.

        The contract runs on the sources even if the raw rows were there before, so a run
        that stopped halfway is completed by the next.
        """
        month = F.date_format(F.to_date("BillingPeriodStart"), "yyyy-MM")

        def work(run_id: str) -> dict[str, int]:
            shut = self.closed()
            marked = raw.withColumn("_month", month)
            for r in marked.select(F.col("_month").alias("billing_month")).distinct().join(shut, "billing_month", "left_semi").collect():  # months
                self.log_run(uuid.uuid4().hex, "daily_incremental", r["billing_month"], "FAILED", now(), "closed for daily loads")
            started = now()
            open_ = marked.join(shut.withColumnRenamed("billing_month", "_month"), "_month", "left_anti").drop("_month")
            if open_.isEmpty():
                return {"bronze": 0, "silver": 0}
            clean = self._clean(open_)
            stored = self._store_days(open_, clean)
            for r in clean.select("billing_month").distinct().collect():  # months
                self.log_run(uuid.uuid4().hex, "daily_incremental", r["billing_month"], "SUCCESS", started)
            return stored

        return self.logged("daily_incremental", None, work)

    def _store_days(self, raw: DataFrame, clean: DataFrame) -> dict[str, int]:
        bronze = self.tables.append_unseen(raw, "bronze")
        silver = self.tables.append_unseen(clean, "silver", ("billing_month",))
        months = sorted(r["billing_month"] for r in clean.select("billing_month").distinct().collect())
        if silver:
            self.refresh(months)
        self.set_months(months, "OPEN", "DAILY")
        return {"bronze": bronze, "silver": silver}

    def close_month(self, path: str, month: str) -> DataFrame:
        """Replace a month by its authoritative source, as close_months()."""
        return self.close_months(self.spark.read.parquet(path), [month])

    def close_months(self, source: DataFrame, months: list[str]) -> DataFrame:
        """Replace months by their authoritative sources between two snapshots; the reconciliations are stored, then enforced.

        All months go through each step together: one scan for the contract, one aggregate
        a snapshot, one write.
        """

        def work(run_id: str) -> DataFrame:
            raw = files.with_lineage(source, run_id, "MONTHLY", "FINAL")
            clean = self._clean(raw)
            several = audit.several(clean, "_source_file", "billing_month")
            audit.require_empty(several, "sources of several months")
            self.tables.append_unseen(raw, "bronze")
            keys = ["billing_month"]
            stored = self.tables.read_or_empty("silver", clean).where(F.col("billing_month").isin(months))
            before = self._keep(audit.snapshot(stored, keys), "BEFORE", run_id)
            given = self._keep(audit.snapshot(clean, keys), "SOURCE", run_id)
            self.set_months(months, "RECONCILING", "MONTHLY")
            self.tables.replace_months(clean, "silver", months)
            after = self._keep(audit.snapshot(self.tables.read("silver").where(F.col("billing_month").isin(months)), keys), "AFTER", run_id)
            found = audit.reconcile(before, given, after, keys).withColumns(
                {"run_id": F.lit(run_id), "environment": F.lit(self.environment), "reconciled_at": F.current_timestamp()}
            )
            self.tables.append(found, "monthly_reconciliation")
            mine = self.tables.read("monthly_reconciliation").where(F.col("run_id") == run_id)
            audit.require_empty(mine.where("status <> 'PASSED'"), "reconciliation failed")
            self.refresh(months)
            self.set_months(months, "CLOSED_DATA_LOADED", "MONTHLY")
            return mine

        return self.logged("monthly_close", months[0] if len(months) == 1 else None, work)

    def _keep(self, snapshot: DataFrame, stage: str, run_id: str) -> DataFrame:
        """Store a snapshot and read it back, so that later changes of the source do not change it."""
        kept = snapshot.withColumns({"capture_stage": F.lit(stage), "run_id": F.lit(run_id), "captured_at": F.current_timestamp()})
        if not kept.isEmpty():
            self.tables.append(kept, "month_snapshot")
        stored = self.tables.read_or_empty("month_snapshot", kept)
        return stored.where((F.col("run_id") == run_id) & (F.col("capture_stage") == stage)).drop("capture_stage", "run_id", "captured_at")

    def backfill(self, paths: dict[str, str], first: str, last: str) -> list[str]:
        """Close all months of a range; a month without a source is an error."""
        months = [r[0] for r in files.months_between(self.spark, first, last).collect()]
        missing = [m for m in months if m not in paths]
        if missing:
            raise audit.ControlError(f"no source for {missing}")
        self.close_months(self.spark.read.parquet(*(paths[m] for m in months)), months)
        return months

    def refresh(self, months: list[str]) -> None:
        """Dimensions, facts and states of some months, then the marts that follow from them.

        Facts are read of these months only. Marts by month are replaced for these months and
        for those in which a resource or scope occurs whose attributes have changed, from the lines if
        there are none of those, else from states; marts over all months are made from states. Tables of one step do not depend on each other:
        AT_ONCE are written at a time.
        """
        t = self.tables
        lines = t.read("silver").where(F.col("billing_month").isin(months))
        before = {name: t.version(name) for name in TYPE1}

        def dimension(name: str) -> None:
            frame, keys, buckets = gold.DIMENSIONS[name](lines), TYPE1.get(name), MERGE_BUCKETS.get(name, 1)
            if keys:
                t.upsert(frame, name, keys, ("valid_from",), buckets)
            elif name == "dim_date":
                t.upsert(frame, name, ["date_sk"], buckets=buckets)
            else:
                t.insert_missing(frame, name, [next(c for c in frame.columns if c.endswith("_sk"))], buckets)

        steps = [partial(dimension, n) for n in gold.DIMENSIONS]
        steps.append(lambda: t.replace_months(gold.fact_cost_usage(lines, by=("billing_month",)), "fact_cost_usage", months, dealt=True))
        self._at_once(steps)
        fact = t.read("fact_cost_usage").where(F.col("billing_month").isin(months))
        steps = [partial(self._replace, marts.state(fact, n), n, months) for n in marts.STATES if n != "state_resource"]
        self._at_once([*steps, partial(self._replace, marts.state_resource(lines), "state_resource", months)])
        stale = self._stale_months(before, set(months))
        of_lines, of_states = StoredGold(t, months), StoredGold(t)
        steps = [partial(self._replace, marts.MARTS[n](of_lines), n, months) for n in marts.OF_LINES]
        chosen = LinesGold(t, months) if stale == set(months) else StoredGold(t, sorted(stale))
        steps += [partial(self._replace, marts.MARTS[n](chosen), n, sorted(stale)) for n in marts.OF_MONTHS]
        steps += [partial(t.rebuild, marts.MARTS[n](of_states), n) for n in marts.OF_ALL]
        self._at_once(steps)
        for name in (*gold.DIMENSIONS, "fact_cost_usage", *marts.STATES, *marts.MARTS):
            t.retain(name, KEPT_VERSIONS)

    @staticmethod
    def _at_once(steps: list) -> None:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            for done in [pool.submit(step) for step in steps]:
                done.result()

    def _replace(self, frame: DataFrame, name: str, months: list[str]) -> int:
        return self.tables.replace_parts(frame, name, "billing_month", months, dealt=name == "state_resource")

    def _stale_months(self, before: dict[str, int], months: set[str]) -> set[str]:
        """months, and those in whose states a key occurs whose attributes differ from the version before."""
        found = set(months)
        for name, attributes in (("dim_resource", [*gold.RESOURCE, *gold.APPLICATION_TAGS]), ("dim_billing_scope", list(gold.SCOPE))):
            keys = TYPE1[name]
            moved = self.tables.altered(name, before[name], keys, attributes)
            if moved is not None:
                states = self.tables.read("state_resource").select("billing_month", *keys)
                found |= {r[0] for r in states.join(moved, keys, "left_semi").select("billing_month").distinct().collect()}  # months
        return found

    # --- controls
    def privacy_scan(self, name: str, organizations: str | None = None, pseudonym: str | None = None) -> DataFrame:
        """(column, values): how many values of each text column of a stored table name somebody.

        Directories of a write never change, so a ledger keeps what was found in each under a
        rule, and a scan opens only those that it does not know. A changed rule scans all.
        """
        rule = hashlib.sha256(repr((audit.EMAIL, organizations, pseudonym)).encode()).hexdigest()
        ledger = lambda: self.tables.read_or_empty("privacy_ledger", self.spark.createDataFrame([], LEDGER)).where((F.col("table") == name) & (F.col("rule") == rule))
        rows = self.tables.unscanned(name, {r["leaf"] for r in ledger().select("leaf").distinct().collect()})  # directories
        if rows is not None:
            texts = [n for n, k in rows.dtypes if k == "string" and n != "_leaf"]
            counts = rows.groupBy("_leaf").agg(*(F.count_if(audit.names_somebody(F.col(f"`{c}`"), organizations, pseudonym)).alias(c) for c in texts))
            found = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("values")) for c in texts]
            entries = counts.select(F.lit(name).alias("table"), F.col("_leaf").alias("leaf"), F.lit(rule).alias("rule"), F.inline(F.array(*found)))
            if not entries.isEmpty():
                self.tables.append(entries, "privacy_ledger")
        live = self.spark.createDataFrame([(x,) for x in self.tables.leaves(name)], "leaf string")
        return ledger().join(live, "leaf", "left_semi").groupBy("column").agg(F.sum("values").alias("values"))

    def daily_findings(self, path: str, other: Lake | None = None, tolerance: float = audit.TOLERANCE) -> DataFrame:
        """The daily control: everything that is wrong with one loaded source, from the file to the marts; no row if all is well.

        (finding, expected, found), both as text. The source must be one file of one month.
        other: the environment whose facts of the month must agree.
        """
        raw = files.with_lineage(files.read_daily(self.spark, path), "", "DAILY", "PROVISIONAL")
        source = audit.one_value(raw, "_source_file")
        month = audit.one_value(raw, F.date_format(F.to_date("BillingPeriodStart"), "yyyy-MM"))
        read = self.tables.read
        measure = lambda df, name, c="BilledCost", *more: df.agg(  # noqa: E731  one row
            F.count("*").alias(f"{name}_rows"), F.coalesce(F.sum(F.col(c).cast("decimal(38,6)")), F.lit(0)).alias(f"{name}_cost"), *more
        )
        of_file, of_month = F.col("_source_file") == source, F.col("billing_month") == month
        fact = read("fact_cost_usage").where(of_month)
        runs = read("pipeline_run").where(of_month & (F.col("pipeline_name") == "daily_incremental") & (F.col("environment") == self.environment))
        newest = lambda at, c: F.max_by(c, F.struct(at, c))
        one_rows = [
            measure(raw, "source"),
            measure(read("bronze").where(of_file), "bronze", "BilledCost", F.countDistinct("_ingestion_run_id").alias("runs_of_file")),
            measure(read("silver").where(of_file), "silver"),
            measure(read("silver").where(of_month), "silver_month"),
            measure(fact, "gold", "billed_cost"),
            audit.duplicates(fact, ["cost_usage_sk"]).agg(F.count("*").alias("duplicate_keys")),
            runs.where("status <> 'RUNNING'").agg(newest("started_at", "status").alias("latest_run")),
            self.month_status().where(of_month).agg(F.max(F.concat_ws(" ", "status", "authoritative_source")).alias("month_state")),
            read("dm_monthly_billing").where(of_month).agg(F.count("*").alias("monthly_rows"), F.sum("monthly_billed_cost").alias("monthly_cost")),
            read("dm_daily_billing").where(F.date_format("date", "yyyy-MM") == month).agg(F.count("*").alias("daily_rows")),
        ]
        if other:
            one_rows.append(measure(other.tables.read("fact_cost_usage").where(of_month), "other", "billed_cost"))
        facts = one_rows[0]
        for one in one_rows[1:]:
            facts = facts.crossJoin(F.broadcast(one))  # one row each
        same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
        near = lambda a, b: F.coalesce(F.abs(F.col(a) - F.col(b)) < tolerance, F.lit(False))
        checks = [("source without rows", "source_rows", F.lit("more than 0"), F.col("source_rows") > 0)]
        for layer in ("bronze", "silver"):
            checks += [(f"{layer} rows of the file", f"{layer}_rows", F.col("source_rows"), same("source_rows", f"{layer}_rows"))]
            checks += [(f"{layer} cost of the file", f"{layer}_cost", F.col("source_cost"), near("source_cost", f"{layer}_cost"))]
        checks += [
            ("gold rows of the month", "gold_rows", F.col("silver_month_rows"), same("silver_month_rows", "gold_rows")),
            ("gold cost of the month", "gold_cost", F.col("silver_month_cost"), near("silver_month_cost", "gold_cost")),
            ("ingestion runs of the file", "runs_of_file", F.lit(1), F.col("runs_of_file") == 1),
            ("duplicate fact keys", "duplicate_keys", F.lit(0), F.col("duplicate_keys") == 0),
            ("latest run", "latest_run", F.lit("SUCCESS"), F.col("latest_run").eqNullSafe(F.lit("SUCCESS"))),
            ("month state", "month_state", F.lit("OPEN DAILY"), F.col("month_state").eqNullSafe(F.lit("OPEN DAILY"))),
            ("monthly mart rows", "monthly_rows", F.lit(1), F.col("monthly_rows") == 1),
            ("monthly mart cost", "monthly_cost", F.col("gold_cost"), (F.col("monthly_rows") != 1) | near("gold_cost", "monthly_cost")),
            ("daily mart rows", "daily_rows", F.lit("more than 0"), F.col("daily_rows") > 0),
        ]
        if other:
            checks += [
                ("rows elsewhere", "other_rows", F.col("gold_rows"), same("gold_rows", "other_rows")),
                ("cost elsewhere", "other_cost", F.col("gold_cost"), near("gold_cost", "other_cost")),
            ]
        text = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
        found = [
            F.when(~ok, F.struct(F.lit(n).alias("finding"), text(wanted).alias("expected"), text(F.col(c)).alias("found"))) for n, c, wanted, ok in checks
        ]
        return facts.select(F.explode(F.array_compact(F.array(*found))).alias("_f")).select("_f.finding", "_f.expected", "_f.found")

    def preflight(self, expected: dict[str, int], logs: tuple[str, ...] = ("pipeline_run", "month_snapshot", "monthly_reconciliation", "month_status")) -> DataFrame:
        """What keeps this environment from a first load (audit.preflight over its tables by layer)."""
        layers: dict[str, dict[str, DataFrame]] = {}
        for name in self.tables.names():
            layer = next((k for k, prefix in LAYERS.items() if name.startswith(prefix)), None)
            if layer:
                layers.setdefault(layer, {})[name] = self.tables.read(name)
        none = self.spark.createDataFrame([], "environment string")
        log = {n: self.tables.read_or_empty(n, none) for n in logs}
        log = {n: df if "environment" in df.columns else df.withColumn("environment", F.lit(self.environment)) for n, df in log.items()}
        return audit.preflight(layers, expected, log, self.environment)

    def collect_costs(self, bill: DataFrame, usage: DataFrame, publish: bool) -> DataFrame:
        """Merge bill and estimate, check every rule, and overwrite the daily and monthly tables; a preview writes nothing.

        Every publishing run leaves a row in platform_cost_run: with the digest of what was
        published and the rows of each provider, or as COLLECTION_FAILED with the reason.
        """
        run_id, started = uuid.uuid4().hex, now()
        try:
            merged, published = self._collected(bill, usage, publish)
        except Exception as e:
            if publish:
                self._log_collection(run_id, started, "COLLECTION_FAILED", {}, str(e)[:500])
            raise
        if publish:
            self._log_collection(run_id, started, "SUCCESS", published, None)
        return merged

    def _collected(self, bill: DataFrame, usage: DataFrame, publish: bool) -> tuple[DataFrame, dict]:
        from . import finance

        merged = bill.unionByName(usage, allowMissingColumns=True)
        audit.require_empty(audit.duplicates(merged, ["usage_date", *finance.COST_KEYS]), "duplicate cost rows")
        broken = contract.count_violations(merged, audit.platform_cost_rules()).first().asDict()
        if any(broken.values()):
            raise audit.ControlError(f"invalid cost rows: { {n: c for n, c in broken.items() if c} }")
        if not publish:
            return merged, {}
        self.tables.rebuild(merged, "platform_cost_daily")
        daily = self.tables.read("platform_cost_daily")
        self.tables.rebuild(finance.monthly_from_daily(daily), "platform_cost_monthly")
        return merged, audit.content_digest(daily, "provider", ("GCP", "Databricks")).first().asDict()

    def _log_collection(self, run_id: str, started: datetime, status: str, published: dict, message: str | None) -> None:
        got = published.get
        row = (run_id, self.environment, status, started, now(), got("rows"), got("gcp_rows"), got("databricks_rows"), got("content_digest"), message)
        self.tables.append(self.spark.createDataFrame([row], COLLECTIONS), "platform_cost_run")

    def rebuild_from(self, monthly: dict[str, str], daily: list[str], target: Lake) -> DataFrame:
        """Replay monthly sources (by month), then daily ones, into an empty target and compare the money of both; returns the differences."""
        audit.require_empty(audit.lineage(self.tables.read("silver")), "lineage")
        if monthly:
            target.close_months(target.spark.read.parquet(*monthly.values()), sorted(monthly))
        if daily:
            target.load_days(files.with_lineage(target.spark.read.parquet(*daily), "replay", "DAILY", "PROVISIONAL"))
        return audit.compare_money(audit.money_snapshot(self.tables.read("silver")), audit.money_snapshot(target.tables.read("silver")))

    def promote(self, target: Lake, names: list[str]) -> DataFrame:
        """Copy tables to another environment; schema, rows and money must agree. Refuses months that are closed there but open here."""
        audit.require_empty(audit.closed_elsewhere(self.month_status(), target.month_status(), files.CLOSED), "closed months")
        for name in names:
            source = self.tables.read(name)
            target.tables.rebuild(source, name)
            copy = target.tables.read(name)
            audit.require_empty(audit.same_copy(source, copy), f"the copy of {name}")
            if any(k.startswith("decimal") for _, k in source.dtypes) and {"billing_month", "date"} & set(source.columns):
                audit.require_empty(audit.compare_money(audit.money_snapshot(source), audit.money_snapshot(copy)), f"money of {name}")
        return files.table_counts({n: target.tables.read(n) for n in names})


class StoredGold(marts.Gold):
    """The star schema as stored, of some months or all, instead of built from lines; sums come from states."""

    def __init__(self, tables: Tables, months: list[str] | None = None):
        self.tables, self.months = tables, months
        super().__init__(self._chosen("silver"))

    def _chosen(self, name: str) -> DataFrame:
        frame = self.tables.read(name)
        return frame if self.months is None else frame.where(F.col("billing_month").isin(self.months))

    @property
    def fact(self) -> DataFrame:
        return self._chosen("fact_cost_usage")

    def sums(self, *keys: str) -> DataFrame:
        return self._chosen(marts.state_for(keys)).groupBy(*keys).agg(F.sum("billed_cost").alias("billed_cost"))

    def summed(self, joins: list[tuple[str, str]], *kept: str, take: list[str]) -> DataFrame:
        """The sums of states by surrogate key, joined with the stored dimensions."""
        out = self.sums(*kept, *(key for _, key in joins))
        for name, key in joins:
            out = out.join(self.dimension(name), key)
        return out

    def dimension(self, name: str) -> DataFrame:
        return self.tables.read(name)


class LinesGold(StoredGold):
    """Sums from the stored lines of some months by the parts of keys, which take fewer bytes than the hashes in states; Type 1 attributes are the stored ones."""

    def summed(self, joins: list[tuple[str, str]], *kept: str, take: list[str]) -> DataFrame:
        out = self.summed_parts(joins, *kept)
        for name, key in joins:
            more = self.looked_up(name, key, take)
            if more:
                stored = self.dimension(name)
                parts = gold.PARTS[key]()
                on = [n for n in parts if n in stored.columns]
                told = stored.select(*on, *more, F.col(key).alias("_key"))
                # the provider, a part of a resource's key, is no attribute: resources are told apart by their key where they meet
                same = [out[n] == told[n] for n in on] + ([] if len(on) == len(parts) else [told["_key"] == gold.resource_key_of(out["_provider"], out["resource_id"])])
                out = out.join(told, same).select(*(out[c] for c in out.columns), *more)
        return out
