"""Tables and loads on small sources written out by hand."""

import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from costlake.operators import audit, scoping
from costlake.operators.tables import Tables
from costlake.plans import gold, marts
from costlake.plans.pipelines import Lake
from costlake.queries.registry import lines
from costlake.queries.storage import sources
from costlake.sources import files

SF = "/root/testdata/sf0.001"
DAYS = ("1998-03-02", "1998-03-03", "1998-04-01")


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("days"))
    rows = sources(spark, SF).where(F.col("day").cast("string").isin(*DAYS)).drop("billing_month").cache()
    for day in DAYS:
        rows.where(F.col("day") == day).drop("day").repartition(1).write.parquet(f"{root}/daily/{day[:4]}/{day[5:7]}/{day}.parquet")
    return {day: f"{root}/daily/{day[:4]}/{day[5:7]}/{day}.parquet" for day in DAYS}, {day: rows.where(F.col("day") == day).count() for day in DAYS}


def test_daily_loads_respect_closed_months(spark, days, tmp_path):
    paths, counts = days
    lake = Lake(spark, str(tmp_path))
    lake.set_months(["1998-03"], "CLOSED", "MONTHLY")
    with pytest.raises(audit.ControlError, match="closed"):
        lake.load_day(paths["1998-03-02"])
    raw = files.with_lineage(spark.read.parquet(*paths.values()), "r", "DAILY", "PROVISIONAL")
    assert lake.load_days(raw) == {"bronze": counts["1998-04-01"], "silver": counts["1998-04-01"]}
    assert [r[0] for r in lake.tables.read("silver").select("billing_month").distinct().collect()] == ["1998-04"]
    refused = lake.tables.read("pipeline_run").where("status = 'FAILED'").collect()
    assert {r["billing_month"] for r in refused} == {"1998-03"} and len(refused) == 2
    assert lake.load_days(raw)["silver"] == 0
    assert lake.daily_findings(paths["1998-04-01"]).collect() == []


def test_privacy_gate_stops_a_daily_load(spark, days, tmp_path):
    paths, _ = days
    lake = Lake(spark, str(tmp_path))
    named = spark.read.parquet(paths["1998-04-01"]).withColumn("ServiceName", F.lit("jane@corp.example"))
    named.write.parquet(f"{tmp_path}/source.parquet")
    raw = files.with_lineage(spark.read.parquet(f"{tmp_path}/source.parquet"), "r", "DAILY", "PROVISIONAL")
    with pytest.raises(audit.ControlError, match="names somebody"):
        lake.load_days(raw)
    assert not lake.tables.exists("bronze") and not lake.tables.exists("silver")


def test_append_survives_a_broken_run(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    make = lambda *names: spark.createDataFrame([(f, i) for f in names for i in range(3)], "_source_file string, v int")
    assert t.append_unseen(make("a"), "raw") == 3
    # a run that wrote rows and sources and broke before it put its pointer in place
    t._put(make("b"), "raw", [])
    t._put(make("b").select("_source_file").distinct(), "raw/sources", [])
    assert t.read("raw").count() == 3
    assert t.append_unseen(make("a", "b", "c"), "raw") == 6
    assert t.append_unseen(make("a", "b", "c"), "raw") == 0
    assert t.read("raw").count() == 9


def test_two_writers_of_one_source(spark, tmp_path, monkeypatch):
    """The second writer looked before the first was done; it looks again and appends nothing."""
    one, other = Tables(spark, str(tmp_path)), Tables(spark, str(tmp_path))
    rows = spark.createDataFrame([("a", 1), ("a", 2)], "_source_file string, v int")
    one.append_unseen(spark.createDataFrame([("z", 0)], "_source_file string, v int"), "raw")
    put, first = other._put, []

    def overtaken(*args):
        if not first:
            first.append(one.append_unseen(rows, "raw"))
        return put(*args)

    monkeypatch.setattr(other, "_put", overtaken)
    assert other.append_unseen(rows, "raw") == 0 and first == [2] and one.read("raw").count() == 3
    # appends of different rows at a time lose nothing
    more, begun = spark.createDataFrame([("x", 9)], "_source_file string, v int"), []
    commit = other._commit
    monkeypatch.setattr(other, "_commit", lambda *a: (begun.append(begun or one.append(more, "raw")), commit(*a))[1])
    other.append(more, "raw")
    assert one.read("raw").count() == 5


def test_months_are_replaced_at_once(spark, tmp_path, monkeypatch):
    t = Tables(spark, str(tmp_path))
    month = lambda m, *values: spark.createDataFrame([(m, v) for v in values], "billing_month string, v int")
    t.append(month("2025-01", 1, 2).union(month("2025-02", 3)), "facts", ("billing_month",))
    before = t.read("facts")
    seen = lambda df: sorted(map(tuple, df.select("billing_month", "v").collect()))
    t.replace_month(month("2025-01", 7), "facts", "2025-01")
    assert seen(before) == [("2025-01", 1), ("2025-01", 2), ("2025-02", 3)]  # a reader that opened before
    assert seen(t.read("facts")) == [("2025-01", 7), ("2025-02", 3)]

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(t, "_commit", killed)
    with pytest.raises(KeyboardInterrupt):
        t.replace_month(month("2025-01", 8), "facts", "2025-01")
    monkeypatch.undo()
    assert seen(t.read("facts")) == [("2025-01", 7), ("2025-02", 3)]
    t.retain("facts", 1)
    assert seen(t.read("facts")) == [("2025-01", 7), ("2025-02", 3)]
    text = t.read("facts").where("billing_month = '2025-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(billing_month" in text


def test_a_merge_rewrites_few_files(spark, tmp_path):
    """The tags of one more day touch under a twentieth of the bridge's files; a day that brings nothing new touches none."""
    lines(spark, SF).write.parquet(f"{tmp_path}/source")
    t, all_lines = Tables(spark, str(tmp_path)), spark.read.parquet(f"{tmp_path}/source")
    keys, merge = ["resource_sk", "tag_sk"], lambda df: t.upsert(gold.bridge_resource_tag(df), "bridge", ["resource_sk", "tag_sk"], ("valid_from",), 256)
    day = F.to_date("ChargePeriodStart")
    first = all_lines.where(day != F.lit("1998-03-02"))
    merge(first)
    before = set(t.files("bridge"))
    assert merge(all_lines.where(day == F.lit("1998-06-01"))) == 0 and set(t.files("bridge")) == before
    earlier = all_lines.where(day == F.lit("1998-03-02")).limit(3).withColumn("ChargePeriodStart", F.lit("1990-01-01").cast("timestamp"))
    merge(earlier)
    after = set(t.files("bridge"))
    assert 0 < len(before - after) < 0.05 * len(before) and len(after) == len(before)
    want = gold.bridge_resource_tag(first.unionByName(earlier))
    assert t.read("bridge").exceptAll(want.select(t.read("bridge").columns)).isEmpty() and t.read("bridge").count() == want.select(keys).distinct().count()


def test_inserts_keep_stored_files(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    make = lambda *ks: spark.createDataFrame([(k, f"v{k}") for k in ks], "k int, v string")
    t.insert_missing(make(*range(40)), "d", ["k"], 8)
    before = t.files("d")
    assert t.insert_missing(make(3, 4), "d", ["k"], 8) == 0 and t.files("d") == before
    assert t.insert_missing(make(3, 50), "d", ["k"], 8) == 1 and set(before) < set(t.files("d"))
    assert t.read("d").columns == ["k", "v"] and t.read("d").count() == 41


def test_a_refresh_reads_its_month(spark, tmp_path, monkeypatch):
    """A second refresh leaves the facts of other months alone, and gives what a full rebuild gives, also where a resource has changed its group."""
    lake = Lake(spark, str(tmp_path))
    months = ["1998-03", "1998-04"]
    lines(spark, SF).where(F.col("billing_month").isin(months)).write.parquet(f"{tmp_path}/source")
    some = spark.read.parquet(f"{tmp_path}/source")
    shared = some.where("billing_month = '1998-03'").select("ResourceId").first()[0]
    later = some.where("billing_month = '1998-04'")
    moved = later.limit(2).withColumns({"ResourceId": F.lit(shared), "x_ResourceGroupName": F.lit("rg-new"), "ChargePeriodStart": F.lit("1999-01-01").cast("timestamp")})
    lake.tables.append(some.where("billing_month = '1998-03'"), "silver", ("billing_month",))
    lake.refresh(["1998-03"])
    lake.tables.append(later.unionByName(moved), "silver")
    read, opened = Tables.read, []

    def watched(self, name):
        frame = read(self, name)
        if name == "fact_cost_usage":
            opened.append(frame)
        return frame

    kept = [f for f in lake.tables.files("fact_cost_usage") if "1998-03" in f]
    monkeypatch.setattr(Tables, "read", watched)
    plans = []
    replace = Lake._replace
    monkeypatch.setattr(Lake, "_replace", lambda self, frame, name, m: (plans.append((name, frame._jdf.queryExecution().toString())), replace(self, frame, name, m))[1])
    lake.refresh(["1998-04"])
    monkeypatch.undo()
    assert kept and kept == [f for f in lake.tables.files("fact_cost_usage") if "1998-03" in f]
    of_facts = [text for name, text in plans if name.startswith("state_")]
    assert len(of_facts) == 5 and all("1998-04" in x.split("PartitionFilters")[1].splitlines()[0] and "1998-03" not in x.split("PartitionFilters")[1].splitlines()[0] for x in of_facts)
    assert len(opened) == 1  # states only; no mart reads facts
    full = marts.Gold(lake.tables.read("silver"))
    for name, mart in marts.MARTS.items():
        want, got = mart(full), lake.tables.read(name)
        both = [sorted(map(tuple, df.select(*(F.col(n).cast("string") for n in want.columns)).collect()), key=str) for df in (want, got.select(*(F.col(n).cast(k) for n, k in want.dtypes)))]
        assert both[0] == both[1], name
    groups = lake.tables.read("dm_cost_by_resource_group_month").where("resource_group_name = 'rg-new'")
    assert {r["billing_month"] for r in groups.collect()} == {"1998-03", "1998-04"}


def test_no_line_is_expanded(spark):
    for name in ("dm_executive_summary_monthly", "dm_data_quality_monthly"):
        text = marts.MARTS[name](marts.Gold(lines(spark, SF)))._jdf.queryExecution().toString()
        assert "Expand" not in text, name


def test_columns_and_retention(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    t.append(spark.createDataFrame([("m", 1)], "billing_month string, v int"), "x", ("billing_month",))
    t.append(spark.createDataFrame([("n", 2, "more")], "billing_month string, v int, w string"), "x", ("billing_month",))
    assert sorted(map(tuple, t.read("x").select("billing_month", "v", "w").collect())) == [("m", 1, None), ("n", 2, "more")]
    assert t.read("x").columns[-1] == "billing_month"
    for n in range(4):
        t.rebuild(spark.range(n + 1), "d")
    assert len(t.retain("d")) == 2 and t.read("d").count() == 4 and t.retain("d") == []


def test_unrepeated_lines_stay_where_they_are(spark, tmp_path):
    lines(spark, SF).limit(200).write.parquet(f"{tmp_path}/lines")
    stored = spark.read.parquet(f"{tmp_path}/lines")
    plan = lambda df: df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert not any(word in plan(gold.fact_cost_usage(stored)) for word in ("hashpartitioning", "Window", "Join"))
    doubled = gold.fact_cost_usage(stored.union(stored.limit(3)))
    # one window, over the lines that a broadcast of the repeated hashes lets through
    assert plan(doubled).count("hashpartitioning(_source_file") == 1 and "SortMergeJoin" not in plan(doubled)
    assert doubled.select("cost_usage_sk").distinct().count() == 203


@pytest.mark.parametrize("few", [gold.FEW_REPEATED, 2])
def test_fact_keys_are_recomputed(spark, monkeypatch, few):
    """The key hashes the file, the line's content as JSON and its number among equal lines."""
    monkeypatch.setattr(gold, "FEW_REPEATED", few)
    clean = lines(spark, SF).limit(40).cache()
    doubled = clean.union(clean.limit(5))
    content = [c for c in sorted(doubled.columns) if not c.startswith("_")]
    rows = doubled.select("_source_file", F.to_json(F.struct(*content), {"ignoreNullFields": "false"}).alias("j")).collect()
    seen, want = {}, set()
    for r in rows:
        assert set(json.loads(r["j"])) == set(content)
        digest = hashlib.sha256(r["j"].encode()).hexdigest()
        number = seen[r["_source_file"], digest] = seen.get((r["_source_file"], digest), 0) + 1
        for tag in ("fact", "charge"):
            want.add(hashlib.sha256(f"{tag}||{r['_source_file']}||{digest}:{number}".encode()).hexdigest())
    got = gold.fact_cost_usage(doubled).select("cost_usage_sk", "charge_id").collect()
    assert {k for r in got for k in r} == want and len(want) == 2 * len(rows)


def test_a_failed_collection_is_logged(spark, tmp_path):
    from costlake.plans import finance
    from costlake.queries.storage import cost_sources

    lake, (bill, estimate) = Lake(spark, str(tmp_path)), cost_sources(spark, SF)
    lake.collect_costs(bill, estimate, publish=False)
    assert not lake.tables.exists("platform_cost_run")
    with pytest.raises(audit.ControlError, match="duplicate"):
        lake.collect_costs(bill.union(bill), estimate, publish=True)
    assert not lake.tables.exists("platform_cost_daily")
    lake.collect_costs(bill, estimate, publish=True)
    failed, good = sorted(lake.tables.read("platform_cost_run").collect(), key=lambda r: r["started_at"])
    assert (failed["status"], failed["rows"], failed["content_digest"]) == ("COLLECTION_FAILED", None, None) and "duplicate" in failed["message"]
    assert good["status"] == "SUCCESS" and good["rows"] == good["gcp_rows"] + good["databricks_rows"] and len(good["content_digest"]) == 64
    assert failed["finished_at"] >= failed["started_at"] and good["finished_at"] >= good["started_at"]
    # the digest follows the content, not the order of rows
    lake.collect_costs(bill.repartition(3), estimate.repartition(2), publish=True)
    lake.collect_costs(bill.where("service <> 'click'"), estimate, publish=True)
    digests = [r["content_digest"] for r in lake.tables.read("platform_cost_run").where("status = 'SUCCESS'").orderBy("started_at").collect()]
    assert digests[0] == digests[1] != digests[2]
    assert finance.COST_KEYS


def test_a_stored_table_is_scanned_once(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    make = lambda *texts: spark.createDataFrame([(x, 1) for x in texts], "t string, n int")
    lake.tables.append(make("jane@corp.example", "fine", "Acme Ltd"), "notes")
    counted = lambda *rule: {r["column"]: r["values"] for r in lake.privacy_scan("notes", *rule).collect()}
    assert counted() == {"t": 1}
    opened, unscanned = [], Tables.unscanned
    monkeypatch.setattr(Tables, "unscanned", lambda self, *a: (opened.append(unscanned(self, *a)), opened[-1])[1])
    assert counted() == {"t": 1} and opened == [None]  # no data file is read
    lake.tables.append(make("joe@corp.example"), "notes")
    assert counted() == {"t": 2} and opened[-1].count() == 1
    assert counted(r"(?i)\bacme\b") == {"t": 3} and opened[-1].count() == 4  # another rule
    lake.tables.rebuild(make("fine"), "notes")
    assert counted() == {"t": 0}


def test_a_viewer_reads_own_parts(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    charges = spark.createDataFrame([("prod", f"A{i % 40}" if i % 7 else None, i) for i in range(400)] + [("dev", "A1", 9999)], "environment string, application_code string, cost int")
    scoping.store(t, charges, "serving")
    scopes = spark.createDataFrame([("prod", f"A{i}", f"D{i % 9}", "S", True) for i in range(40)], "environment string, application_code string, domain_id string, subdomain_id string, is_active boolean")
    grants = spark.createDataFrame(
        [("p", "u", "prod", "APPLICATION_OWNER", "APPLICATION", "A1", True, None, None), ("p", "u", "prod", "DOMAIN_MANAGER", "DOMAIN", "D3", True, None, None), ("p", "a", "prod", "FINOPS_ADMIN", "ALL", "*", True, None, None)],
        "identity_provider string, principal_id string, environment string, role string, scope_type string, scope_id string, is_active boolean, valid_from timestamp, valid_to timestamp",
    )
    for who in ("u", "a", "nobody"):
        mine = scoping.entitlements_of(grants, "p", who, "prod", F.lit(datetime(2025, 1, 1)))
        seen = scoping.scoped_stored(t, "serving", mine, scopes, "prod")
        want = scoping.scoped(charges, mine, scopes, "prod")
        assert sorted(map(tuple, seen.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str), who
        if who == "u":
            text = seen._jdf.queryExecution().toString()
            filters = text.split("PartitionFilters: [")[1].split("]")[0]
            assert "application_part" in filters and "from_json" not in text
            assert len(seen.inputFiles()) > 0 and 0 < seen.count() < 100


def test_admin_reports_need_an_admin(spark):
    runs = spark.createDataFrame([("r1",), ("r2",)], "run_id string")
    grants = spark.createDataFrame(
        [("p", "a", "prod", "FINOPS_ADMIN", "ALL", "*", True, None, None), ("p", "o", "prod", "APPLICATION_OWNER", "APPLICATION", "*", True, None, None)],
        "identity_provider string, principal_id string, environment string, role string, scope_type string, scope_id string, is_active boolean, valid_from timestamp, valid_to timestamp",
    )
    shown = lambda who: scoping.for_admins(runs, scoping.entitlements_of(grants, "p", who, "prod", F.lit(datetime(2025, 1, 1)))).count()
    assert (shown("a"), shown("o"), shown("nobody")) == (2, 0, 0)
