"""Operators on small rows written out by hand."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from costlake.functions import expressions as X
from costlake.operators import audit, contract, joins, scoping
from costlake.operators.tables import TableError, Tables, align, inserted, upserted
from costlake.plans import finance, gold, marts
from costlake.sources import files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_allocation_policy(spark):
    cases = [
        (" Center_A ", "West Europe", "SOURCE", "Center_A"),
        (None, " WEST EUROPE ", "REGION_EUROPE", "CostCenter_Europe"),
        ("", "uk south", "REGION_EUROPE", "CostCenter_Europe"),
        ("Unknown", "Global", "GLOBAL_CORPORATE", "CostCenter_Corporate"),
        ("no cost center assigned", "South India", "REGION_CORPORATE", "CostCenter_Corporate"),
        (" unallocated costs ", None, "UNALLOCATED", "Unallocated Costs"),
        (None, "Mars", "UNALLOCATED", "Unallocated Costs"),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "x_CostCenter string, Region string")
    got = gold.cost_allocation(df, ("south india",)).select("allocation_method", "cost_center_allocated").collect()
    assert [tuple(r) for r in got] == [c[2:] for c in cases]


def test_savings_components_are_exclusive_and_complete(spark):
    data = [
        ("2025-01", "100", "90", "80", "Usage", "On-Demand", None),
        ("2025-01", "50", "40", "30", "Usage", "Commitment-Based", "Reservation"),
        ("2025-01", "50", "40", "20", "Usage", "Commitment-Based", "Savings Plan"),
        ("2025-01", "5", "5", "5", "Usage", "Dynamic", None),
        ("2025-01", "0", "0", "-5", "Adjustment", "On-Demand", None),
        ("2025-01", "7", "7", "7", "Purchase", "Commitment-Based", "Reservation"),
        ("2025-02", "0", "0", "0", "Usage", "On-Demand", None),
        (None, "9", "9", "9", "Usage", "On-Demand", None),
    ]
    names = "billing_month string, ListCost string, ContractedCost string, EffectiveCost string, ChargeCategory string, PricingCategory string, CommitmentDiscountType string"
    df = spark.createDataFrame(data, names).withColumns({c: F.col(c).cast("decimal(38,18)") for c in ("ListCost", "ContractedCost", "EffectiveCost")})
    got = {r["billing_month"]: r for r in marts.savings_monthly(marts.Gold(df)).collect()}
    assert set(got) == {"2025-01", "2025-02"}
    r = got["2025-01"]
    parts = ["usage_on_demand", "reservation", "savings_plan", "usage_dynamic", "adjustment", "other_effective_cost"]
    assert [int(r[p]) for p in parts] == [80, 30, 20, 5, -5, 7]
    assert sum(r[p] for p in parts) == r["effective_cost"] == 137
    assert abs(r["savings_rate"] - 100 * (212 - 137) / 212) < 1e-9 and got["2025-02"]["savings_rate"] == 0


def test_consumption_keeps_null_zero_and_sign_apart(spark):
    tags = '{"application-code":" A1 "}'
    data = [
        ("Usage", " GB ", "5"), ("Usage", "GB", "-2"), ("Usage", "GB", None), ("Usage", " Unknown ", "9"), ("Usage", None, "1"), ("Purchase", "GB", "50"), ("Usage", "Hours", "0"),
    ]
    df = spark.createDataFrame([("2025-01", tags, "S", "K", *d, datetime(2025, 1, 3)) for d in data],
        "billing_month string, Tags string, ServiceName string, SkuId string, ChargeCategory string, ConsumedUnit string, q string, ChargePeriodStart timestamp")
    got = {r["consumed_unit"]: r for r in finance.consumption(df.withColumn("ConsumedQuantity", F.col("q").cast("decimal(38,18)"))).collect()}
    assert set(got) == {"GB", None, "Hours"}
    assert (got["GB"]["consumed_quantity"], got["GB"]["usage_rows"], got["GB"]["measured_usage_rows"], got["GB"]["negative_quantity_rows"]) == (3, 3, 2, 1)
    assert got[None]["consumed_quantity"] is None and got[None]["missing_measurement_rows"] == 2
    assert got["Hours"]["consumed_quantity"] == 0 and got["GB"]["application_code"] == "A1"


def test_carbon_formula_and_exclusions(spark):
    data = [
        ("Virtual Machines", "Hours", "K", 1000.0, 1, 1, 0, 0, "Modelled"),
        ("Storage", "Hours", "K", 1.0, 1, 1, 0, 0, "unsupported service"),
        ("Virtual Machines", "GB", "K", 1.0, 1, 1, 0, 0, "unsupported unit"),
        ("Virtual Machines", "Hours", " unknown ", 1.0, 1, 1, 0, 0, "missing SKU"),
        ("Virtual Machines", "Hours", "K", 1.0, 2, 2, 1, 0, "invalid counters"),
        ("Virtual Machines", "Hours", "K", 1.0, 2, 2, 0, 1, "signed correction"),
        ("Virtual Machines", "Hours", "K", 1.0, 2, 1, 1, 0, "incomplete measurements"),
    ]
    names = "service_name string, consumed_unit string, sku_id string, consumed_quantity double, usage_rows long, measured_usage_rows long, missing_measurement_rows long, negative_quantity_rows long, want string"
    got = finance.carbon_scenario(spark.createDataFrame(data, names)).collect()
    assert [r["scenario_status"] for r in got] == [d[-1] for d in data]
    assert [round(got[0][c], 9) for c in finance.CARBON] == [1000, 60, 7.56, 16.56]
    assert all(r["kg_co2e"] is None and r["modelled_usage_rows"] == 0 for r in got[1:])


def test_unknown_amounts_poison_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 3)], "k string, v int")
    assert rows(df.groupBy("k").agg(X.sum_or_null(F.col("v")))) == [("a", None), ("b", 5)]


def test_validity_and_overlap(spark):
    t = datetime
    usage = spark.createDataFrame(
        [(1, "x", t(2024, 1, 1), t(2024, 1, 1, 1)), (2, "x", t(2024, 1, 9, 23, 30), t(2024, 1, 10, 0, 30)), (3, "y", t(2024, 1, 1), t(2024, 1, 3))], "id int, k string, a timestamp, b timestamp"
    )
    prices = spark.createDataFrame([("x", t(2023, 1, 1), t(2024, 1, 10), 1), ("x", t(2024, 1, 10), None, 2)], "k string, pf timestamp, pt timestamp, price int")
    assert rows(joins.validity_join(usage, prices, ["k"], "a", "pf", "pt", "b").select("id", "price")) == [(1, 1), (2, None), (3, None)]
    windows = spark.createDataFrame([(7, t(2024, 1, 1, 0, 45), t(2024, 1, 2, 12)), (8, t(2024, 1, 3), t(2024, 1, 4))], "w int, wa timestamp, wb timestamp")
    got = rows(joins.overlap_join(usage, windows, "a", "b", "wa", "wb").select("id", "w", "overlap_seconds"))
    assert got == [(1, 7, 900), (3, 7, 126_900)]


@pytest.fixture
def many(monkeypatch):
    monkeypatch.setattr(joins, "FEW", 0)


def timed(rng, n, longest):
    """n intervals of up to longest hours, many of them short, at odd seconds and at whole hours."""
    out = []
    for i in range(n):
        a = datetime(2023, 12, 28) + timedelta(seconds=rng.randrange(0, 400 * 86400) if i % 3 else 3600 * rng.randrange(0, 9600))
        out.append((i, a, a + timedelta(seconds=int(3600 * longest ** rng.random()) if i % 5 else 3600 * rng.randrange(0, 3))))
    return out


@pytest.mark.parametrize("few", [0, 10_000])
def test_overlaps_of_long_and_short_intervals(spark, monkeypatch, few):
    monkeypatch.setattr(joins, "FEW", few)
    rng = random.Random(3)
    records, windows = timed(rng, 300, 9000), timed(rng, 80, 9000)
    hot = [(1000 + i, datetime(2024, 5, 5, 1, i % 60), datetime(2024, 5, 5, 2, 30)) for i in range(200)]
    records += hot
    want = sorted((i, j, int((min(b, d) - max(a, c)).total_seconds())) for i, a, b in records for j, c, d in windows if min(b, d) > max(a, c))
    r = spark.createDataFrame(records, "id int, a timestamp, b timestamp")
    w = spark.createDataFrame(windows, "w int, wa timestamp, wb timestamp")
    got = joins.overlap_join(r, w, "a", "b", "wa", "wb")
    assert sorted(map(tuple, got.select("id", "w", "overlap_seconds").collect())) == want and len(want) > 1000
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_a_year_is_few_nodes(spark):
    year = spark.range(24).select(F.size(joins.dyadic(F.lit(473_352) + 13 * F.col("id"), F.lit(473_352 + 8759) + 13 * F.col("id"), joins.OVERLAP_LEVELS)).alias("n"))
    assert year.agg(F.max("n")).first()[0] <= 40


def test_many_price_versions(spark, many):
    """Price versions of one key with overlaps, gaps, open ends and missing prices, against a plain search."""
    rng = random.Random(4)
    prices = [("k", a, b if i % 9 else None, None if i % 11 == 0 else i) for i, a, b in timed(rng, 150, 300)] + [(None, datetime(2024, 1, 1), None, 1), ("z", datetime(2024, 1, 1), None, 2)]
    records = [(i, rng.choice(["k", "k", "k", "z", None]), a, b) for i, a, b in timed(rng, 300, 5)] + [(999, "k", None, None)]
    fits = lambda r, p: r[1] is not None and r[2] is not None and r[1] == p[0] and r[2] >= p[1] and (p[2] is None or (r[2] < p[2] and r[3] <= p[2]))
    want = sorted(((r[0], p[3]) for r in records for p in ([p for p in prices if fits(r, p)] or [(0, 0, 0, None)])), key=str)
    r = spark.createDataFrame(records, "id int, k string, a timestamp, b timestamp")
    p = spark.createDataFrame(prices, "k string, pf timestamp, pt timestamp, price int")
    got = joins.validity_join(r, p, ["k"], "a", "pf", "pt", "b")
    assert sorted(map(tuple, got.select("id", "price").collect()), key=str) == want
    assert joins.validity_join(r, p, ["k"], "a", "pf", "pt", "b", "inner").count() == sum(1 for x in records for y in prices if fits(x, y))


def test_a_million_versions_of_one_price(spark):
    versions = spark.range(1_000_000).select(F.lit("k").alias("k"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 60).alias("pf"), F.timestamp_seconds(1_700_000_060 + F.col("id") * 60).alias("pt"), F.col("id").alias("price"))
    records = spark.range(20_000).select(F.lit("k").alias("k"), F.timestamp_seconds(1_700_000_007 + F.col("id") * 3000).alias("a"), (F.col("id") * 50).alias("want"))
    got = joins.validity_join(records, versions, ["k"], "a", "pf", "pt")
    assert got.where("price = want").count() == 20_000 == got.count()


def test_null_safe_differences(spark):
    a = spark.createDataFrame([("x", 1), (None, 2), ("z", None)], "k string, v int")
    b = spark.createDataFrame([("x", 1), (None, 3), ("w", None)], "k string, v int")
    assert rows(joins.differences(a, b, ["k"], ["v"]).select("k", "difference")) == [("w", "right only"), ("z", "left only"), (None, "changed")]


def test_differences_count_repeated_keys(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("y", 1), ("z", 1), ("w", 3), ("w", 4)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("x", 1), ("y", 1), ("z", 1), ("z", 1), ("w", 4), ("w", 5)], "k string, v int")
    want = [("w", "changed", 2, 2), ("y", "changed", 2, 1), ("z", "changed", 1, 2)]
    assert rows(joins.differences(a, b, ["k"], ["v"]).select("k", "difference", "left_count", "right_count")) == want
    assert rows(joins.stored_differences(a, b, ["k"], ["v"], 7).select("k", "difference", "left_count", "right_count")) == want
    swapped = spark.createDataFrame([("n", None, 5)], "k string, v int, u int"), spark.createDataFrame([("n", 5, None)], "k string, v int, u int")
    assert joins.differences(*swapped, ["k"], ["v", "u"]).count() == 1


def test_equal_tables_are_compared_without_their_rows(spark, tmp_path):
    spark.range(50_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).write.parquet(f"{tmp_path}/a")
    spark.read.parquet(f"{tmp_path}/a").repartition(3, "v").write.parquet(f"{tmp_path}/b")
    a, b = spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
    assert joins.suspects(a, b, ["k"], ["v"]).count() == 0 and joins.stored_differences(a, b, ["k"], ["v"]).count() == 0
    off = b.withColumn("v", F.when(F.col("k") == 77, None).otherwise(F.col("v")))
    assert joins.suspects(a, off, ["k"], ["v"]).count() == 1
    assert rows(joins.stored_differences(a, off, ["k"], ["v"]).select("k", "left_v", "right_v")) == [(77, 0, None)]
    assert rows(audit.same_copy(a, off).select("difference")) == [("content",)] and audit.same_copy(a, b).isEmpty()


def test_a_file_comes_with_one_run(spark):
    df = spark.createDataFrame([("f", "r1"), ("f", "r1"), ("g", "r1"), ("g", "r2"), ("h", None)], "_source_file string, _ingestion_run_id string")
    assert rows(audit.runs_of_files(df)) == [("g", 2, 2), ("h", 0, 1)]


def test_contract(spark):
    base = {
        "BilledCost": "1.5", "EffectiveCost": "1", "ListCost": "2", "BillingCurrency": "EUR", "BillingPeriodStart": "2025-01-01", "BillingPeriodEnd": "2025-02-01",
        "ChargePeriodStart": "2025-01-02 00:00:00", "ChargePeriodEnd": "2025-01-03 00:00:00", "PricingCategory": "Dynamic", "ProviderName": "Microsoft", "ServiceName": "S",
        "ChargeCategory": "Usage", "ChargeDescription": "text", "extra": "e",
    }
    make = lambda **over: spark.createDataFrame([tuple((base | over).values())], ", ".join(f"{k} string" for k in base))
    good = contract.enforce(contract.conform(make()))
    assert dict(good.dtypes)["BilledCost"] == "decimal(38,18)" and "extra" in good.columns and len(contract.fields()) == 91
    assert good.first()["x_SkuTier"] is None and contract.canonical(good).first()["billing_month"] == "2025-01"
    with pytest.raises(contract.ContractError, match="required columns"):
        contract.conform(make().drop("ServiceName"))
    assert contract.conform(make(ServiceName=None, ChargeCategory="Adjustment")).first()["ServiceName"] == "text"
    for over, rule in (({"ServiceName": None}, "not_null_ServiceName"), ({"BillingCurrency": "USD"}, "expected_BillingCurrency"), ({"PricingCategory": "Spot"}, "allowed_values_PricingCategory"), ({"ChargePeriodEnd": "2024-01-01 00:00:00"}, "ordered_ChargePeriod")):
        with pytest.raises(contract.ContractError, match=rule):
            contract.enforce(contract.conform(make(**over)))
    assert list(contract.rules()) == contract.rule_names()


def test_privacy_gate(spark):
    df = spark.createDataFrame([("user_0a1f@anonymized.example", "ok"), ("jane@corp.example", "Acme Ltd"), (None, "acmeist")], "a string, b string")
    got = audit.privacy_counts(df, r"(?i)\bacme\b", "^user_[0-9a-f]+@").first()
    assert tuple(got) == (1, 1)
    with pytest.raises(audit.ControlError, match="'a': 1"):
        audit.enforce_privacy(df, None, "^user_[0-9a-f]+@")


def test_tables(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    day = lambda f, m, n: spark.createDataFrame([(f, m, i) for i in range(n)], "_source_file string, billing_month string, v int")
    assert t.append_unseen(day("f1", "2025-01", 3), "silver", ("billing_month",)) == 3
    assert t.append_unseen(day("f1", "2025-01", 3).union(day("f2", "2025-02", 2)), "silver", ("billing_month",)) == 2
    assert t.append_unseen(day("f1", "2025-01", 3), "silver", ("billing_month",)) == 0
    t.replace_month(day("m1", "2025-01", 1), "silver", "2025-01")
    assert rows(t.read("silver").groupBy("billing_month").count()) == [("2025-01", 1), ("2025-02", 2)]
    with pytest.raises(TableError, match="no rows"):
        t.replace_month(day("m1", "2025-01", 0), "silver", "2025-01")
    with pytest.raises(TableError, match="outside"):
        t.replace_month(day("m1", "2025-03", 1), "silver", "2025-01")
    with pytest.raises(TableError, match="drift"):
        align(day("a", "b", 1).drop("v"), t.read("silver"))
    old = spark.createDataFrame([("a", 1, date(2025, 1, 5)), ("b", 2, None)], "k string, v int, valid_from date")
    new = spark.createDataFrame([("a", 9, date(2025, 1, 7)), ("c", 3, date(2025, 1, 1))], "k string, v int, valid_from date")
    assert rows(inserted(old, new, ["k"]).select("k", "v")) == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(upserted(old, new, ["k"], ("valid_from",))) == [("a", 9, date(2025, 1, 5)), ("b", 2, None), ("c", 3, date(2025, 1, 1))]
    t.rebuild(old, "dim")
    t.upsert(new, "dim", ["k"])
    t.insert_missing(new, "dim", ["k"])
    assert t.read("dim").count() == 3


def test_reconciliation(spark):
    lines = lambda n, cost: spark.createDataFrame([("2025-01", Decimal(cost), "EUR", f"r{i}") for i in range(n)], "billing_month string, BilledCost decimal(38,6), BillingCurrency string, ResourceId string")
    snap = lambda df: audit.snapshot(df, ["billing_month"])
    ok = audit.reconcile(snap(lines(2, "5")), snap(lines(3, "5")), snap(lines(3, "5")), ["billing_month"]).first()
    bad = audit.reconcile(snap(lines(2, "5")), snap(lines(3, "5")), snap(lines(3, "5.01")), ["billing_month"]).first()
    assert (ok["status"], ok["billing_daily_difference"], bad["status"]) == ("PASSED", 5, "FAILED")


def test_scoping_does_not_multiply_rows(spark):
    now = F.lit("2025-01-01").cast("timestamp")
    charges = spark.createDataFrame([("prod", "A", 1), ("prod", "A", 2), ("prod", "B", 4), ("prod", None, -300), ("dev", "A", 10_000)], "environment string, application_code string, cost int")
    scopes = spark.createDataFrame([("prod", "A", "D1", "S1", True), ("prod", "B", "D1", "S2", True), ("prod", "B", "D9", "S2", True)], "environment string, application_code string, domain_id string, subdomain_id string, is_active boolean")
    grants = spark.createDataFrame(
        [("p", "u", "prod", "APPLICATION_OWNER", "APPLICATION", "A", True), ("p", "u", "prod", "DOMAIN_MANAGER", "DOMAIN", "D1", True), ("p", "a", "prod", "FINOPS_ADMIN", "ALL", "*", True)],
        "identity_provider string, principal_id string, environment string, role string, scope_type string, scope_id string, is_active boolean",
    ).withColumns({"valid_from": F.lit(None).cast("timestamp"), "valid_to": F.lit(None).cast("timestamp")})
    total = lambda who: scoping.scoped(charges, scoping.entitlements_of(grants, "p", who, "prod", now), scopes, "prod").agg(F.sum("cost")).first()[0]
    assert (total("u"), total("a"), total("nobody")) == (3, -293, None)


def test_daily_paths(spark):
    uris = ["daily/2025/01/2025-01-02.parquet", "daily/2025/02/2025-01-03.parquet", "daily/2025/01/2025-13-01.parquet", "other/x.parquet"]
    got = {r["source_uri"]: r["valid"] for r in files.dated(spark.createDataFrame([(u,) for u in uris], "source_uri string")).collect()}
    assert got == dict(zip(uris, [True, False, False]))
    assert [r[0] for r in files.months_between(spark, "2024-11", "2025-02").collect()] == ["2024-11", "2024-12", "2025-01", "2025-02"]
    paths = spark.createDataFrame([("file:///lake//a/b",), ("/lake/../c",), ("/other/a",)], "p string").select(files.normalized_uri("p").alias("p"))
    assert [tuple(r) for r in paths.select("p", files.confined("p", "/lake")).collect()] == [("/lake/a/b", True), ("/lake/../c", False), ("/other/a", False)]


def test_exact_decimals(spark):
    df = spark.createDataFrame([("0.123456789012345678",), ("0.1234567890123456789",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(X.fits_exactly("v")).collect()] == [True, False, False, None]
