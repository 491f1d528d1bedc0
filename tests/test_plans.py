"""Plans of the cost queries: pruned scans, pushed filters, no Python."""

from pyspark.sql import functions as F

from costlake.operators.tables import Tables
from costlake.plans import marts, serving
from costlake.queries import QUERIES
from costlake.sources.charges import charges

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["dm1"](spark, SF))
    scan = next(x for x in text.splitlines() if "lineitem.parquet" in x and "ReadSchema" in x)
    assert "l_quantity" not in scan and "l_extendedprice" in scan


def test_month_filter_prunes_partitions(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    t.append_unseen(charges(spark, SF), "silver", ("billing_month",))
    text = plan(serving.in_month(t.read("silver"), "1998-03").agg(F.sum("BilledCost")))
    assert "PartitionFilters: [isnotnull(billing_month" in text
    assert "PartitionFilters: [isnotnull(billing_month" in plan(serving.in_year(t.read("silver"), 1998).agg(F.sum("BilledCost")))


def test_no_python_and_no_unkeyed_joins(spark):
    for name in ("dm5", "dm14", "gld3", "gld12", "qry4", "fin6", "fin9", "dq11"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "CartesianProduct" not in text, name
    assert marts.MARTS


def test_marts_sum_before_they_join(spark):
    """Lines are aggregated by key, by hash, before a dimension meets them."""
    for name in ("dm4", "dm5", "dm6", "dm7", "dm10", "dm12", "dm13", "dm14"):
        text = plan(QUERIES[name](spark, SF)).split("== Physical Plan ==")[1]
        facts = [x for x in text.splitlines() if "partial_sum(billed_cost" in x]
        assert facts and all("HashAggregate" in x for x in facts), name
    newest = plan(QUERIES["gld3"](spark, SF)).split("== Physical Plan ==")[1]
    assert newest.count("SortAggregate") <= 2 and "HashAggregate(keys=[resource_sk" in newest


def test_few_prices_are_broadcast_and_many_are_dealt_by_time(spark, monkeypatch):
    from costlake.operators import joins

    for name in ("jn4", "agg15", "fin5", "fin9"):
        assert "SortMergeJoin" not in plan(QUERIES[name](spark, SF)), name
    want = sorted(map(tuple, QUERIES["fin9"](spark, SF).collect()), key=str)
    overlaps = sorted(map(tuple, QUERIES["fin6"](spark, SF).collect()), key=str)
    monkeypatch.setattr(joins, "FEW", 0)
    frame = QUERIES["fin9"](spark, SF)
    assert "_p_node" in plan(frame) and sorted(map(tuple, frame.collect()), key=str) == want
    assert sorted(map(tuple, QUERIES["fin6"](spark, SF).collect()), key=str) == overlaps


def test_marts_move_parts_of_keys_instead_of_hashes(spark):
    """Sums and joins are by the parts of surrogate keys; versions of a resource are not told apart by what the mart does not show."""
    for name in ("dm5", "dm10", "dm12", "dm13", "dm14", "qry15", "qry18"):
        assert "sha2(" not in plan(QUERIES[name](spark, SF)).split("== Physical Plan ==")[1], name
    for name in ("dm5", "dm10", "dm12", "dm13", "qry15", "qry18"):
        assert "application-code" not in plan(QUERIES[name](spark, SF)).split("== Physical Plan ==")[1], name


def test_lines_meet_orders_once(spark):
    """Customers are joined to orders, so that lines are dealt by the order and not by the customer too."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(charges(spark, SF).select("x_CostCenter", "BilledCost")).split("== Physical Plan ==")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(l_orderkey" in text and text.count("hashpartitioning(o_custkey") == 1
    dealt = next(x for x in text.splitlines() if "hashpartitioning(o_custkey" in x)
    below = text.splitlines()[text.splitlines().index(dealt) + 1 :]
    assert "orders.parquet" in next(x for x in below if "FileScan" in x)


def test_lines_are_dealt_before_they_get_keys(spark):
    """What is written by month is brought together as lines and as parts of keys; hashes are made where the rows are written."""
    from costlake.plans import gold
    from costlake.queries.registry import lines

    some = lines(spark, SF)
    for frame in (gold.fact_cost_usage(some, by=("billing_month",)), marts.state_resource(some)):
        above, below = plan(frame).split("== Physical Plan ==")[1].split("REBALANCE", 1)
        assert "sha2(" in above and "sha2(" not in below


def test_stored_tables_hold_hashes_in_half_their_length(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    t.append(spark.range(20000).selectExpr("sha2(cast(id as string), 256) as k"), "keys")
    import os

    assert sum(os.path.getsize(f.removeprefix("file:")) for f in t.files("keys")) < 0.7 * 64 * 20000
