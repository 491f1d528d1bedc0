"""What the driver must hold: points of a SimHash cell are joined without it."""

from costlake.llm import simhash


def test_cells_are_not_broadcast(spark, monkeypatch):
    """A point becomes 70 rows, which Spark takes to be as few as the points, however many these are."""
    plans, found = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda links: (plans.append(links._jdf.queryExecution().toString().split("== Physical Plan ==")[1]), found(links))[1])
    points = spark.createDataFrame([(0,), (1,), (7,), (2**40,)], "fp long")
    assert {r["fp"]: r["label"] for r in simhash.link_components(points).collect()} == {0: 0, 1: 0, 7: 0, 2**40: 0}
    assert any("SortMergeJoin [cell" in p for p in plans) and not any("BroadcastHashJoin [cell" in p for p in plans)
