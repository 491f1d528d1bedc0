"""Queries against their SQL twins on the smallest tables: star schema, marts, controls, finance, scoping and some of the others.

tests/compare.py runs all of them.
"""

import __spark_entry__ as entry
import pytest
from compare import difference, duck

from costlake.queries import QUERIES, TWINS

SF = "/root/testdata/sf0.001"
# loads of whole lakes; the scoped reports share the scoping, so some of them are enough here
SLOW = "dq6 dq8 dq10 fin17".split()
GROUPS = ("gld", "dm", "dq", "sec", "fin")
MORE = (
    "prj10 prj18 flt4 jn1 jn4 jn5 jn9 jn17 agg10 agg15 win1 win4 src1 src9 src14 snk1 snk3 snk4 snk8 qry4 qry16 qry24 qry24_refused qry25 qry28 qry30 "
    "qry4_scoped qry9_scoped qry16_scoped qry3_scoped qry20_refused qry23_scoped"
).split()
SOME = [n for n in TWINS if n not in SLOW and (n in MORE or n.rstrip("0123456789b").removesuffix("_month").removesuffix("_year").rstrip("0123456789") in GROUPS)]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", SOME)
def test_twin(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, TWINS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
