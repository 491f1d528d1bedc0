"""Plans: native operators run no Python on executors, no operator joins without a key."""

import pytest

from costlake.llm import queries

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["op1_secret_scan", "op4_pii", "op7_sharding"])
def test_native(spark, name):
    text = plan(queries.queries()[name](spark, SF))
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "ExternalRDD"))


@pytest.mark.parametrize("name", ["op3_packing", "op5_chunk_fingerprint", "op6_simhash", "op7_sharding"])
def test_joins_have_keys(spark, name):
    text = plan(queries.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(queries.queries()["op4_pii"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
