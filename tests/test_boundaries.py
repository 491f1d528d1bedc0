"""Queries against their twins on rows that lie beside a limit."""

import duckdb
from compare import difference

from costlake.queries import QUERIES, TWINS


def test_freshness_to_the_microsecond(spark, tmp_path):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    times = ["2024-01-12 23:59:59.999999", "2024-01-13 00:00:00", "2024-01-15 00:05:00", "2024-01-15 00:05:00.000001", "2024-01-15 00:05:00.7"]
    values = ", ".join(f"({i}, TIMESTAMP '{t}')" for i, t in enumerate(times))
    con.execute(f"COPY (SELECT * FROM (VALUES {values}, (9, NULL)) AS v(event_id, ts)) TO '{tmp_path}/events.parquet'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    assert difference(QUERIES["dq31"](spark, str(tmp_path)), con, TWINS["dq31"]) is None
    assert QUERIES["dq31"](spark, str(tmp_path)).first().asDict() == {"fresh": 2, "events": 6}
