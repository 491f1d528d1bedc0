"""Run queries and their SQL twins side by side: python tests/compare.py SF_DIR [NAME...]."""

import math
import os
import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, f"{v:.4f}" if isinstance(v, float) else str(v)) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return type(a) is type(b) and a == b


def difference(df, con, sql):
    """None if both give the same columns and rows, else what differs."""
    columns = sorted(df.columns)
    mine = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_key)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != columns:
        return f"columns {columns} and {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=_key)
    if len(mine) != len(theirs):
        return f"{len(mine)} and {len(theirs)} rows"
    for a, b in zip(mine, theirs):
        if not all(map(_same, a, b)):
            return f"{dict(zip(columns, a))} and {dict(zip(columns, b))}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('CPUS', '4')}]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, twins = duck(sys.argv[1]), entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or twins:
        began = time.time()
        try:
            said = difference(queries[name](spark, sys.argv[1]), con, twins[name]) if name in twins else f"{queries[name](spark, sys.argv[1]).count()} rows, no twin"
        except Exception as e:
            said = f"{type(e).__name__} {str(e)[:700]}"
        print(f"{name:8} {time.time() - began:5.1f}  {said or 'same'}", flush=True)
