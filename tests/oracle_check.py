"""Run queries in Spark and their oracle in DuckDB and compare the rows.

python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, int):
        return (2, v)
    if isinstance(v, float):
        return (3, v)
    return (4, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql) -> str:
    """Empty when equal, else what differs."""
    mine = rows_of(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        only = sorted(set(mine) - set(theirs))[:2], sorted(set(theirs) - set(mine))[:2]
        return f"{len(bad)} of {len(mine)} rows differ: spark {only[0]} oracle {only[1]}"
    return "" if mine else "both empty"


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picked = sys.argv[2:]
    spark = get_session(cpus=8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(sf), 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without oracle:", sorted(set(queries) - set(oracle)), "unknown:", sorted(set(oracle) - set(queries)))
    for name, query in queries.items():
        if picked and name not in picked:
            continue
        started = time.perf_counter()
        try:
            df = query(spark, sf)
            diff = compare(df, con, oracle[name]) if name in oracle else f"no oracle, {df.count()} rows"
        except Exception as exc:
            diff = f"{type(exc).__name__}: {str(exc)[:300]}"
        failed += bool(diff)
        print(f"{'ok  ' if not diff else 'FAIL'} {time.perf_counter() - started:6.2f}s {name} {diff}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main() != 0)
