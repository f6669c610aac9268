"""Run registered queries against their SQL and compare whole results.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stagetrace.oracle import ORACLE  # noqa: E402
from stagetrace.queries import QUERIES  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(r[i] for i in order) for r in data), key=repr)


def compare(spark, con, name: str, folder: str) -> tuple[bool, str]:
    t = time.time()
    df = QUERIES[name](spark, folder)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - t
    t = time.time()
    rel = con.execute(ORACLE[name])
    want = rows([c[0] for c in rel.description], rel.fetchall())
    note = f"{len(got[1])} rows, {spent:.1f} s, sql {time.time() - t:.1f} s"
    if got[0] != want[0]:
        return False, f"columns {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return False, f"rows {len(got[1])} / {len(want[1])}"
    for g, w in zip(*(x[1] for x in (got, want))):
        if g != w or list(map(type, g)) != list(map(type, w)):
            return False, f"\n  spark {g}\n  sql   {w}"
    return True, note


if __name__ == "__main__":
    from stagetrace.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session("local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for query in sys.argv[2:] or QUERIES:
        if query not in ORACLE:
            continue
        try:
            ok, text = compare(session, db, query, folder)
        except Exception as e:  # noqa: BLE001
            ok, text = False, f"{type(e).__name__}: {str(e)[:1500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", query, text, flush=True)
    print("failed:", bad)
