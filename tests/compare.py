"""Runs registered queries against DuckDB and reports differences.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, Decimal)):
        f = float(v)
        return int(f) if f.is_integer() else f
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))


def compare(name, spark_df, con, sql) -> str:
    """'ok' or what differs."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {sorted(set(got_cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    left, right = set(got), set(want)
    if got != want:
        a, b = sorted(left - right, key=str)[:1], sorted(right - left, key=str)[:1]
        detail = ""
        if a and b:
            near = min(right - left, key=lambda r: sum(x != y for x, y in zip(r, a[0])))
            detail = str([(c, x, y) for c, x, y in zip(got_cols, a[0], near) if x != y][:6])
        return f"{len(left - right)} rows differ, e.g. {detail}"
    return "ok" if got else "ok (empty)"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from accountwise.session import local_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, con = local_session(), duck(sf_dir)
    sqls, bad = oracle_sql(), 0
    for name, run in queries().items():
        if args.names and not any(name.startswith(n) for n in args.names):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            verdict = compare(name, df, con, sqls[name]) if name in sqls else f"rows only: {len(df.collect())}"
        except Exception as e:  # report and go on; a fatal DuckDB error spoils its connection
            con = duck(sf_dir)
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        flag = "" if verdict.startswith(("ok", "rows only")) else "  <<<"
        bad += bool(flag)
        print(f"{name:40s} {time.time() - start:6.2f}s  {verdict}{flag}", flush=True)
    print(f"{bad} problems")
    spark.stop()
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
