"""Run queries beside their SQL and compare rows.

usage: python tools/oracle_check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from cadastra.queries import ORACLE, QUERIES
from cadastra.session import build_session


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) and abs(value) < 2**53 else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def connect(folder: str):
    con = duckdb.connect()
    for f in sorted(os.listdir(folder)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{folder}/{f}'")
    return con


def compare(spark, con, name: str, folder: str) -> str:
    began = time.time()
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    took = time.time() - began
    if name not in ORACLE:
        return f"ROWS  {name}: {len(got)} rows, no SQL ({took:.1f}s)"
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"FAIL  {name}: columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return f"ok    {name}: {len(got)} rows ({took:.1f}s)" + ("  EMPTY" if not got else "")
    missing, extra = set(want) - set(got), set(got) - set(want)
    return (
        f"FAIL  {name}: {len(got)} rows, expected {len(want)}; columns {sorted(names)}\n"
        f"   only SQL   {sorted(missing, key=repr)[:3]}\n   only Spark {sorted(extra, key=repr)[:3]}"
    )


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(cores="8")
    con = connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        try:
            line = compare(spark, con, name, args.sf)
        except Exception as e:  # report and go on with the next query
            line = f"ERROR {name}: {str(e)[:1500]}"
        failed += not line.startswith(("ok", "ROWS"))
        print(line, flush=True)
    print("failed:", failed)
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
