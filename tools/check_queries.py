"""Run registered queries beside their SQL and compare rows, types and values.

    python tools/check_queries.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from riskloom.catalog import ORACLES, QUERIES  # noqa: E402
from riskloom.session import build_session  # noqa: E402
from riskloom.sources.bronze import TABLES  # noqa: E402

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, Decimal):
        return str(v)
    return str(v)


def duck_type(t: str) -> str:
    return t.upper() if t.startswith("decimal") else TYPES.get(t, t)


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def compare(spark, con, name: str, sf: str) -> tuple[bool, str]:
    t0 = time.time()
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = [tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    t1 = time.time()
    if name not in ORACLES:
        return False, f"{len(got)} rows, but no SQL to hold them against"
    cur = con.execute(ORACLES[name])
    names, kinds = [d[0] for d in cur.description], [str(d[1]) for d in cur.description]
    at = [names.index(c) for c in cols] if sorted(names) == cols else None
    if at is None:
        return False, f"columns {cols} != {sorted(names)}"
    want = [tuple(plain(r[i]) for i in at) for r in cur.fetchall()]
    types = {f.name: duck_type(f.dataType.simpleString()) for f in df.schema.fields}
    off = [(c, types[c], kinds[names.index(c)]) for c in cols
           if types[c].replace(" ", "") != kinds[names.index(c)].replace(" ", "")]
    note = f" types {off}" if off else ""
    if sorted(got) == sorted(want):
        return not off, f"{len(got)} rows{note} {t1 - t0:.1f}s / {time.time() - t1:.1f}s"
    a, b = sorted(set(got) - set(want))[:2], sorted(set(want) - set(got))[:2]
    return False, f"{len(got)} vs {len(want)} rows{note}\n   spark {cols}\n   spark {a}\n   sql   {b}"


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session("check", "local[8]", 8, {"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    names = [n for n in QUERIES if not args.names or any(n.startswith(a) for a in args.names)]
    failed = []
    for n in names:
        try:
            ok, text = compare(spark, con, n, args.sf)
        except Exception as e:  # report and go on
            ok, text = False, f"{type(e).__name__}: {str(e)[:600]}"
        print("ok  " if ok else "FAIL", n, text, flush=True)
        if not ok:
            failed.append(n)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
