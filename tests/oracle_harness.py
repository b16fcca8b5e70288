"""Run a named Spark plan and its DuckDB twin on the same tables and compare.

Comparison: same column names, same row count, and the same multiset of
rows after normalising values (dates to ISO strings, NaN to None).  Doubles
must be equal exactly; plans round their outputs for that reason.

CLI: ``python -m tests.oracle_harness [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelcast.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(sf_dir, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = False) -> tuple[bool, str]:
    from panelcast.plans.catalog import REGISTRY
    from panelcast.plans.oracle import ORACLE

    t0 = time.time()
    sdf = REGISTRY[name](spark, sf_dir)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    if name not in ORACLE:
        return True, f"{name}: rows-only {len(srows)} rows (spark {t1 - t0:.1f}s)"
    con = con or duck(sf_dir)
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    drows_raw = rel.fetchall()
    if sorted(dcols) != cols:
        return False, f"{name}: columns differ spark={cols} duck={sorted(dcols)}"
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in drows_raw]
    if len(srows) != len(drows):
        return False, f"{name}: row count spark={len(srows)} duck={len(drows)}"
    a, b = sorted(srows, key=_key), sorted(drows, key=_key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        msg = f"{name}: {len(bad)} of {len(a)} rows differ; first: spark={bad[0][0]} duck={bad[0][1]}"
        return False, msg
    return True, f"{name}: OK {len(a)} rows (spark {t1 - t0:.1f}s)"


def main(argv: list[str]) -> int:
    from panelcast.plans.catalog import REGISTRY
    from panelcast.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark = build_session("local[8]", "oracle-check", shuffle_partitions=8)
    con = duck(sf_dir)
    failed = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue with the next plan
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        failed += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
