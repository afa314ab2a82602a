"""Compare a Spark query result with its DuckDB oracle (driver-style check).

Row count, column names (sorted) and an order-insensitive hash of the
values.  Used by the tests and runnable as a script for a quick report.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return repr([_norm(x) for x in v])
    return repr(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    sh, sl = digest(scols, srows)
    dh, dl = digest(dcols, drows)
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
    detail = ""
    if not ok:
        if sorted(scols) != sorted(dcols):
            detail = f"cols spark={sorted(scols)} duck={sorted(dcols)}"
        elif len(srows) != len(drows):
            detail = f"rows spark={len(srows)} duck={len(drows)}"
        else:
            a, b = set(sl), set(dl)
            detail = f"value diff: spark-only={sorted(a - b)[:3]} duck-only={sorted(b - a)[:3]}"
    return ok, len(srows), detail


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from barlake.session import build_session
    import __spark_entry__ as E

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    spark = build_session()
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k in qs:
        if only and k not in only:
            continue
        if k not in orc:
            n = qs[k](spark, sf).count()
            print(f"\nROWS  {k}: {n} rows (no oracle)")
            continue
        try:
            ok, n, det = compare(spark, k, qs[k], orc[k], sf)
        except Exception as e:  # noqa: BLE001
            ok, n, det = False, -1, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"\n{'OK   ' if ok else 'FAIL '} {k}: {n} rows {det}", flush=True)
    print(f"failures: {bad}")
