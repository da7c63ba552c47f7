"""Run registered Spark queries against their DuckDB twins (the driver's gate).

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if hasattr(v, "asDict"):
        v = v.asDict(recursive=True)
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 if not isinstance(x, tuple) else (False, "tuple", repr(x)) for x in row)


def close(a, b, tol=1e-9):
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None or isinstance(a, str) or isinstance(b, str):
            return a == b
        return math.isclose(a, b, rel_tol=tol, abs_tol=tol)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y, tol) for x, y in zip(a, b))
    return a == b


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(norm(r[c]) for c in sorted(scols)) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows), "sec": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        out["status"] = f"COLUMNS spark={sorted(scols)} duck={sorted(dcols)}"
        return out
    if len(srows) != len(drows):
        out["status"] = "ROWCOUNT"
        return out
    srows.sort(key=key)
    drows.sort(key=key)
    if srows == drows:
        out["status"] = "EXACT"
    elif all(close(a, b) for a, b in zip(srows, drows)):
        out["status"] = "CLOSE"
        bad = [(a, b) for a, b in zip(srows, drows) if a != b][:2]
        out["example"] = bad
    else:
        bad = [(a, b) for a, b in zip(srows, drows) if not close(a, b)][:3]
        out["status"] = "MISMATCH"
        out["example"] = bad
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from churnwise.session import get_spark
    from churnwise.plans.registry import load_all
    spark = get_spark()
    spark.sparkContext.setLogLevel("ERROR")
    reg = load_all()
    con = duck(sf_dir)
    bad = 0
    for name, e in reg.items():
        if names and name not in names:
            continue
        if e.sql is None:
            n = e.fn(spark, sf_dir).count()
            print(f"{name:40s} ROWS-ONLY rows={n}", flush=True)
            continue
        try:
            r = compare(spark, sf_dir, name, e.fn, e.sql, con)
        except Exception as ex:  # report and go on
            r = {"name": name, "status": f"ERROR {type(ex).__name__}: {str(ex)[:400]}"}
        ok = r["status"] == "EXACT"
        bad += not ok
        print(f"{name:40s} {r['status']} rows={r.get('spark_rows')}/{r.get('oracle_rows')} {r.get('sec')}s"
              + ("" if ok else f" {r.get('example', '')}")[:1500], flush=True)
    print("NOT EXACT:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
