"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

The comparison mirrors the driver's gate: same column names, same row count,
and the same multiset of rows (columns sorted by name). Exact equality is
reported; a float-tolerant comparison is reported next to it for diagnosis.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallgrass.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, tol: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) if tol else v
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, tol)) for k, x in v.items()))
    return v


def canon(cols, rows, tol):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], tol) for i in order) for r in rows]
    return sorted(out, key=lambda r: repr(r))


def compare(spark, sf_dir, keys=None, verbose=True):
    from tallgrass.plans.registry import load_all
    reg = load_all()
    con = duck(sf_dir)
    results = {}
    for name in keys or sorted(reg):
        q = reg[name]
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", repr(e)[:400])
            if verbose:
                print(f"{name:28s} SPARK-ERROR {repr(e)[:400]}", flush=True)
            continue
        ts = time.time() - t0
        if q.oracle is None:
            results[name] = ("NO-ORACLE", len(srows))
            if verbose:
                print(f"{name:28s} no-oracle rows={len(srows)} {ts:.1f}s", flush=True)
            continue
        try:
            cur = con.execute(q.oracle)
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", repr(e)[:400])
            if verbose:
                print(f"{name:28s} SQL-ERROR {repr(e)[:400]}", flush=True)
            continue
        same_cols = sorted(scols) == sorted(dcols)
        exact = same_cols and canon(scols, srows, False) == canon(dcols, drows, False)
        loose = same_cols and canon(scols, srows, True) == canon(dcols, drows, True)
        status = "OK" if exact else ("LOOSE" if loose else "MISMATCH")
        results[name] = (status, len(srows), len(drows))
        if verbose:
            print(f"{name:28s} {status:8s} spark={len(srows)} duck={len(drows)} {ts:.1f}s"
                  + ("" if same_cols else f" cols {sorted(scols)} vs {sorted(dcols)}"), flush=True)
            if status == "MISMATCH" and same_cols:
                a = canon(scols, srows, True)
                b = canon(dcols, drows, True)
                sa, sb = set(a), set(b)
                print("   spark-only:", sorted(sa - sb, key=repr)[:3])
                print("   duck-only: ", sorted(sb - sa, key=repr)[:3])
    return results


if __name__ == "__main__":
    from tallgrass.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    ks = sys.argv[2:] or None
    spark = get_session("local[8]", 8)
    res = compare(spark, sf, ks)
    bad = {k: v for k, v in res.items() if v[0] not in ("OK", "NO-ORACLE")}
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {sorted(bad)}")
