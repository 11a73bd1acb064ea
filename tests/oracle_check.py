"""Run registered queries against their DuckDB twins (the driver's check, locally).

    python tests/oracle_check.py [sf_dir] [key ...]

Compares column names, row count and the order-insensitive multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
    except ImportError:
        pass
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    scols = list(sdf.columns)
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(_norm(x) for x in r) for r in res.fetchall()]
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duck={dcols}", t1 - t0
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    if len(srows) != len(drows):
        return False, f"rows differ: spark={len(srows)} duck={len(drows)}", t1 - t0
    key_fn = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    s_sorted, d_sorted = sorted(srows, key=key_fn), sorted(drows, key=key_fn)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"value differ:\n  spark={a}\n  duck ={b}", t1 - t0
    return True, f"{len(srows)} rows", t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    from __spark_entry__ import oracle_sql, queries
    from newsflow.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for k in keys or list(q):
        if k not in o:
            t0 = time.time()
            n = q[k](spark, sf_dir).count()
            print(f"ROWS  {k}: {n} rows ({time.time() - t0:.1f}s)")
            continue
        try:
            ok, msg, secs = compare(spark, con, k, q[k], o[k], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, msg, secs = False, f"error: {type(e).__name__}: {str(e)[:600]}", 0.0
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {k}: {msg} ({secs:.1f}s)", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
