"""Compare each registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Row count, sorted column names and an order-insensitive value comparison
(floats rounded to 6 places)."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime

    import numpy as np

    if v is None:
        return None
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6) + 0.0
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows_of(records, cols):
    out = []
    for r in records:
        out.append(tuple(_norm(r[c]) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, key, fn, sql, sf_dir):
    t = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    st = time.time() - t
    scols = sorted(sdf.columns)
    if sql is None:
        return dict(key=key, ok=None, rows=len(srows), spark_sec=round(st, 2))
    t = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drecs = [dict(zip(dcols, r)) for r in res.fetchall()]
    dt = time.time() - t
    info = dict(key=key, rows=len(srows), duck_rows=len(drecs), spark_sec=round(st, 2), duck_sec=round(dt, 2))
    if sorted(dcols) != scols:
        info.update(ok=False, why=f"columns {scols} vs {sorted(dcols)}")
        return info
    a, b = rows_of(srows, scols), rows_of(drecs, scols)
    if len(a) != len(b):
        info.update(ok=False, why="row count")
        return info
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    info.update(ok=not bad)
    if bad:
        info["why"] = f"{len(bad)} rows differ; first: {bad[0]}"
    return info


def main():
    import __spark_entry__ as E
    from weekpanel.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    n_ok = n_bad = 0
    for k, fn in qs.items():
        if keys and k not in keys:
            continue
        try:
            info = compare(spark, con, k, fn, sq.get(k), sf_dir)
        except Exception as e:  # report and continue
            info = dict(key=k, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        n_ok += info.get("ok") is True
        n_bad += info.get("ok") is False
        print(info, flush=True)
    print(f"OK {n_ok}  BAD {n_bad}")


if __name__ == "__main__":
    main()
