"""Run registered queries in Spark and their oracle SQL in DuckDB and compare
(row count, column names, order-insensitive values).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

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
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat())
    return (1, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), [columns[i] for i in order]


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if name not in sqls:
            results[name] = ("no-oracle", len(srows))
            if verbose:
                print(f"{name:45s} rows={len(srows):7d} spark={t1 - t0:6.2f}s  (no oracle)")
            continue
        cur = con.execute(sqls[name])
        dcols = [d[0] for d in cur.description]
        drows = cur.fetchall()
        a, ac = rows_of(scols, srows)
        b, bc = rows_of(dcols, drows)
        ok = (ac == bc) and a == b
        results[name] = ok
        if verbose:
            print(f"{name:45s} rows={len(srows):7d}/{len(drows):7d} spark={t1 - t0:6.2f}s "
                  f"{'OK' if ok else 'MISMATCH'}")
            if not ok:
                if ac != bc:
                    print("   columns:", ac, bc)
                else:
                    da = [r for r in a if r not in set(b)][:3]
                    db = [r for r in b if r not in set(a)][:3]
                    print("   spark-only:", da)
                    print("   duck-only :", db)
    return results


if __name__ == "__main__":
    from martflow.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v is False]
    print("mismatches:", bad)
    sys.exit(1 if bad else 0)
