"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

usage: python tools/oracle_check.py [sf_dir] [name ...]
Prints one line per query: status, rows, seconds.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cribble.plans.registry import load_all  # noqa: E402
from cribble.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return float(v)
    if hasattr(v, "item") and not hasattr(v, "tolist"):
        v = v.item()
    if hasattr(v, "dtype") and getattr(v, "ndim", 1) == 0:
        v = v.item()
    if isinstance(v, (int,)) and not isinstance(v, bool):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(pdf, cols):
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(norm(x) for x in rec))
    return sorted(out, key=repr)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    reg = load_all()
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf)
            spdf = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERR {name}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if not q.sql:
            print(f"ROWS-ONLY {name}: rows={len(spdf)} {ts:.1f}s")
            continue
        try:
            dpdf = con.execute(q.sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"SQL-ERR {name}: {str(e)[:400]}")
            bad += 1
            continue
        sc, dc = sorted(spdf.columns), sorted(dpdf.columns)
        if sc != dc:
            print(f"COLS {name}: spark={sc} duck={dc}")
            bad += 1
            continue
        if len(spdf) != len(dpdf):
            print(f"ROWCOUNT {name}: spark={len(spdf)} duck={len(dpdf)}")
            bad += 1
            continue
        a, b = rows_of(spdf, sc), rows_of(dpdf, sc)
        if a != b:
            diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"VALUES {name}: {diffs}")
            bad += 1
            continue
        print(f"OK {name}: rows={len(spdf)} {ts:.1f}s")
    print(f"bad={bad}")


if __name__ == "__main__":
    main()
