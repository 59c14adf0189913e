"""Compare registered Spark queries with their oracle SQL on DuckDB.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, spark rows, oracle rows, MATCH/DIFF.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for _, r in df.iterrows()]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if not isinstance(x, tuple) else str(x))
                                           for x in t))


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = True):
    from cellspark.plans.registry import QUERIES
    from cellspark.plans.oracle_sql import ORACLE
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir).toPandas()
    t1 = time.time()
    if name not in ORACLE:
        if verbose:
            print(f"{name:32s} spark={len(sdf):7d} oracle=   none  ({t1 - t0:.1f}s)")
        return None
    odf = con.execute(ORACLE[name]).df()
    ok_cols = sorted(sdf.columns) == sorted(odf.columns)
    a, b = (rows(sdf), rows(odf)) if ok_cols else ([], [1])
    ok = ok_cols and a == b
    if verbose:
        print(f"{name:32s} spark={len(sdf):7d} oracle={len(odf):7d} {'MATCH' if ok else 'DIFF'} ({t1 - t0:.1f}s)")
        if not ok:
            if not ok_cols:
                print("   columns", sorted(sdf.columns), sorted(odf.columns))
            else:
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only oracle:", list(sb - sa)[:3])
    return ok


if __name__ == "__main__":
    from cellspark.session import spark_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = spark_session("local[8]")
    from cellspark.plans.registry import QUERIES
    con = duck(sf)
    bad = []
    for n in names or list(QUERIES):
        try:
            if compare(spark, n, sf, con) is False:
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"{n:32s} ERROR {type(e).__name__}: {str(e)[:300]}")
            bad.append(n)
    print("FAILED:", bad)
