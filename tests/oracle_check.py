"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

    python tests/oracle_check.py [sf_dir] [name ...]

Compares column names, row count and the sorted rows (exact values). A few
queries run side by side, as small jobs leave most cores idle.
"""

from __future__ import annotations

import math
import os
import sys
import time
from concurrent.futures import ThreadPoolExecutor

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None  # pandas turns a null in a Spark int column into NaN
    if hasattr(v, "item"):
        v = v.item()
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(norm(v) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, sf_dir, names=None, threads=4):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = []

    def ran(name):
        t = time.time()
        try:
            return qs[name](spark, sf_dir).toPandas(), time.time() - t
        except Exception as e:  # noqa: BLE001
            return e, 0.0
    names = list(names or qs)
    pool = ThreadPoolExecutor(threads)
    for name, (sdf, ts) in zip(names, pool.map(ran, names)):
        if isinstance(sdf, Exception):
            print(f"{name:28s} SPARK ERROR {sdf!r}"[:400])
            bad.append(name)
            continue
        if name not in sql:
            print(f"{name:28s} rows={len(sdf)} (no oracle) {ts:.1f}s")
            continue
        try:
            ddf = con.execute(sql[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCKDB ERROR {e!r}"[:400])
            bad.append(name)
            continue
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        ok = sc == dc and len(sr) == len(dr) and sr == dr
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={len(sr)}/{len(dr)} {ts:.1f}s")
        if not ok:
            bad.append(name)
            if sc != dc:
                print("   columns", sc, dc)
            else:
                diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
                for a, b in diff:
                    print("   spark ", a)
                    print("   duckdb", b)
    return bad


if __name__ == "__main__":
    from gapscan.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(shuffle_partitions=8)
    bad = compare(spark, sf, names)
    print("FAILED:", bad)
