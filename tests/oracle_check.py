"""Run registered Spark queries and their reference SQL side by side.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the multiset of rows (floats rounded
to 9 significant digits) between Spark and DuckDB.
"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


STRICT = os.environ.get("STRICT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return v


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("spark-error", repr(e)[:800])
            if verbose:
                print(f"{name:28s} SPARK ERROR {repr(e)[:800]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:28s} rows-only {len(srows)} ({ts:.1f}s)")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            drows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
        except Exception as e:  # noqa: BLE001
            results[name] = ("sql-error", repr(e)[:800])
            if verbose:
                print(f"{name:28s} SQL ERROR {repr(e)[:800]}")
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        status = "ok"
        if not ok_cols:
            status = f"cols differ: spark-only={sorted(set(scols)-set(dcols))} sql-only={sorted(set(dcols)-set(scols))}"
        else:
            order = sorted(range(len(dcols)), key=lambda i: dcols[i])
            sorder = [scols.index(dcols[i]) for i in order]
            s = collections.Counter(tuple(r[i] for i in sorder) for r in srows)
            dd = collections.Counter(tuple(r[i] for i in order) for r in drows)
            if len(srows) != len(drows):
                status = f"rowcount spark={len(srows)} sql={len(drows)}"
            elif s != dd:
                diff_s = list((s - dd).items())[:3]
                diff_d = list((dd - s).items())[:3]
                status = f"values differ: spark-only={diff_s} sql-only={diff_d}"
        results[name] = (status, len(srows))
        if verbose:
            print(f"{name:28s} {status[:1500]} rows={len(srows)} ({ts:.1f}s)")
    return results


if __name__ == "__main__":
    from strataflow.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("ok", "rows-only")]
    print("FAILED:", bad)
