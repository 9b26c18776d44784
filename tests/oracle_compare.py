"""Local stand-in for the driver's correctness check.

Runs a Spark query and its DuckDB oracle on the same Parquet folder and
compares row count, column names and an order-insensitive value digest.
Usable from pytest and from the command line:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    if isinstance(v, (list, tuple)):
        return repr(list(v))
    return v


def digest(pdf: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(repr(tuple(_norm(v) for v in rec)))
    rows.sort()
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def first_diff(a: pd.DataFrame, b: pd.DataFrame, limit=5):
    cols = sorted(set(a.columns) & set(b.columns))
    ra = sorted(repr(tuple(_norm(v) for v in r)) for r in a[cols].itertuples(index=False, name=None))
    rb = sorted(repr(tuple(_norm(v) for v in r)) for r in b[cols].itertuples(index=False, name=None))
    sa, sb = set(ra), set(rb)
    return cols, [r for r in ra if r not in sb][:limit], [r for r in rb if r not in sa][:limit]


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    ts = time.time() - t0
    if sql is None:
        if verbose:
            print(f"{name:40s} rows-only rows={len(spdf)} spark={ts:.1f}s")
        return True
    con = con or duck(sf_dir)
    dpdf = con.execute(sql).df()
    a, b = digest(spdf), digest(dpdf)
    ok = a == b
    if verbose:
        status = "OK " if ok else "BAD"
        print(f"{status} {name:40s} rows={a[0]}/{b[0]} spark={ts:.1f}s")
        if not ok:
            if a[1] != b[1]:
                print("   cols spark:", a[1])
                print("   cols duck :", b[1])
            else:
                cols, da, db = first_diff(spdf, dpdf)
                print("   cols:", cols)
                print("   spark-only:", da)
                print("   duck-only :", db)
    return ok


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from shipcast.session import get_spark
    spark = get_spark("local[8]", 8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name, fn in qs.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        if os.environ.get("SQL_ONLY") and name not in sqls:
            continue
        try:
            if not compare(spark, sf_dir, name, fn, sqls.get(name), con):
                bad.append(name)
        except Exception as e:  # noqa: BLE001
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}")
            bad.append(name)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
