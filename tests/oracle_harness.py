"""Local stand-in for the driver's correctness gate: Spark query vs DuckDB oracle SQL.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    info = dict(name=name, rows=len(srows), oracle_rows=len(drows),
                spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if sorted(scols) != sorted(dcols):
        info.update(ok=False, why=f"columns {sorted(scols)} vs {sorted(dcols)}")
        return info
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a != b:
        sa, sb = set(a), set(b)
        info.update(ok=False, why=f"values differ: spark-only {list(sa - sb)[:3]} oracle-only {list(sb - sa)[:3]}")
        return info
    info["ok"] = True
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as E
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in (names or list(qs)):
        try:
            info = compare(spark, n, qs[n], sqls.get(n), sf_dir, con)
        except Exception as e:  # report and continue
            info = dict(name=n, ok=False, why=f"{type(e).__name__}: {str(e)[:400]}")
        if info.get("ok") is False:
            bad += 1
        print(info, flush=True)
    print(f"FAILED {bad}" if bad else "ALL OK")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
