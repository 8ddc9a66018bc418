"""Run a query in Spark and its oracle in DuckDB; compare like the driver does
(row count, column names, order-insensitive values).

    python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    o_cols = rel.columns
    o_rows = rel.fetchall()
    res["oracle_rows"] = len(o_rows)
    if sorted(s_cols) != sorted(o_cols):
        res["status"] = "SCHEMA"
        res["detail"] = (sorted(set(s_cols) - set(o_cols)), sorted(set(o_cols) - set(s_cols)))
        return res
    a = rows_of(s_rows, s_cols)
    b = rows_of(o_rows, o_cols)
    if a == b:
        res["status"] = "ok"
    else:
        res["status"] = "VALUES" if len(s_rows) == len(o_rows) else "ROWS"
        res["detail"] = (list((a - b).items())[:2], list((b - a).items())[:2])
    return res


def main(argv):
    from pyspark.sql import SparkSession

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as E
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    q = E.queries()
    o = E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(q):
        try:
            r = compare(spark, con, k, q[k], o.get(k), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"key": k, "status": "ERROR", "detail": repr(e)[:400]}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
