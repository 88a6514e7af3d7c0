"""Compare registered Spark queries with their DuckDB oracle (rows, columns, values).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_key(rows):
    return sorted((tuple(norm(v) for v in r) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="rows-only")
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    order_s = sorted(range(len(scols)), key=lambda i: scols[i])
    order_d = sorted(range(len(dcols)), key=lambda i: dcols[i])
    s_sorted = [tuple(r[i] for i in order_s) for r in srows]
    d_sorted = [tuple(r[i] for i in order_d) for r in drows]
    out = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(scols) != sorted(dcols):
        out.update(ok=False, note=f"columns differ: {sorted(scols)} vs {sorted(dcols)}")
        return out
    a, b = rows_key(s_sorted), rows_key(d_sorted)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        diff2 = [x for x in b if x not in set(a)][:3]
        out.update(ok=False, note=f"values differ; spark-only {diff}; oracle-only {diff2}")
        return out
    out.update(ok=True)
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from tidemark.session import spark_session
    import __spark_entry__ as E
    spark = spark_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, orc.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, ok=False, note=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(r, flush=True)
    print("FAILED", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
