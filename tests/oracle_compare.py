"""Run a registered query in Spark and its oracle in DuckDB; compare row
count, column names and an order-insensitive hash of normalised values.

CLI: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for ln in lines:
        h.update(ln.encode())
        h.update(b"\n")
    return h.hexdigest(), lines


def duck(sf_dir, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, sf_dir, name, fn, sql):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    dcols, drows = duck(sf_dir, sql)
    sh, sl = digest(scols, srows)
    dh, dl = digest(dcols, drows)
    ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and sh == dh
    info = {"name": name, "ok": ok, "spark_rows": len(srows), "duck_rows": len(drows),
            "spark_cols": scols, "duck_cols": dcols, "sec": round(t1 - t0, 2)}
    if not ok:
        a, b = set(sl), set(dl)
        info["only_spark"] = sorted(a - b)[:3]
        info["only_duck"] = sorted(b - a)[:3]
    return info


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from scrubline.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(queries())
    spark = local_session(shuffle_partitions=8)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(n, "no oracle")
            continue
        try:
            info = compare(spark, sf_dir, n, qs[n], sqls[n])
        except Exception as e:  # report and keep going
            info = {"name": n, "ok": False, "error": repr(e)[:400]}
        bad += not info["ok"]
        print(info, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
