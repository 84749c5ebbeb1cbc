"""Run registered Spark queries against their DuckDB twins and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return repr([norm(x) for x in v])
    if isinstance(v, dict):
        return repr(sorted((k, norm(x)) for k, x in v.items()))
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t)), [cols[i] for i in order]


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    dtypes = [str(d[1]) for d in rel.description]
    res["duck_rows"] = len(drows)
    a, ac = rows_of(scols, srows)
    b, bc = rows_of(dcols, drows)
    if ac != bc:
        res["status"] = f"COLUMNS DIFFER spark={ac} duck={bc}"
        return res
    if a != b:
        sa, sb = set(a), set(b)
        diff_a = [r for r in a if r not in sb][:3]
        diff_b = [r for r in b if r not in sa][:3]
        res["status"] = "VALUES DIFFER"
        res["spark_only"] = diff_a
        res["duck_only"] = diff_b
        res["types"] = list(zip(scols, stypes, dtypes))
        return res
    res["status"] = "ok"
    return res


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from shelfline.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connect(sf_dir)
    qs = E.queries()
    sqls = E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        try:
            r = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names or qs) - bad} ok / {bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
