"""Run registered Spark queries and their DuckDB oracle side by side.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares column names, row counts and the order-insensitive multiset of
rows (exactly, and with floats rounded to 9 significant digits).
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
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, approx: bool):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if approx:
            return float(f"{v:.9g}")
        return repr(v)  # keeps the sign of zero, as a text hash would
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, approx) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, approx)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(), approx)
    return v


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS differ spark={s_cols} duck={d_cols}"
        return res
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    res["spark_types"] = [f.dataType.simpleString() for f in sdf.schema.fields]
    res["duck_types"] = [str(rel.types[i]) for i in order]
    exact = Counter(_norm(r, False) for r in s_rows) == Counter(_norm(r, False) for r in d_rows)
    if exact:
        res["status"] = "OK"
    else:
        sa = Counter(_norm(r, True) for r in s_rows)
        da = Counter(_norm(r, True) for r in d_rows)
        if sa == da:
            res["status"] = "APPROX (float bits differ)"
        else:
            res["status"] = "MISMATCH"
            res["only_spark"] = list((sa - da).elements())[:3]
            res["only_duck"] = list((da - sa).elements())[:3]
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    import __spark_entry__ as E
    from seqlab.session import get_session
    spark = get_session("local[8]", 8)
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, name, fn, ors.get(name), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"done: {len(qs)} queries, {bad} not OK")


if __name__ == "__main__":
    main()
