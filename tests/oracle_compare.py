"""Spark query vs DuckDB oracle: row count, column names, order-insensitive values.

Used by tests/test_oracle.py and runnable alone:
    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def rows_of(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in data)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E
    q = E.queries()[name]
    sql = E.oracle_sql().get(name)
    sdf = q(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    out = {"query": name, "spark_rows": len(s_rows)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"columns differ: spark={s_cols} oracle={d_cols}"
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        out["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        out["status"] = "values differ"
        out["only_spark"] = sorted(sa - sb)[:3]
        out["only_oracle"] = sorted(sb - sa)[:3]
        out["columns"] = sorted(s_cols)
    return out


if __name__ == "__main__":
    from rentyield.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    names = sys.argv[2:] or list(E.queries())
    spark = build_session("local[8]", 8)
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"query": n, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("match", "no-oracle")
        print(r, flush=True)
    print("mismatches:", bad)
