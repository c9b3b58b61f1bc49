"""Run registered queries on Spark and their SQL twins on DuckDB, compare.

Usage: python tests/oracle_harness.py [sf_dir] [name-substring ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_pd = sdf.toPandas()
    t1 = time.time()
    d_pd = con.execute(sql).df()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(s_pd), "duck_rows": len(d_pd), "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    res["columns_ok"] = sorted(s_pd.columns) == sorted(d_pd.columns)
    if not res["columns_ok"]:
        res["col_diff"] = (sorted(set(s_pd.columns) - set(d_pd.columns)), sorted(set(d_pd.columns) - set(s_pd.columns)))
        res["ok"] = False
        return res
    a, b = canon(s_pd), canon(d_pd)
    res["values_ok"] = a == b
    if not res["values_ok"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        res["first_diff"] = diff
    res["ok"] = res["columns_ok"] and res["values_ok"] and len(s_pd) == len(d_pd)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    pats = argv[2:]
    from stayframe.session import local_session
    import __spark_entry__ as E

    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs = E.queries()
    sqls = E.oracle_sql()
    bad = 0
    for name, build in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        if name not in sqls:
            t0 = time.time()
            n = build(spark, sf_dir).count()
            print({"name": name, "rows_only": n, "s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, con, name, build, sqls[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "ok": False, "error": repr(e)[:800]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
