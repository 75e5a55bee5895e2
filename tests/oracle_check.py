"""Compare every registered query with its DuckDB oracle (like the driver's gate).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
ORACLE_STRICT=1 compares floating-point values bit for bit.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v if STRICT else float(f"{v:.10g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def duck_conn(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"SCHEMA spark={s_cols} duck={d_cols}"
        return out
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    s_norm = Counter(tuple(norm(r[i]) for i in order) for r in s_rows)
    d_norm = Counter(tuple(norm(r[d_idx[s_cols[i]]]) for i in order) for r in d_rows)
    if s_norm == d_norm:
        out["status"] = "OK"
    else:
        only_s = list((s_norm - d_norm).elements())[:3]
        only_d = list((d_norm - s_norm).elements())[:3]
        out["status"] = f"VALUES spark-only={only_s} duck-only={only_d}"
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    from kpiloom.session import local_test_session

    spark = local_test_session()
    spark.sparkContext.setLogLevel("ERROR")
    qs = entry.queries()
    sqls = entry.oracle_sql()
    con = duck_conn(sf_dir)
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        try:
            res = compare(spark, sf_dir, name, q, sqls.get(name), con)
        except Exception as e:  # report and continue
            res = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if res["status"] not in ("OK", "rows-only"):
            bad += 1
        print(res, flush=True)
    print(f"{bad} failing of {len(qs) if not names else len(names)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
