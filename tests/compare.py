"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

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
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def rows_of(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records), key=repr)


def compare(spark, sf_dir: str, names=None, con=None, product_modulus: int = 10):
    import __spark_entry__ as se
    from shelfwise.plans import oracle, registry

    qs, sql = se.queries(), se.oracle_sql()
    if product_modulus != 10:
        sql = oracle.oracle_for(product_modulus)
    con = con or duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        if product_modulus == 10:
            sdf = qs[name](spark, sf_dir)
        else:
            sdf = registry.run(name, spark, sf_dir, product_modulus=product_modulus)
        srows = [r.asDict() for r in sdf.collect()]
        t1 = time.time()
        scols = sorted(sdf.columns)
        res = {"spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
        if name in sql:
            rel = con.sql(sql[name])
            dcols = sorted(rel.columns)
            drecs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
            res["duck_rows"] = len(drecs)
            res["schema_ok"] = scols == dcols
            if scols == dcols:
                a, b = rows_of(srows, scols), rows_of(drecs, scols)
                res["values_ok"] = a == b
                if a != b:
                    diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                    res["first_diff"] = {"cols": scols, "diff": diff}
            else:
                res["cols"] = (scols, dcols)
        out[name] = res
    return out


if __name__ == "__main__":
    from shelfwise.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    res = compare(spark, sf, names)
    bad = 0
    for k, v in res.items():
        ok = v.get("values_ok", None)
        bad += ok is False or v.get("schema_ok") is False
        print(k, v)
    print("FAILED" if bad else "ALL OK", bad)
