"""Run registered queries in Spark and their SQL in DuckDB, and compare the results.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``.
Rows are compared order-insensitively after sorting columns by name; floats
must agree to a relative 1e-9, and an exact-value flag is reported as well.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    out = []
    for v in row:
        if v is None:
            out.append((0, ""))
        elif isinstance(v, float):
            out.append((1, f"{v:.6g}"))
        else:
            out.append((2, str(v)))
    return out


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=_key)


def _close(a, b) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, bool) or isinstance(b, bool):
        return bool(a) == bool(b) and type(a) is type(b)
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_records = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_records = rel.fetchall()
    t2 = time.time()
    sc, sr = _rows(s_cols, s_records)
    dc, dr = _rows(d_cols, d_records)
    result = {
        "name": name,
        "spark_rows": len(sr),
        "duck_rows": len(dr),
        "columns_match": sc == dc,
        "spark_sec": round(t1 - t0, 2),
        "duck_sec": round(t2 - t1, 2),
    }
    bad = []
    if sc == dc and len(sr) == len(dr):
        for a, b in zip(sr, dr):
            if not all(_close(x, y) for x, y in zip(a, b)):
                bad.append((a, b))
        result["exact"] = sr == dr
    result["value_mismatches"] = len(bad)
    result["ok"] = sc == dc and len(sr) == len(dr) and not bad
    if not result["ok"]:
        result["spark_columns"] = sc
        result["duck_columns"] = dc
        result["examples"] = bad[:3]
    return result


def main(argv):
    from tripmart.session import get_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck_connection(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failures = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"{name:28s} rows-only  spark_rows={n}")
            continue
        r = compare(spark, con, name, fn, sqls[name], sf_dir)
        flag = "OK " if r["ok"] else "BAD"
        print(f"{name:28s} {flag} rows={r['spark_rows']}/{r['duck_rows']} exact={r.get('exact')} "
              f"t={r['spark_sec']}s")
        if not r["ok"]:
            failures += 1
            print("   spark:", r["spark_columns"])
            print("   duck: ", r["duck_columns"])
            for a, b in r["examples"]:
                print("   S", a)
                print("   D", b)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
