"""Compare registered Spark queries with their DuckDB SQL on the same parquet tables.

Usable from pytest (``compare_one``) and as a script::

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        return (2, f"{v:.9g}")
    if isinstance(v, (int, decimal.Decimal)):
        return (2, f"{float(v):.9g}") if isinstance(v, decimal.Decimal) else (3, str(v))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return (4, bytes(v).hex())
    if isinstance(v, dt.datetime):
        return (5, v.replace(tzinfo=None).isoformat())
    if isinstance(v, (list, tuple)):
        return (6, repr([_norm(x) for x in v]))
    return (7, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows), sorted(c.lower() for c in columns)


def compare_one(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    s_vals, s_names = rows_of(s_cols, s_rows)
    d_vals, d_names = rows_of(d_cols, d_rows)
    if s_names != d_names:
        res["status"] = f"columns differ: {s_names} vs {d_names}"
    elif len(s_vals) != len(d_vals):
        res["status"] = "row counts differ"
    elif s_vals != d_vals:
        diff = next(i for i, (a, b) in enumerate(zip(s_vals, d_vals)) if a != b)
        res["status"] = f"values differ at sorted row {diff}: {s_vals[diff]} vs {d_vals[diff]}"
    else:
        res["status"] = "ok"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from ferry.session import build_session
    import __spark_entry__ as entry
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare_one(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as exc:  # report and continue with the others
            r = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(qs) if not names else len(names)} checked, {bad} not ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
