"""Spark query vs DuckDB twin: row count, column names/kinds, exact values.

Usable from pytest and from the command line:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _kind(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    if isinstance(v, decimal.Decimal):
        return "decimal"
    if isinstance(v, dt.datetime):
        return "timestamp"
    if isinstance(v, dt.date):
        return "date"
    if isinstance(v, str):
        return "str"
    return type(v).__name__


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    kinds = {}
    out = []
    for r in rows:
        t = tuple(r[i] for i in order)
        for n, v in zip(names, t):
            k = _kind(v)
            if k != "null":
                kinds.setdefault(n, k)
        out.append(tuple(_norm(v) for v in t))
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return names, kinds, out


_DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                  "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float",
                  "SMALLINT": "smallint", "TINYINT": "tinyint", "HUGEINT": "hugeint"}


def _duck_type(t) -> str:
    t = str(t)
    if t.startswith("DECIMAL"):
        return t.lower().replace(" ", "")
    return _DUCK_TO_SPARK.get(t, t.lower())


def compare(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_names, s_kinds, s_tab = _table(sdf.columns, srows)
    res = {"name": name, "rows": len(srows), "spark_sec": round(t1 - t0, 3)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: _duck_type(t) for c, t in zip(rel.columns, rel.types)}
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    type_diff = {c: (s_types[c], d_types[c]) for c in s_types if c in d_types and s_types[c] != d_types[c]}
    if type_diff:
        res["type_diff"] = type_diff
    d_rows = rel.fetchall()
    d_names, d_kinds, d_tab = _table(d_cols, d_rows)
    problems = []
    if s_names != d_names:
        problems.append(f"columns spark={s_names} duck={d_names}")
    if len(s_tab) != len(d_tab):
        problems.append(f"rows spark={len(s_tab)} duck={len(d_tab)}")
    for n in s_names:
        if n in d_kinds and n in s_kinds and s_kinds[n] != d_kinds[n]:
            problems.append(f"kind {n}: spark={s_kinds[n]} duck={d_kinds[n]}")
    if not problems and s_tab != d_tab:
        diff = [(a, b) for a, b in zip(s_tab, d_tab) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    res["status"] = "ok" if not problems else "FAIL"
    if problems:
        res["problems"] = problems
    return res


def main(argv):
    from tillcube.session import get_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    if os.environ.get("PLAIN_SESSION") == "1":   # a default session, as a driver may use
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = get_session("local[8]", 8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, name, fn, orc.get(name), sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": name, "status": "ERROR", "problems": [repr(e)[:500]]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(r, flush=True)
    print(f"{bad} bad of {len([n for n in qs if not only or n in only])}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
