"""Spark-vs-DuckDB comparison of registered queries (used by the tests and
runnable by hand: ``python -m tests.compare [sf_dir] [name ...]``)."""

from __future__ import annotations

import math
import sys
import time

import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if v.is_integer():  # a nullable integer column comes as floats from one side
            return str(int(v))
        return repr(round(v, 9))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out)


def compare(spark, con, sf_dir, name, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    ddf = con.execute(sql).df()
    scols, srows = rows_of(sdf)
    dcols, drows = rows_of(ddf)
    ok = scols == dcols and srows == drows
    detail = ""
    if not ok:
        if scols != dcols:
            detail = f"columns spark={scols} duck={dcols}"
        else:
            ss, dd = set(srows), set(drows)
            detail = (f"rows spark={len(srows)} duck={len(drows)}; only spark: {sorted(ss - dd)[:3]}; "
                      f"only duck: {sorted(dd - ss)[:3]}")
    return ok, len(srows), t1 - t0, detail


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from turnmill.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name:28s} rows={n}")
            continue
        try:
            ok, n, dt, detail = compare(spark, con, sf_dir, name, fn, sqls[name])
        except Exception as e:  # report and go on
            ok, n, dt, detail = False, -1, 0.0, f"{type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name:28s} rows={n:<6d} {dt:6.2f}s {detail}")
    print(f"failures: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
