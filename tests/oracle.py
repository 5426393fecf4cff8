"""Runs a query on Spark and its SQL in DuckDB and compares the rows as multisets."""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from glob import glob

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as repo  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> str:
    """Empty if equal, else what differs."""
    df = repo.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*cols).collect())
    sql = repo.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return f"columns {cols} against {sorted(rel.columns)}"
    want = Counter(rel.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall())
    if got == want:
        return "" if got else "equal, but no rows"
    extra, lack = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"rows {sum(got.values())} against {sum(want.values())}; extra {extra}; lacking {lack}"


if __name__ == "__main__":
    from stratalake.session import build_session

    sf = sys.argv[1]
    names = sys.argv[2:] or list(repo.queries())
    session = build_session("oracle", cpus=8)
    con = connect(sf)
    bad = 0
    for n in names:
        t = time.time()
        try:
            said = compare(session, con, sf, n)
        except Exception as e:  # noqa: BLE001
            said = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(said)
        print(f"{'ok  ' if not said else 'FAIL'} {time.time() - t:6.2f}s {n} {said}", flush=True)
    print(f"{bad} of {len(names)} differ")
