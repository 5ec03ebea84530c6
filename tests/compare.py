"""Compares registered queries with their SQL over the driver's tables."""

from __future__ import annotations

import math
import os
import sys
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    return bytes(v) if isinstance(v, bytearray) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def oracle(sql: str, sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        at = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{at}{'/*.parquet' if os.path.isdir(at) else ''}'")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def differs(df, sql: str, sf_dir: str) -> str | None:
    columns, rows = oracle(sql, sf_dir)
    if sorted(df.columns) != sorted(columns):
        return f"columns {df.columns} and {columns}"
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(columns, rows)
    return None if ours == theirs else f"{len(rows)} oracle rows; only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"


if __name__ == "__main__":
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, sf = make_session(), os.environ.get("SF", "/root/testdata/sf0.01")
    for name, q in entry.queries().items():
        if len(sys.argv) > 1 and name not in sys.argv[1:]:
            continue
        t0, sql = time.time(), entry.oracle_sql().get(name)
        try:
            said = differs(q(spark, sf), sql, sf) or "ok" if sql else f"{q(spark, sf).count()} rows, no oracle"
        except Exception as e:
            said = f"ERROR {type(e).__name__} {str(e)[:1500]}"
        print(f"{name}: {said} ({time.time() - t0:.1f} s)", flush=True)
