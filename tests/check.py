"""Compare registered queries with their SQL checks: row count, columns, values in any order."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, (bool, str)) or v is None:
        return v
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], Counter(tuple(plain(r[k]) for k in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    right = rows_of([d[0] for d in cur.description], cur.fetchall())
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] != right[1]:
        a, b = left[1] - right[1], right[1] - left[1]
        return f"rows {left[1].total()} vs {right[1].total()}; only here {list(a.items())[:3]}; only check {list(b.items())[:3]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from wayfold.session import local_session

    sf, wanted = sys.argv[1], sys.argv[2:]
    sf_dir = f"/root/testdata/{sf}"
    spark, con = local_session(8), connect(sf_dir)
    checks, bad = entry.oracle_sql(), 0
    for name, q in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            problem = compare(spark, con, sf_dir, q, checks[name]) if name in checks else f"rows only: {q(spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        if problem:
            bad += 1
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("differences", bad)
