"""Compare every query with its SQL on one data folder: python tests/check_oracles.py [folder] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return v + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr), [names[i] for i in order]


def difference(df, con, sql: str) -> str | None:
    """None if both give the same rows; else what differs."""
    cur = con.execute(sql)
    want, want_names = rows_of([d[0] for d in cur.description], cur.fetchall())
    got, got_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_names != want_names:
        return f"columns {got_names} / {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows / {len(want)}"
    kinds = {type(a) for row in got[:50] for a in row} ^ {type(a) for row in want[:50] for a in row}
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0][0]} / {bad[0][1]}"
    return f"types {kinds}" if kinds else None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from homespan.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(folder), contract.oracle_sql(), 0
    built = contract.queries()
    for name in sys.argv[2:] or built:
        start = time.time()
        try:
            df = built[name](spark, folder)
            wrong = difference(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as err:
            wrong = f"{type(err).__name__}: {str(err)[:600]}"
        failed += wrong is not None and not wrong.startswith("rows only")
        print(f"{name}: {wrong or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    print("failed", failed)
