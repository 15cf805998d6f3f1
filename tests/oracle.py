"""Run a query and its SQL side by side and compare rows.

python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if repr(g) != repr(w):
            return f"{str(g)[:400]}\n   != {str(w)[:400]}"
    return None


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from caseloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, sqls, bad = local_session(), connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                diff = compare(df, con, sqls[name])
                rows = len(con.execute(sqls[name]).fetchall())
            else:
                diff, rows = None, df.count()
        except Exception as error:  # noqa: BLE001
            diff, rows = f"{type(error).__name__}: {str(error)[:1500]}", -1
        bad += diff is not None
        state = "FAIL" if diff else ("ok" if name in sqls else "ok (rows only)")
        print(f"{time.time() - start:6.2f}s {rows:6d} {name:28s} {state} {diff or ''}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
