"""Run catalogue queries and their SQL twins side by side.

    python tests/check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Rows with columns sorted by name, rows sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tidy = lambda v: None if isinstance(v, float) and math.isnan(v) else (v + 0.0 if isinstance(v, float) else v)
    out = [tuple(tidy(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else the first difference."""
    left_cols, left = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    right_cols, right = canonical([d[0] for d in cur.description], cur.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} != {right_cols}"
    if left != right:
        lefts, rights = set(left), set(right)
        only = [r for r in left if r not in rights][:3], [r for r in right if r not in lefts][:3]
        return f"{len(left)} vs {len(right)} rows; only spark {only[0]}; only sql {only[1]}"
    return None if left else "empty result"


def main(sf: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from recoflow.session import local_session

    spark, con = local_session(), connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                diff = compare(df, con, oracles[name])
                status = "ok" if diff is None else "DIFF " + diff[:900]
            else:
                status = f"rows only: {df.count()}"
        except Exception as e:  # report and go on with the next query
            status = "ERROR " + str(e)[:900]
        bad += status.startswith(("DIFF", "ERROR"))
        print(f"{name:24s} {time.time() - start:6.1f}s  {status}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.001"
    sys.exit(main(sf_dir, args))
