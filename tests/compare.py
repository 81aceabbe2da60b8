"""Runs registered queries next to their SQL and compares names and values.

``python -m tests.compare [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else f"{v:.6g}"
    if v is None:
        return "null"
    return f"{type(v).__name__}:{v}"


def table_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str | None):
    """Error text, empty when both agree; and the number of rows."""
    names, mine = table_rows(df.columns, df.collect())
    if sql is None:
        return "", len(mine)
    cur = con.execute(sql)
    expected_names, theirs = table_rows([d[0] for d in cur.description], cur.fetchall())
    if names != expected_names:
        return f"columns {names} != {expected_names}", len(mine)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}", len(mine)
    for a, b in zip(mine, theirs):
        if a != b:
            return f"first difference: {a} != {b}", len(mine)
    return "", len(mine)


def main(argv):
    from litpulse.session import build_session
    from litpulse.catalog import ORACLES, QUERIES

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            error, n = compare(QUERIES[name](spark, sf), con, ORACLES.get(name))
        except Exception as exc:  # reported, the other queries still run
            error, n = f"{type(exc).__name__}: {str(exc)[:1500]}", -1
        bad += bool(error)
        kind = "" if name in ORACLES else " (no SQL)"
        print(f"{'FAIL' if error else 'ok  '} {name}{kind} rows={n} {time.time() - start:.1f}s {error}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
