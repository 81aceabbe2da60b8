"""``python -m tests.llm.compare [sf_dir] [name ...]``: registered queries next to their SQL, one line each."""

from __future__ import annotations

import sys
import time


def main(argv):
    from litpulse.llm.queries import ORACLES, QUERIES
    from litpulse.session import build_session
    from tests.compare import compare, connect

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            error, n = compare(QUERIES[name](spark, sf), con, ORACLES.get(name))
        except Exception as exc:  # reported, the other queries still run
            error, n = f"{type(exc).__name__}: {str(exc)[:1500]}", -1
        bad += bool(error)
        print(f"{'FAIL' if error else 'ok  '} {name}{'' if name in ORACLES else ' (no SQL)'} rows={n} {time.time() - start:.1f}s {error}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
