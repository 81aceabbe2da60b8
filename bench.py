"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once on the smallest tables, untimed, so that classes are loaded and the
generated code is compiled; the timed run then reads $BENCH_SF_DIR for the first time.
"""

from __future__ import annotations

import json
import os
import re
import time
from pathlib import Path

from litpulse.catalog import QUERIES
from litpulse.session import build_session

WARM_UP_DIR = "/root/testdata/sf0.001"
HEADLINE = (
    "activity_ranking",
    "ranking_bridge",
    "paper_details",
    "repo_details",
    "recent_paper_totals",
    "citation_ranking",
    "citation_details",
    "reader_ranking_wide",
    "paper_pages",
    "paper_ids_in_text",
    "daily_star_counts",
    "merge_events",
    "merge_edges",
    "task_outcomes",
    "round_queue",
    "release_date_histogram",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            # The tables are small next to the work per row: keep shuffles in many parts.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, path: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    if Path(WARM_UP_DIR).exists():
        for name in HEADLINE:
            run(name, WARM_UP_DIR)
    times = {name: run(name, sf_dir) for name in HEADLINE}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
