"""Time the headline queries; prints one JSON line.

Each query runs twice to warm up, then `BENCH_RUNS` times; the median counts.
The result goes to Spark's noop sink, so every row is computed and nothing is
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ticketflow.plans.queries import QUERIES  # noqa: E402
from ticketflow.session import build_session  # noqa: E402

HEADLINE = (
    "phase_label",
    "worktime_daily",
    "backlog_by_type_team",
    "backlog_daily",
    "backlog_matched_cutpoints",
    "throughput_time",
    "fte_norm_by_type",
    "fte_norm_phase_team",
    "conformance_cumulative",
    "leaderboard_longest_open",
    "leaderboard_highest_fte",
)
WARM_UPS = 2


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(f"local[{cpus}]", cpus, app="bench", options={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(WARM_UPS + runs):
            start = time.perf_counter()
            QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[WARM_UPS:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(base).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
