"""Headline queries, timed. Prints one JSON line.

Environment: BENCH_SF_DIR (sample folder), BENCH_CPUS (local cores).
Each query runs once to warm up and then BENCH_RUNS times (default 3); the median
counts. Results are fully computed and counted on the executors' side.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from playlens.session import local_session  # noqa: E402

HEADLINE = (
    "layer2_split",
    "flatten_a",
    "flatten_b",
    "event_base",
    "load_base_b",
    "r2_minigame",
    "r3_funnel",
    "r4_ltv",
    "r5_daily_ads",
    "r6_retention",
    "r8_play",
    "parity_raw_l2",
    "context_enrich",
    "v1_ltv_d30",
    "v8_variant_summary",
    "v9_journey_edges",
    "v10_event_reach",
    "narrow_flatten_a",
    "narrow_flatten_b",
    "marked_base_b",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cores, partitions=int(cores) if cores.isdigit() else 8, name="bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(key: str) -> float:
        started = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times: dict[str, float] = {}
    for key in HEADLINE:
        run(key)
        times[key] = round(statistics.median(run(key) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
