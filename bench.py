"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  input tables, default /root/testdata/sf0.1
BENCH_CPUS    cores, default 8
BENCH_RUNS    timed runs per query after one warm-up, default 3
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES  # noqa: E402
from workload.session import local_session  # noqa: E402

HEADLINE = (
    "scan_raw",
    "read_pushdown",
    "image_metadata",
    "build_request",
    "parse_verdict",
    "flatten_label",
    "resume_anti_join",
    "capped_intake",
    "scan_position",
    "infer_stub",
    "write_shards",
    "merge_shards",
    "job_filter",
    "job_label",
    "job_incremental",
)

# A query that has used this many seconds is not repeated.
ENOUGH_SECONDS = 25


def timed(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        timed(spark, name, sf_dir)
        runs = []
        while not runs or (len(runs) < repeats and time.perf_counter() - began < ENOUGH_SECONDS):
            runs.append(timed(spark, name, sf_dir))
        seconds[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total of the median seconds per headline query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
