"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query result is fully materialised with the ``noop`` sink; one warm-up, then the median of
``$BENCH_REPEAT`` (default 3) timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetlens import get_spark  # noqa: E402
from fleetlens.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "decisions_by_type",
    "cooldown_decisions",
    "cooldown_asof",
    "prom_exposition",
    "lineage",
    "overlapping_runs",
    "audit_reviews",
    "recurring_findings",
    "vps_findings",
    "stack_findings",
    "mac_findings",
    "memory_status",
    "schedule_ticks",
    "counter_rate",
    "latency_p95",
    "chain_outcome",
    "webhook_to_tasks",
    "all_signals",
    "vps_exposition",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark(f"local[{cpus}]", app="fleetlens-bench", shuffle_partitions=int(cpus) * 2)
    names = [q for q in HEADLINE if q in QUERIES]
    if len(sys.argv) > 1:
        names = [q for q in sys.argv[1:] if q in QUERIES]
    times: dict[str, float] = {}
    for name in names:
        def run():
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        run()  # warm-up
        times[name] = round(statistics.median(run() for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
