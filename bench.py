"""Time the headline queries and print one JSON line.

Each query runs to completion through the ``noop`` sink, so every output row is computed
and none is fetched. ``queries`` are the first runs, planning and compilation included,
``warm_queries`` the second. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma separated, or
``all``) override the defaults.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from checks.session import local_session  # noqa: E402

HEADLINE = [
    "rfm_raw",
    "rfm_enriched",
    "rfm_distribution",
    "rolling_7_30",
    "threshold_scores",
    "contribution_pct",
    "anomaly_alerts",
    "alert_summary",
    "mrr_ledger",
    "cohort_nrr",
    "recognition_status",
    "nrr_quality",
    "arr_waterfall",
    "quarantine",
    "canary",
    "salted_aggregate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else (chosen.split(",") if chosen else HEADLINE)
    spark = local_session("bench", cpus)
    # Start the JVM's file reading once, outside the measurements.
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    seconds = {name: timed(name) for name in names}
    warm = {name: timed(name) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "warm_value": round(sum(warm.values()), 3),
                "warm_queries": warm,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
