"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then three times; the median counts. Results go to Spark's
``noop`` sink, so every row and column is produced and none is collected. Queries that stage
tables of their own (streams, versioned tables, landings) rebuild them in every run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "gold_by_diagnosis",
    "gold_by_state",
    "gold_by_pressure",
    "clean_encounters",
    "enrich_vitals",
    "mask_all",
    "geo_enrich",
    "quality_report",
    "null_profile",
    "duplicate_report",
    "dqs",
    "column_profile",
    "anomalies",
    "upsert",
    "scd2_apply",
    "authorize",
    "audit_table",
    "denied_alerts",
    "stage_profile",
    "run_cost",
    "duration_histogram",
    "alert_error_rate",
    "alert_idle_stage",
    "sliding_window_batch",
    "sliding_window_stream",
    "feed_timeline",
    "cluster",
    "dated_landing",
)
RUNS = 3


def main() -> None:
    from carelake.plans import catalog, staging
    from carelake.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench")
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        staging.forget()
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
