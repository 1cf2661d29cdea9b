"""Wall-clock seconds of the headline queries, warm JVM, median of several runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from riskloom.plans import QUERIES
from riskloom.session import local_session

HEADLINE = [
    "risk_distribution",
    "prediction_table",
    "anonymize_pipeline",
    "privacy_report",
    "latest_prediction",
    "threshold_sweep",
    "upsert_do_update",
    "risk_response",
    "risk_quintiles",
    "audit_change_log",
    "drift_psi",
    "combined_metrics",
    "local_surrogate",
    "prediction_table_explained",
    "validation_report",
    "audit_stream",
    "audit_log_as_of",
    "portfolio_kept_up_to_date",
    "prediction_table_trained",
]

WARM = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, "riskloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + WARM):  # the first runs warm up and are not counted
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[WARM:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
