"""Headline timings as one JSON line.

``load_*`` entries store tables from the raw frames; the other entries run a
registered query over the stored tables. Each query runs once to warm up, then
its median of three runs counts. Loads are timed once, from an empty folder.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark import registry
from tidemark.schemas import CLEAN, STAR
from tidemark.session import local_session

QUERIES = (
    "clean_accounts", "clean_subscriptions", "clean_churn_events", "clean_feature_usage", "clean_support_tickets",
    "monthly_feature", "ticket_monthly", "q1_churned_mrr", "q2_churn_rate", "q3_net_impact", "q31_industry",
    "q4_high_value", "q5_profile", "concurrent_subscriptions", "grain_check", "check_pk", "check_fk_clean",
    "check_star", "row_counts",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "tidemark-bench", spark__ui__showConsoleProgress="false")
    warehouse = registry.warehouse(spark, folder)
    for table in warehouse.raw:
        warehouse.raw[table].limit(1).collect()  # opens the files, starts the executors

    seconds = {}
    for layer, names in ((warehouse.clean, CLEAN), (warehouse.star, STAR)):
        for name in names:
            seconds[f"load_{name}"] = timed(lambda: layer[name])
    queries = registry.queries()
    for name in QUERIES:
        run = lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = statistics.median(timed(run) for _ in range(3))
    print(
        json.dumps(
            {
                "metric": "load the warehouse once and run every headline query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
