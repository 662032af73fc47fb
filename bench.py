"""Time the headline queries; prints one JSON line.

The layers are tables, as in production: the first query that needs a layer builds and
stores it within its own time, and later queries read it. With BENCH_COLD=1 every
query starts from the raw tables instead.
"""

from __future__ import annotations

import json
import os
import time

from parcelpulse.plans.catalog import QUERIES
from parcelpulse.plans.warehouse import close_warehouses
from parcelpulse.session import local_session

HEADLINE = [
    "stg_events", "order_timeline", "stage_baselines", "item_modes", "fact_orders", "order_disruptions",
    "month_reload_roundtrip", "load_report", "flow_features", "carrier_mode", "historical_rates", "dist_by_class",
    "stratified_sample", "histogram", "sla_filter_impact", "failing_legs", "order_journey", "order_360", "roc_auc",
    "avg_precision", "regression_metrics", "class_report", "status_changes", "prefix_features", "replay_summary",
    "classifier_scores",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus, "bench")
    QUERIES["load_report"](spark, folder).count()  # start-up is not part of any query
    close_warehouses()
    times = {}
    for name in names:
        if os.environ.get("BENCH_COLD"):
            close_warehouses()
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
