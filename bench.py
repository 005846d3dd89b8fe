"""Benchmark: run the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely through the ``noop`` sink (no driver
collect) and timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "I1_prepare_history",
    "I5_lag_features",
    "F16_forecast_metrics",
    "I4_prepare_orders",
    "J2_lot_sizing_cost",
    "J3_order_up_to_plan",
    "K2_nearest_depot",
    "K4_routes",
    "L1_demand_spike",
    "L2_supply_delay",
    "L3_depot_failure",
    "I9_model_metrics",
    "I12_forecast_recursive",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from stockroute.plans import catalog
    from stockroute.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")),
                          app="stockroute-bench")
    # warm-up: JVM, Python workers, parquet footers
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).count()


    def once(name: str) -> float:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.time() - t0, 3)

    # cold: the first query that needs a prepared table (the history, the lagged
    # rows, the fitted model) pays for it; warm: all of them are there
    times = {name: once(name) for name in HEADLINE}
    warm = {name: once(name) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "warm": warm, "sf": sf}))


if __name__ == "__main__":
    main()
