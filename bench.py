"""Time the headline queries: one warm-up and BENCH_REPEATS timed runs (median) each, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from gearledger.plans.registry import queries
from gearledger.session import local_session

HEADLINE = [
    "daily_delivery_net", "daily_actual_receipts", "daily_scorecard", "vehicle_scorecard", "repeat_by_city",
    "manager_scorecard", "service_charge_by_manager", "region_bonus_factors", "bonus_table", "arg_min_ties",
    "price_min_merge", "price_avg_merge", "upsert_price_history", "local_price_match", "inquiry_alias_parts",
    "offer_brand_list", "product_count_salted",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("OFF")
    known = queries()
    times = {}
    for name in HEADLINE:
        def run(name=name):
            return known[name](spark, folder)
        seconds(run)
        times[name] = round(statistics.median(seconds(run) for _ in range(repeats)), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
