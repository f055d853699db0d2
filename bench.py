"""Time the headline queries on one local session and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans import load_queries
from tidemark.plans.registry import runner
from tidemark.session import build_session

HEADLINE = (
    "current_state_orders", "cdc_decode_events", "cdc_validate_envelope", "upsert_merge", "upsert_keep_first",
    "vault_load_link_three_hubs", "vault_satellite_changed", "vault_point_in_time", "vault_pit_daily_payment", "vault_bridge_rental_film",
    "mart_customer_summary", "mart_film_popularity", "mart_inventory_status", "mart_revenue_by_store", "mart_staff_performance",
    "mart_orders", "mart_products", "mart_daily_revenue", "report_actor_info", "report_film_list", "report_sales_by_store",
    "report_customer_balance", "quality_check_suite", "quality_duplicate_preview", "quality_volume_anomalies", "drift_classify",
    "privacy_round_trip", "privacy_erase_events", "assert_exclusive_ranges_allowed", "assert_increasing", "assert_quantile_between",
    "assert_within_n_moving_stdevs", "assert_unique_combination", "shape_pivot", "calendar_date_dimension", "stream_drain_to_bronze",
)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
           "spark.sql.files.maxPartitionBytes": os.environ.get("BENCH_SPLIT", "4m"), "spark.sql.files.openCostInBytes": "1m"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = load_queries()
    seconds: dict[str, float] = {}
    runner(registered["shape_pivot"])(spark, path).write.format("noop").mode("overwrite").save()
    for name in names:
        begin = time.time()
        runner(registered[name])(spark, path).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - begin, 3)
    scale = os.path.basename(path.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
