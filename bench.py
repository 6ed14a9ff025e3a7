"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  directory of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    runs per query, the fastest counts (default 2)
BENCH_ONLY    comma-separated names instead of the headline list, or ``all``
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillhouse.registry import REGISTRY  # noqa: E402
from tillhouse.session import local_session  # noqa: E402

HEADLINE = [
    "top10_categories", "top10_from_daily_rollup", "monthly_detail", "items_categories", "sales_detail",
    "sales_by_day", "sales_by_month", "sales_today", "sales_avg_7day", "inventory_delta",
    "sales_detail_incremental", "sales_by_day_partition_overwrite", "inventory_delta_upsert",
    "snapshot_read", "upsert_moving_partitions", "apply_changes", "insert_new_items", "fk_orphans",
    "unique_violations", "contract_check", "scan_json", "stringop_regex_replace", "activity_summary",
    "activity_state", "running_total", "weighted_draw", "promotion_best_price", "scaler_apply",
    "eval_metrics", "stream_upsert_final", "stream_minute_counts", "stream_zone_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = os.environ.get("BENCH_ONLY", "")
    names = list(REGISTRY) if only == "all" else only.split(",") if only else HEADLINE
    spark = local_session(cpus, "bench")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
