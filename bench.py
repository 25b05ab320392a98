"""Benchmark: headline queries at $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS]; each query is run in full (``noop`` sink, every row
produced): all once on a small copy to warm the JVM up, then each once more
at the measured scale, then timed three times; the median counts.
Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from ledgerline.plans.registry import QUERIES  # noqa: E402
from ledgerline.session import build_session, clear_scratch  # noqa: E402

HEADLINE = (
    "order_mart", "item_mart", "fact_orders", "dim_users", "fact_items",
    "pk_violations", "fk_orphans", "avg_sales_by_category", "top_prices_in_period",
    "top_sales_per_category", "top_item_per_category", "peak_hour", "multi_category_users",
    "age_histogram", "age_quartiles", "monthly_mean_count", "duration_histogram", "box_stats",
    "validate_orders", "first_error", "rule_sku_place", "row_ids", "append_records", "delete_records",
    "sink_overwrite", "insert_new_keys", "stream_intake", "stream_dedup_keys",
)


def run_once(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="ledgerline-bench",
                          extra={"spark.driver.memory": "16g"})
    # JVM warm-up: every query once on a small copy of the data (JIT of the
    # generated code), then once more at the measured scale before timing.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf):
        for name in names:
            run_once(spark, name, warm_dir)
    times = {}
    for name in names:
        run_once(spark, name, sf)                                # warm-up
        times[name] = round(statistics.median(run_once(spark, name, sf) for _ in range(reps)), 3)
    clear_scratch(spark)
    spark.stop()
    label = os.path.basename(sf.rstrip("/"))
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": label.replace("sf", "") if label.startswith("sf") else label,
           "cpus": cpus, "reps": reps}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
