"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: the sum of the queries' times, and each time.  A query's
time is the median of its runs after one warm-up run, its whole result written to
Spark's no-op sink.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from silverlode.session import open_session  # noqa: E402
from workload import catalog  # noqa: E402

HEADLINE = [
    "bronze_enrich", "silver_transactions", "silver_products",
    "dq_dedup", "dq_duplicates", "dq_fk_invalid",
    "validate_transactions_valid", "validate_transactions_counts", "validated_daily_sales",
    "upsert_orders", "dim_customers", "dim_products", "dim_dates",
    "daily_sales", "weekly_sales", "monthly_sales", "rfm_segments", "product_performance",
    "category_report", "top_products_per_day",
    "version_as_of", "version_diff", "restore", "compact", "zorder",
    "json_parse", "stream_ingest", "stream_window_append", "stream_window_update",
    "change_feed_restore", "incremental_after_compaction", "batch_run_daily",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    options = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = open_session("bench", f"local[{cpus}]", options)
    times = {}
    for name in names:
        seconds = []
        for i in range(runs + 1):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:] or seconds), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, [round(s, 2) for s in seconds], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "runs": runs,
    }))


if __name__ == "__main__":
    main()
