"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from stratamart.plans.queries import QUERIES
from stratamart.session import build_session

HEADLINE = (
    "dedupe_orders",
    "clean_products",
    "clean_customers",
    "clean_orders",
    "ref_integrity_orders",
    "flatten_events",
    "flatten_lines",
    "unpivot_rates",
    "scd2_users",
    "scd2_table",
    "pit_customer",
    "asof_fx",
    "dim_customer",
    "dim_product",
    "dim_date",
    "fact_sales",
    "agg_daily_store",
    "agg_category",
    "run_summary",
    "key_pool",
)


def timed(spark, folder: str, name: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(runs)), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder).removeprefix("sf")}))


if __name__ == "__main__":
    main()
