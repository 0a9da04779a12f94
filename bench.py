"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and the cores; BENCH_RUNS the
repeats after one warm-up run.  A query's time is the median over the repeats of building, planning and running it.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from martkit.plans.registry import all_queries  # noqa: E402
from martkit.session import local_session  # noqa: E402

HEADLINE = [
    "q01_monthly_trend", "q02_top_categories", "q03_revenue_by_state", "q04_repeat_customers",
    "q05_delivery_by_state", "q06_delay_vs_review", "q07_payments", "q08_seller_risk", "q09_seller_concentration",
    "fact_orders", "fact_order_items", "dim_customer", "chk_foreign_keys", "chk_iqr_outliers", "chk_full_duplicates",
    "msr_customers", "rpt_kpi_row", "cl_log",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("martkit-bench", cores=cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = all_queries(), {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale) if scale.replace(".", "").isdigit() else scale, "cores": cores, "spark": spark.version,
        "lineitem_rows": spark.read.parquet(f"{folder}/lineitem.parquet").count()}))
    spark.stop()


if __name__ == "__main__":
    main()
