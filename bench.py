"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` names the folder of the tables, `BENCH_CPUS` the number of local cores. Each query
runs to its full result without collecting it; the best of `BENCH_RUNS` runs counts.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwright.registry.queries import QUERIES  # noqa: E402
from tillwright.session import build_session, clear_work  # noqa: E402

HEADLINE = (
    "silver_customer", "silver_transactions", "gold_fact_sales", "gold_sales_daily",
    "gold_sales_by_category", "gold_customer_summary", "v1_executive_kpis",
    "v2_revenue_by_category", "v3_monthly_trend", "v4_top_customers", "v5_store_performance",
    "q3_mom_growth", "q4_channel", "q5_weekend", "q6_loyalty_breakdown", "q7_top_items",
    "q8_region", "dq_report", "dedup_latest", "medallion_e2e", "alert_daily_revenue",
    "alert_daily_revenue_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    shared = tempfile.mkdtemp(prefix="tillwright-bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": shared,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    clear_work(spark.sparkContext.applicationId)
    spark.stop()
    shutil.rmtree(shared, ignore_errors=True)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
