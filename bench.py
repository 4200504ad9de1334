"""Times the headline queries and prints one JSON line.

Every query runs from the supplied tables to its full result, written to Spark's no-op sink, in
one session: one warm-up of the session, then one timed run per query. ``all_layers`` writes all
bronze, silver and gold tables; the ``gold.`` queries then read the written gold tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from bazarlake.lake import build
from bazarlake.operators.workdir import fresh_folder
from bazarlake.plans import analyses as a
from bazarlake.registry import RUN_ID, RUN_TS, all_queries
from bazarlake.sources.adapter import text_feed

HEADLINE = (
    "silver_orders",
    "silver_order_items",
    "order_service",
    "fact_order_service",
    "fact_order_item_sales",
    "dim_customer",
    "mart_logistics_performance",
    "mart_service_risk",
    "mart_customer_experience",
    "mart_monthly_operations",
    "kpi_overview",
    "q1_category",
    "q1_seller",
    "q1_state",
    "q2_seller",
    "q2_category",
    "q2_state",
    "q3_late_vs_review",
    "q4_distance",
    "q5_seller_priority",
    "q5_category_priority",
    "dq_completeness",
    "dq_validity",
    "dq_quarantine_rate",
)

ON_GOLD = {
    "kpi_overview": lambda lake: a.kpi_overview(lake.fact_order_service),
    "q1_category": lambda lake: a.q1_category(lake.fact_order_item_sales, lake.dim_product),
    "q1_seller": lambda lake: a.q1_seller(lake.fact_order_item_sales),
    "q1_state": lambda lake: a.q1_state(lake.fact_order_service, lake.dim_customer),
    "q2_seller": lambda lake: a.q2_seller(lake.mart_logistics_performance),
    "q2_category": lambda lake: a.q2_category(lake.fact_order_item_sales, lake.dim_product),
    "q2_state": lambda lake: a.q2_state(lake.fact_order_service, lake.dim_customer),
    "q3_late_vs_review": lambda lake: a.q3_late_vs_review(lake.fact_order_service),
    "q4_distance": lambda lake: a.q4_distance(lake.fact_order_service),
    "q5_seller_priority": lambda lake: a.q5_seller_priority(lake.mart_logistics_performance),
    "q5_category_priority": lambda lake: a.q5_category_priority(lake.fact_order_item_sales, lake.dim_product),
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bazarlake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = all_queries()
    names = sys.argv[1:] or list(HEADLINE)

    seconds = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        result = action()
        if result is not None:
            result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("warm_up", lambda: catalogue["silver_orders"](spark, sf_dir))
    del seconds["warm_up"]
    for name in names:
        timed(name, lambda: catalogue[name](spark, sf_dir))
    if not sys.argv[1:]:
        written = []

        def write_layers() -> None:
            root = fresh_folder(spark, "bench")
            written.append(build(spark, lambda feed: text_feed(spark, sf_dir, feed), root, RUN_ID, RUN_TS))

        timed("all_layers", write_layers)
        for name, report in ON_GOLD.items():
            timed(f"gold.{name}", lambda: report(written[0]))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
