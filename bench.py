"""Times the headline queries and prints one JSON line.

Every query runs once untimed, then RUNS times over the whole tables, its result
going to the ``noop`` sink; the best time counts. Shared frames are dropped between
runs, so no run reads another's results.
"""

from __future__ import annotations

import json
import os
import time

from tillroll.functions.sharing import release_shared
from tillroll.plans.catalog import all_queries
from tillroll.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "clean_orders",
    "profile_numeric",
    "profile_text",
    "yearly_sales_growth",
    "sales_cagr",
    "existing_product_growth",
    "existing_product_growth_2001",
    "existing_customer_growth_2001",
    "customer_demand",
    "customer_demand_2001",
    "customer_demand_growth_2001",
    "existing_customer_sales_growth",
    "existing_customer_sales_growth_2001",
    "revenue_by_cohort_2001",
    "customer_metrics",
    "clv_segments",
    "risk_allocation_2001",
    "product_cagr",
    "boston_matrix",
    "order_baskets",
    "frequent_itemsets",
    "association_rules",
    "association_nodes",
)


def main() -> None:
    spark = local_session(CPUS)
    run = all_queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        run[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        release_shared()
        return seconds

    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(min(once(name) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of best warm query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
