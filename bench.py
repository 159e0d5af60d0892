"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the star-schema folder, BENCH_CPUS the local cores. Each
query runs once to warm up and then BENCH_RUNS times; the best run counts.
BENCH_QUERIES picks other queries: names with commas, or "all".
"""

import json
import os
import time

from checks.queries import BASKET_QUERIES
from trolley.plans.baskets import open_baskets
from trolley.session import build_session

HEADLINE = [
    "prior_combined", "product_statistics", "user_features", "user_product_features",
    "pair_max_streak", "days_since_prior_reorder_rate", "hour_reorder_rate", "final_features",
    "training_set", "split_report", "scaled_validation", "context_features", "slot_products",
    "best_by_order_rate", "routed_recommendations", "user_most_reordered", "missing_values",
    "gap_histogram", "executive_kpis", "department_performance", "product_reorder_rank",
    "customer_segments", "department_pair_counts", "user_profile", "business_summary",
]


def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def run_all(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "trolley-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    baskets = open_baskets(spark, folder)
    seconds = {
        "derive_baskets": timed(lambda: (baskets.prior, baskets.train)),
        "feature_tables": timed(lambda: (baskets.pairs, baskets.rates, baskets.training_set)),
    }
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not chosen else list(BASKET_QUERIES) if chosen == "all" else chosen.split(",")
    for name in names:
        query = BASKET_QUERIES[name]
        times = [timed(lambda: run_all(query(baskets))) for _ in range(runs + 1)]
        seconds[name] = min(times[1:] or times)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
