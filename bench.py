"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads, BENCH_RUNS the timed runs
after one warm-up run. The value is the sum of the medians in seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reviewloom.plans.catalog import QUERIES  # noqa: E402
from reviewloom.session import build_session  # noqa: E402

HEADLINE = [
    "w1_cumulative_reviews", "w2_ewm_mean", "w5_rating_trend", "w6_competitor_trend", "w7_rolling_mean",
    "w8_age_cohorts", "o1_customer_overlap", "o1_overlap_of_branches", "o2_category_overlap", "o5_checkin_profile",
    "o7_rating_vs_checkins", "k1_top_useful", "a18_quantile", "t3_top_words", "t4_telling_words", "t5_holdout_accuracy",
    "t9_drop_sparse", "t11_stemmed_recommendations", "t16_tfidf_log2",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times: dict[str, float] = {}
    for name in wanted:
        run(spark, name, folder)
        times[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
