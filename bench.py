"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and, for a
quick look, BENCH_QUERIES (comma-separated names) come from the environment.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkkit.registry import QUERIES  # noqa: E402
from sparkkit.session import build_session  # noqa: E402

HEADLINE = (
    "ols gd_simple gd_multi taxis_by_drivers drivers_by_money_per_minute surcharge_by_hour payment_shares "
    "card_share_by_hour drivers_by_money_per_mile tip_quartiles tip_outliers top_parts top_customers "
    "top_customer_suppliers foreign_only_customers top_nations similar_customers co_bought_parts full_order_lines "
    "routes worst_delay_january most_cancelled cancel_ratio max_delay_month avg_delay_month worst_cancel_date "
    "flights_by_state_carrier worst_state dictionary tfidf avg_tf_by_class knn_vote tokens_strict sparse_counts "
    "logit_eval logit_top_words mixture_clusters"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(os.path.basename(folder).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
