"""Times the headline queries: BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8).

Each query runs from the source tables to a full result; nothing is shared between
queries. The JVM is warmed by runs of the flagship on the smallest tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketshift.plans import catalog  # noqa: E402
from basketshift.session import build_session  # noqa: E402

HEADLINE = [
    "switch_prob_order", "switch_prob_order_brand", "switch_prob_order_day", "switch_prob_log", "coview_counts", "spendswitch",
    "lift_ci", "theil_index", "items_in_scope", "prod_tail", "customer_orders", "basket_seq", "attr_matrix", "sku_in_scope",
    "month_coverage", "publish_roundtrip",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    small = os.path.join(os.path.dirname(folder), "sf0.001")
    if not os.path.isdir(small):
        small = folder
    for name in ("switch_prob_order", "switch_prob_order_brand", "switch_prob_order"):
        drain(queries[name](spark, small))
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        drain(queries[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(folder).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
