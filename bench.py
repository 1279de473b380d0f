"""Headline queries on the benchmark tables; prints one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the number of cores,
``BENCH_QUERIES`` an optional comma-separated choice.
"""

from __future__ import annotations

import json
import os
import time

from martloom.bindings import queries
from martloom.session import build_session

HEADLINE = [
    "rfm_segments",
    "shipping_status",
    "shipping_datamart",
    "sales_fact",
    "customer_retention",
    "courier_fact",
    "courier_ledger",
    "group_conversion",
    "nearest_place",
    "user_geo_mart",
    "zone_activity",
    "recommend_pairs",
    "campaign_match_batch",
    "vault_h_order",
    "vault_l_order_product",
    "user_product_counters",
    "daily_currency_metrics",
    "dq_unique",
    "upsert_last_write",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    builders = queries()
    # One small job first, so that the first query does not pay for starting the engine.
    builders["rfm_metrics"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        builders[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale})
    )
    spark.stop()


if __name__ == "__main__":
    main()
