"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores. Each query is built and
run to the end into a sink that drops the rows, so every column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pagemart.registry import QUERIES
from pagemart.session import build_session

HEADLINE = [
    "flagship_best_placed", "feed_wb_products", "htm1_extract_rules", "lnk1_extract_links", "lnk7_reachable_pages",
    "lnk8_dedupe_requests", "lnk9_resolve_canonical", "ext1_wb_listing_html", "ext2_wb_listing_json",
    "ext3_wb_product_page", "ext5_ozon_listing", "ext6_ozon_product_page", "ext9_category_tree", "ext11_producer_page",
    "ext12_reviews", "ext14_first_review_date", "j1_category_context", "j3_attach_first_review", "j4_purchases_lookup",
    "agg1_bans_by_status", "w3_position_running", "w4_attempt_no", "w6_failures_in_a_row", "ord2_skip_take",
    "geo1_distance_km", "str1_strip", "st1_endpoint_health", "st3_ban_counters_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("flagship_best_placed", "ext3_wb_product_page"):
        QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
