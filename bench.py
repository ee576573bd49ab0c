"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local threads),
BENCH_QUERIES (comma-separated keys; default: the headline list).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from ledgerline.catalog.registry import ENTRIES
from ledgerline.session import build_session

HEADLINE = [
    "br1_largest_monthly_drops",
    "br1_largest_monthly_total_drops",
    "br2_category_concentration",
    "br3_print_efficiency_leaderboard",
    "br4_internet_readiness_growth",
    "br5_multi_year_decline",
    "br6_readiness_engagement_outlier",
    "q1_circulation_trend",
    "q2_top_cities",
    "q3_print_waste",
    "q4_revenue_by_category",
    "q5_revenue_vs_circulation",
    "q6_readiness_vs_pilot",
    "q7_revenue_per_copy",
    "q8_relaunch_priorities",
    "x1_city_category_concentration",
    "c2_chart_category_share",
    "c3_chart_roi",
    "e3_fact_print_sales",
    "e4_fact_ad_revenue",
    "a7_consolidate",
    "a11_keep_first",
    "j7_fan_out",
    "k7_surrogate_id",
    "w1_lag_detail_rows",
    "d9_rows_quarantined",
    "g3_city_language_matrix",
    "pr4_converted_share",
    "s1_csv_scan",
    "s2_csv_multi_line",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or HEADLINE
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and of code generation is not what is measured.
    for key in ("a1_sum_by_keys", "q7_revenue_per_copy"):
        ENTRIES[key](spark, folder).collect()
    seconds, again = {}, {}
    for key in keys:
        for found in (seconds, again):
            start = time.perf_counter()
            ENTRIES[key](spark, folder).write.format("noop").mode("overwrite").save()
            found[key] = round(time.perf_counter() - start, 3)
        print(f"{key}: {seconds[key]}s, then {again[key]}s", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "second_runs": again,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
