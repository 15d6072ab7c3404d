"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3; the median counts).
Each run builds the query and computes every output row into a sink that discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from spendlens.catalog.queries import QUERIES
from spendlens.session import build_session

HEADLINE = [
    "clean_expenses", "expense_totals", "category_pivot", "modelling_table", "master_table", "prepared_master",
    "category_totals", "group_category_matrix", "entity_category_grid", "year_group_series", "category_hierarchy",
    "attach_group", "dedup_first", "page_stop", "cap_rows", "top_spenders", "summary_stats", "correlation_matrix",
    "linear_trend", "spend_histogram", "box_stats_by_group", "line_box_stats", "spend_band_lines",
    "group_profile_median", "group_distance", "classify_long_text", "parse_money", "kmeans_sweep",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries (median per query)",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
