"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice, from building the plan to the last row; the faster run counts. One
extra run of the first query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskloom.plans.queries import QUERIES  # noqa: E402
from riskloom.session import build_session  # noqa: E402

HEADLINE = [
    "agg8_monthly_global", "agg7_daily_global", "agg7_daily_vendor", "agg7_daily_product",
    "agg9_yearly_global", "agg10_trailing_12mo_vendor", "win1_running_vendor", "agg11_thresholds",
    "agg12_threshold_ranges", "win2_most_complete_per_key", "win3_latest_per_key", "jn1_merge_sources",
    "jn11_search", "agg13_null_profile", "agg17_vendor_product_map", "cdc1_diff_builds", "cdc2_scd2_merge",
    "cdc5_sync_current", "cdc7_refresh_levels_monthly_global", "exp15_parse_vector", "nst1_normalize_staging",
    "str1_kev_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timed(HEADLINE[0])
    times = {}
    for name in HEADLINE:
        times[name] = round(min(timed(name), timed(name)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    sf = Path(sf_dir).name.removeprefix("sf")
    result = {
        "metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
