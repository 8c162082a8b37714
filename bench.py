"""Times headline queries on the driver tables and prints one JSON line.

Every query is fully executed (all rows and columns) into Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recogna.plans import catalog  # noqa: E402
from recogna.session import build_session  # noqa: E402

HEADLINE = (
    "line_billing",
    "revenue_schedules",
    "schedule_catch_up",
    "schedule_run",
    "order_on_hand",
    "waterfall_monthly",
    "waterfall_quarters",
    "waterfall_quarter_to_date",
    "account_summary",
    "insight_totals",
    "expected_deferred",
    "journal_lines",
    "journal_validation",
    "gl_batches_100",
    "bundle_shares",
    "ramp_allocation",
    "all_routes",
    "shared_key_merge",
    "lineage_merge",
    "unbilled_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores, int(cores) if cores.isdigit() else 8)
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").limit(1).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_headline_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cores,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
