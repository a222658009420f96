"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs twice to warm up and then three times; its number is the median. A run covers
building the plan and computing every row of the result (written to Spark's ``noop`` sink).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from ledgerloom.plans.catalog import QUERIES
from ledgerloom.session import local_session

HEADLINE = [
    "agg_01_store_quarter_totals",
    "agg_03_daily_revenue",
    "agg_04_revenue_summary",
    "agg_06_reporting_pack",
    "jn_01_identity_resolution",
    "jn_03_fx_asof",
    "jn_04_asof_large",
    "jn_08_reconcile_join",
    "jn_12_build_dim_customer",
    "win_01_dedupe_redelivery",
    "win_02_cdc_latest",
    "win_03_cdc_history",
    "win_04_carry_forward",
    "flt_01_malformed_quarantine",
    "flt_03_event_rules",
    "set_02_union_findings",
    "set_05_order_insensitive_equality",
    "dq_05_summary_conserves_revenue",
    "lin_03_upstream_walk",
    "str_03_cdc_apply",
    "snk_04_gold_from_layers",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARM_UPS = 2


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    times = {}
    for name in HEADLINE:
        for _ in range(WARM_UPS):
            seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(RUNS)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
        "cpus": int(cpus), "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
