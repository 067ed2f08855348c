"""Benchmark the headline jobs on one driver directory.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each job runs over the whole tables and is executed completely with the
``noop`` sink (no collect to the driver). The jobs run in dependency order
as one daily build: the tables several jobs read (golden customers, the
spine, fct_transactions, dim_customers) are materialized once, by the first
job that needs them, and that job's time includes it. The headline is the
cold first pass, as a daily run pays it; a second pass, over new plans and
tables in the warm JVM, is reported beside it (BENCH_WARMUP=0 leaves it
out). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlake.session import local_session  # noqa: E402
from ledgerlake.plans.model import _MODELS  # noqa: E402
from query_registry import REGISTRY  # noqa: E402

HEADLINE = [
    "m14_golden_customers",
    "m15_unified_transactions",
    "m26_fct_transactions",
    "m29_fct_accounts_receivable",
    "m30_dim_customers",
    "m33_cross_source_reconciliation",
    "m36_transaction_anomalies",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="ledgerlake-bench", clean_checkpoints=False)
    # JVM / file-listing warm-up, not timed
    spark.read.parquet(f"{sf_dir}/customer.parquet").count()

    warm = os.environ.get("BENCH_WARMUP", "1") != "0"
    times: dict[str, float] = {}
    second: dict[str, float] = {}
    for out in ([times, second] if warm else [times]):
        # every pass is a full daily run: drop the plans and tables the
        # previous pass built, so each headline table is built once, here
        _MODELS.clear()
        for k in keys:
            t = time.perf_counter()
            df = REGISTRY[k].spark(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            out[k] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_jobs_total_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "warm_total": round(sum(second.values()), 3) if warm else None,
        "warm_queries": second,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
