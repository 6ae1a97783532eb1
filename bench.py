"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores. Every query runs
to its last row (into the ``noop`` sink); the time is the best of ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cdcmart.plans.registry import QUERIES  # noqa: E402
from cdcmart.session import build_session  # noqa: E402

HEADLINE = [
    "report_delivery_status",
    "report_top_delivery_dates",
    "report_pending_items_by_product",
    "report_pending_items_salted",
    "report_pending_items_item_status",
    "report_top_customers",
    "cdc_parse_changes",
    "cdc_extra_columns",
    "codec_roundtrip",
    "latest_by_key",
    "drop_duplicate_keys",
    "merge_upsert",
    "fold_batches",
    "history_append",
    "denormalize_status",
    "status_sync",
    "backfill_merge",
    "mart_fact_orders",
    "mart_fact_order_items",
    "stream_scd4_current",
    "stream_order_items",
    "backfill_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "cdcmart-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # starts the executors

    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(runs):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - begin)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best run each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
