"""Benchmark: end-to-end warehouse runs plus the headline registered queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_EVENT_LOG_DIR (optional: write Spark's event log there for stage times).
Prints one JSON line. ``value`` is the wall-clock of a full first run
(extract+land, nine staging upserts, three dimensions + calendar, four facts,
all written as parquet) -- the same work as the reference's three timed steps.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from starloom.plans.registry import QUERIES  # noqa: E402
from starloom.schemas import SOURCE_TABLES  # noqa: E402
from starloom.plans.warehouse import run_elt  # noqa: E402
from starloom.session import build_session, checkpoint_dir  # noqa: E402
from starloom.sources.adapters import RUN_TS, write_source_extract  # noqa: E402

HEADLINE = ["stg_orders", "stg_order_items", "merge_audit", "dim_customer_scd2",
            "dim_customer_scd2_any", "dim_customer_replay", "dim_seller_scd2", "dim_product_scd1", "fct_order_items",
            "fct_order_payments", "fct_order_reviews", "fct_order_delivery",
            "fct_order_delivery_merge", "fct_items_as_of", "on_time_by_state",
            "sales_by_current_state", "dq_unique_composite"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")  # stage/task times without the UI
    if event_dir:
        os.makedirs(event_dir, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="starloom-bench", extra=extra)
    scratch = tempfile.mkdtemp(prefix="bench-", dir=checkpoint_dir(spark))
    src_root, wh_root = f"{scratch}/source", f"{scratch}/warehouse"

    write_source_extract(spark, sf_dir, src_root)  # setup, untimed

    queries: dict[str, float] = {}
    phases1: dict[str, float] = {}
    t0 = time.perf_counter()
    run_elt(spark, src_root, wh_root, RUN_TS, "r1", timings=phases1)
    run1 = time.perf_counter() - t0
    phases2: dict[str, float] = {}
    t0 = time.perf_counter()
    run_elt(spark, src_root, wh_root, "2024-06-02 00:00:00", "r2", timings=phases2)
    run2 = time.perf_counter() - t0
    queries["elt_run1_initial"] = round(run1, 3)
    queries["elt_run2_incremental"] = round(run2, 3)
    for k, v in phases1.items():
        queries[f"elt_run1_{k}"] = v
    for k, v in phases2.items():
        queries[f"elt_run2_{k}"] = v
    # Runs that restate only the facts of changed orders, by share of changed orders, on a
    # warehouse that keeps facts by partition with changes beside them.
    pwh, parts = f"{scratch}/warehouse_parts", 64
    run_elt(spark, src_root, pwh, RUN_TS, "r1", fact_parts=parts)
    phases = {}
    t0 = time.perf_counter()
    run_elt(spark, src_root, pwh, "2024-06-02 00:00:00", "r2", timings=phases, fact_parts=parts)
    queries["elt_run2_parts"] = round(time.perf_counter() - t0, 3)
    queries["elt_run2_parts_facts"] = phases.get("facts")
    for k, per_mille in enumerate((1, 100), 3):
        changed = f"{scratch}/source-{per_mille}"
        for name in SOURCE_TABLES:
            df = spark.read.parquet(f"{src_root}/{name}")
            if name == "orders":
                hit = F.crc32("order_id") % 1000 < per_mille
                df = df.withColumn("order_status", F.when(hit, F.lit(f"s{k}")).otherwise(F.col("order_status")))
            df.write.parquet(f"{changed}/{name}")
        phases: dict[str, float] = {}
        t0 = time.perf_counter()
        run_elt(spark, changed, pwh, f"2024-06-0{k} 00:00:00", f"r{k}", timings=phases,
                incremental_facts=True, fact_parts=parts)
        queries[f"elt_incremental_{per_mille}_per_mille"] = round(time.perf_counter() - t0, 3)
        queries[f"elt_incremental_{per_mille}_per_mille_facts"] = phases.get("facts")

    # Same runs with key-bucketed landing/staging storage (shuffle-free merges).
    bwh = f"{scratch}/warehouse_bucketed"
    nb = max(8, 2 * cpus)
    for run_id, ts in (("r1", RUN_TS), ("r2", "2024-06-02 00:00:00")):
        t0 = time.perf_counter()
        run_elt(spark, src_root, bwh, ts, run_id, num_buckets=nb)
        queries[f"elt_{run_id}_bucketed"] = round(time.perf_counter() - t0, 3)

    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        queries[name] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "elt_run_seconds", "value": round(run1, 3), "unit": "sec",
                      "queries": queries, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
