"""Plans of joins and merges whose sides are too large to send, on small tables of their own."""

from __future__ import annotations

import glob
import time

from pyspark.sql import functions as F
from starloom.operators.merge import upsert_overwrite
from starloom.plans import facts, registry
from test_plans import E, _executed, _tables


def test_orders_are_sent_whole_only_once_measured(spark, scratch):
    """2.5 M orders take a few MB of files and far more as a table to look reviews up in."""
    root = _tables(spark, f"{scratch}/in")
    many = spark.range(2_500_000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 6).alias("o_custkey"),
                                         F.lit("O").alias("o_orderstatus"),
                                         F.lit("2023-05-01").cast("timestamp").alias("o_orderdate"))
    many.write.mode("overwrite").parquet(f"{root}/orders.parquet")
    texts = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.expr(
        "array_join(transform(sequence(1, 1000), x -> md5(concat(id, '-', x))), '')").alias("text"))
    texts.write.mode("overwrite").parquet(f"{root}/documents.parquet")
    out = E.queries()["review_text_metrics"](spark, root)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    got = {r["review_id"]: (r["review_length_chars"], r["comment_status"]) for r in out.collect()}
    assert got == {str(k): (0, "No Comment") if k % 6 == 0 else (3, "No Comment") if k % 7 == 0
                   else (32_000, "Has Comment") for k in range(200)}


def _shuffle_files(spark) -> set[str]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}


def test_stored_rows_leave_no_shuffle_files(spark, scratch):
    r = registry.run_for(spark, _tables(spark, scratch))
    before = _shuffle_files(spark)
    stored = r.by_order("lines", "order_id", lambda: r.src["order_items"])
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, r.src["order_items"].collect()))


def test_items_merge_moves_and_stores_narrow_items(spark, scratch, monkeypatch):
    """No item is stored with its surrogates, whether products are sent to the items or looked
    up aside, in several passes; products that come twice or not at all count as in a join."""
    name = "fct_order_items"
    _tables(spark, scratch)
    parts = [(k, f"p{k}", "ECONOMY", k) for k in (0, 0, 1, 2, 3, *range(5, 20))]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_size int") \
        .write.mode("overwrite").parquet(f"{scratch}/part.parquet")
    key, sk = facts.FACT_KEYS[name]
    for aside in (False, True):
        r = registry.Run(spark, scratch)
        monkeypatch.setattr(registry, "run_for", lambda *_, r=r: r)
        if aside:
            monkeypatch.setattr(registry, "SENT_ROWS", 8)
            monkeypatch.setattr(registry, "PASS_ROWS", 20)
        merged = registry.QUERIES[f"{name}_merge"](spark, scratch)
        assert _executed(merged).count("Exchange hashpartitioning(order_") == 1
        assert "by_order_items" in r._memo and f"by_order_{name}" not in r._memo
        assert ("by_order_item_products" in r._memo) == aside
        plain = r.fact(name)
        wanted = upsert_overwrite(registry._prev_fact(r, name, plain), plain, list(key), registry.RUN_TS, id_col=sk)
        rows = sorted(map(repr, merged.collect()))
        assert rows == sorted(map(repr, wanted.collect())) and len(rows) > len(set(rows)) > 60
