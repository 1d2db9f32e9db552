"""Physical-plan shape: the properties that matter at scale."""

import __spark_entry__ as E
from starloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_in_any_plan(spark):
    for name, q in QUERIES.items():
        plan = _optimized(q(spark, SF))
        for op in ("EvalPython", "InPandas", "InArrow", "PythonUDF"):
            assert op not in plan, (name, op)


def test_role_dates_broadcast_calendar_once(spark):
    df = E.queries()["role_playing_dates"](spark, SF)
    df.collect()  # finalise the adaptive plan
    plan = _plan(df)
    assert plan.count("BroadcastHashJoin") >= 5
    assert plan.count("ReusedExchange") == 4    # one calendar broadcast serves five roles


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    for name in ("latest_per_key", "dim_customer_scd2", "fct_order_reviews"):
        opt = _optimized(E.queries()[name](spark, SF))
        assert "min_by" in opt, name
    # library operators on plain inputs: no window anywhere in the plan
    from test_golden import DIM, GEO, STG_C
    from starloom.plans import dims
    d = dims.build_dim_customer(spark.createDataFrame([], DIM), spark.createDataFrame([], STG_C),
                                spark.createDataFrame([], GEO), "2024-06-01 00:00:00", "any")
    assert "Window" not in _optimized(d)


def test_scan_prunes_columns_and_pushes_filters(spark):
    from pyspark.sql import functions as F
    df = spark.read.parquet(f"{SF}/orders.parquet").filter(F.col("o_orderkey") > 10) \
        .select("o_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_review_text_not_shuffled(spark):
    """Review text measures are computed before the dedupe shuffle."""
    opt = _optimized(E.queries()["fct_order_reviews"](spark, SF))
    agg_part = opt[opt.find("Aggregate"):]
    assert "review_comment_message" not in agg_part.split("Project")[0]


def test_delta_merge_streams_the_stored_side(spark, scratch):
    """A small delta merges into a large stored table without shuffling it."""
    from pyspark.sql import functions as F
    from starloom.operators.merge import upsert_delta, upsert_overwrite
    big = spark.range(200000).select(F.col("id").cast("string").alias("k"),
                                     F.lit("a").alias("v"), F.md5(F.col("id").cast("string")).alias("sk"),
                                     F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"),
                                     F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))
    delta = spark.createDataFrame([("5", "b", None), ("x", "c", None)], "k string, v string, sk string")
    delta.write.parquet(f"{scratch}/delta")  # a run reads the delta from its work area
    delta = spark.read.parquet(f"{scratch}/delta")
    out = upsert_delta(big, delta, "k", "2024-06-01 00:00:00", id_col="sk")
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "SortMergeJoin" not in plan
    ref = upsert_overwrite(big, delta, "k", "2024-06-01 00:00:00", id_col="sk")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, ref.collect()))


LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def _tables(spark, root):
    """A few orders with lines, among them an order and a line without keys and equal lines."""
    from datetime import datetime
    day = datetime(2023, 5, 1)
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "FRANCE", 0)]),
        "customer": ("c_custkey long, c_nationkey int", [(k, 0) for k in range(6)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(k, 0) for k in range(4)]),
        "part": ("p_partkey long, p_name string, p_type string, p_size int", [(k, f"p{k}", "ECONOMY", k) for k in range(5)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp",
                   [(k, k % 6, "O", day) for k in range(30)] + [(None, 1, "O", day)]),
        "lineitem": (LINES, [(k, (k + n) % 5, n % 4, n, 1.0, 10.0 * k + n, 0.0, 0.0, "ANR"[n % 3], "O", day)
                             for k in range(30) for n in range(1, 4)]
                     + [(7, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "A", "O", day)] * 2
                     + [(None, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "A", "O", day)]),
        "documents": ("doc_id long, text string, lang string", [(k, "good", "en") for k in range(8)]),
    }
    for name, (ddl, data) in rows.items():
        spark.createDataFrame(data, ddl).write.parquet(f"{root}/{name}.parquet")
    return root


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_line_views_give_the_rows_of_their_sql(spark, scratch):
    from starloom.sources import adapters
    adapters.register(spark, _tables(spark, scratch))
    for view in ("src_order_items", "src_order_payments", "prev_order_items", "prev_order_payments"):
        own = spark.table(view)
        plain = spark.sql(adapters.render(adapters.all_views()[view], "spark"))
        assert own.columns == plain.columns
        assert sorted(map(repr, own.collect())) == sorted(map(repr, plain.collect()))


def test_fact_merges_do_not_deal_out_stored_rows_again(spark, scratch):
    from starloom.plans.registry import QUERIES
    _tables(spark, scratch)
    for name in ("fct_order_payments", "fct_order_items", "fct_order_delivery"):
        merged = QUERIES[f"{name}_merge"](spark, scratch)
        plan = _executed(merged)
        # The retired rows are the only ones dealt out by order.
        assert plan.count("Exchange hashpartitioning(order_") == 1, plan
        new = QUERIES[name](spark, scratch)
        keys = {r["order_nk"] for r in new.select("order_nk").collect()}
        assert keys and keys <= {r["order_nk"] for r in merged.collect()}


def test_line_items_are_dealt_out_once_for_both_states(spark, scratch):
    from starloom.plans.registry import QUERIES
    plan = _executed(QUERIES["stg_order_payments"](spark, _tables(spark, scratch)))
    assert "ReusedExchange" in plan, plan


def test_staging_merges_deal_out_narrow_lines_and_not_the_earlier_state(spark, scratch):
    from starloom.plans.registry import QUERIES
    _tables(spark, scratch)
    for name in ("stg_order_items", "stg_order_payments"):
        plan = _executed(QUERIES[name](spark, scratch))
        own = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "Reused" not in x]
        # The lines, and the one row that no longer arrives.
        assert len([x for x in own if "ENSURE_REQUIREMENTS" in x]) == 1, plan
        assert len([x for x in own if "REPARTITION_BY_NUM" in x]) == 1, plan
    plan = _executed(spark.table("src_order_items"))
    numbered, dealt = plan.split("Exchange hashpartitioning")
    assert "AS product_id" in numbered and "AS product_id" not in dealt


def test_star_row_counts_stores_the_orders_once(spark, scratch):
    from starloom.plans.registry import QUERIES, run_for
    counts = {r["table_name"]: r["row_count"] for r in QUERIES["star_row_counts"](spark, _tables(spark, scratch)).collect()}
    stored = [k for k in run_for(spark, scratch)._memo if k.startswith("by_order_keys_of_")]
    assert len(stored) == 1
    for name in ("fct_order_items", "fct_order_payments", "fct_order_reviews", "fct_order_delivery"):
        assert counts[name] == QUERIES[name](spark, scratch).count()


def test_changed_key_check_by_action_needs_no_landed_rows(spark):
    from pyspark.sql import functions as F
    from starloom.operators.merge import KEPT, upsert_changed
    from starloom.operators.quality import check_foreign_key_changed
    old, new = "2024-01-01 00:00:00", "2024-06-01 00:00:00"
    ddl = "k string, p string, v int, id string, created_at timestamp_ntz, updated_at timestamp_ntz"
    prev = spark.createDataFrame([("a", "1", 1), ("b", "2", 1), ("c", "2", 1), (None, "2", 1), ("d", "2", 1)],
                                 "k string, p string, v int") \
        .selectExpr("*", "k as id", f"timestamp_ntz'{old}' as created_at", f"timestamp_ntz'{old}' as updated_at")
    assert prev.columns == [x.split()[0] for x in ddl.split(", ")]
    landed = spark.createDataFrame([("a", "1", 1), ("b", "2", 1), ("c", "2", 5), (None, "2", 1), ("e", "9", 1)],
                                   "k string, p string, v int")
    staged = upsert_changed(prev, landed, "k", ["p", "v"], new, with_action=True)
    parents, staged_parents = (spark.createDataFrame([(x,) for x in ids], "pk string") for ids in ("1", "12"))
    changed = F.col("updated_at") == F.lit(new).cast("timestamp_ntz")

    def found(*a, **kw):
        return sorted(map(repr, check_foreign_key_changed(staged, changed, "k", "p", *a, parents, staged_parents, "pk",
                                                          **kw).collect()))
    by_action = found(None, kept=F.col("merge_action") == KEPT)
    assert by_action == found(landed) and len(by_action) == 4
