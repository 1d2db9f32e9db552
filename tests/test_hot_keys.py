"""One key holding a third of all rows: results stay whole and exact, and the
operators combine rows map-side (partial aggregation) instead of gathering
the hot group in one task through a window."""

from datetime import datetime

from pyspark.sql import functions as F

from starloom.operators.aggregates import order_sellers, order_totals
from starloom.operators.merge import latest_per_key
from starloom.operators.quality import check_unique
from starloom.plans import dims
from test_golden import DIM, GEO, T0

N = 30000


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _hot(spark):
    """Rows with key 'hot' for every third id, otherwise a unique key."""
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("i"),
        (F.col("id") % 97).cast("string").alias("s"),
        (F.col("id") % 1000).cast("double").alias("v"),
        F.timestamp_seconds(F.col("id") % 5000).cast("timestamp_ntz").alias("ts"))


def test_latest_per_key_hot_key(spark):
    df = _hot(spark)
    out = latest_per_key(df, "k", [("ts", "desc"), ("i", "asc")])
    got = {r["k"]: r["i"] for r in out.collect()}
    assert len(got) == N - N // 3 + 1
    # hot rows: ids 0, 3, 6, ...; latest ts = id % 5000 max (4998 -> ids 4998, 9998?, ...)
    hot_ids = [i for i in range(0, N, 3)]
    best = min(hot_ids, key=lambda i: (-(i % 5000), i))
    assert got["hot"] == best
    plan = _plan(out)
    assert "Window" not in plan
    assert "Partial" in plan or "partial_" in plan


def test_aggregates_hot_order(spark):
    items = _hot(spark).select(F.col("k").alias("order_id"), F.col("s").alias("seller_id"),
                               F.col("v").alias("payment_value"))
    sellers = {r["order_id"]: r for r in order_sellers(items, with_count=True).collect()}
    assert sellers["hot"]["seller_count"] == 97 and sellers["hot"]["first_seller_id"] == "0"
    totals = {r["order_id"]: float(r["total_order_value"]) for r in order_totals(items).collect()}
    assert totals["hot"] == float(sum(i % 1000 for i in range(0, N, 3)))
    assert "partial_" in _plan(order_totals(items))


def test_check_unique_hot_key(spark):
    got = check_unique(_hot(spark), "k").collect()
    assert [(r["k"], r["row_count"]) for r in got] == [("hot", N // 3)]


def test_scd2_any_with_hot_natural_key(spark):
    """A third of all staged customers share one natural key."""
    stg = _hot(spark).select(
        F.col("i").cast("string").alias("customer_id"), F.col("k").alias("customer_unique_id"),
        F.lit(1).alias("customer_zip_code_prefix"), F.col("s").alias("customer_city"),
        F.lit("S").alias("customer_state"), F.lit("x").alias("id"),
        F.lit(T0).cast("timestamp_ntz").alias("created_at"),
        F.lit(T0).cast("timestamp_ntz").alias("updated_at"))
    geo = spark.createDataFrame([(1, 1.0, 1.0, "g", "G", "x", T0, T0)], GEO)
    cur = spark.createDataFrame([("sk", "hot", "0", "S", 1.0, 1.0, datetime(2024, 1, 1).date(),
                                  datetime(9999, 12, 31).date(), "Current", T0, T0)], DIM)
    out = dims.build_dim_customer(cur, stg, geo, "2024-06-01 00:00:00", "any")
    hot = out.filter("customer_nk = 'hot'").collect()
    assert sorted(r["current_flag"] for r in hot) == ["Current", "Expired"]
    assert out.filter("current_flag = 'Current'").count() == N - N // 3 + 1
    assert "Window" not in _plan(out)
