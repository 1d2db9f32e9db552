"""Three warehouse runs through the versioned writer: load, change, reversal."""

from datetime import date

from pyspark.sql import functions as F

from starloom.plans.warehouse import latest_manifest, run_elt
from starloom.schemas import SOURCE_TABLES
from starloom.sources.adapters import write_source_extract


def _write_day(spark, base, out, city_of_1=None):
    for name in SOURCE_TABLES:
        df = spark.read.parquet(f"{base}/{name}")
        if name == "customers" and city_of_1 is not None:
            df = df.withColumn("customer_city", F.when(F.col("customer_unique_id") == "0",
                                                       F.lit(city_of_1))
                               .otherwise(F.col("customer_city")))
        df.write.mode("overwrite").parquet(f"{out}/{name}")


def test_three_runs(spark, scratch):
    base = f"{scratch}/base"
    write_source_extract(spark, "/root/testdata/sf0.001", base)
    wh = f"{scratch}/wh"
    days = [("2024-06-01 00:00:00", None), ("2024-06-02 00:00:00", "MOVED"),
            ("2024-06-03 00:00:00", None)]
    for i, (ts, city) in enumerate(days, 1):
        src = f"{scratch}/src{i}"
        _write_day(spark, base, src, city)
        run_elt(spark, src, wh, ts, f"r{i}")

    m = latest_manifest(spark, wh)
    from starloom.plans.warehouse import read_dimension
    dim = read_dimension(spark, wh, "dim_customer")
    current, *increments = m[("final", "dim_customer")]
    assert "/r3-" in current and [p.split("/")[-1][:2] for p in increments] == ["r1", "r2", "r3"]
    # each run's increment holds what it expired: history is not copied
    assert [spark.read.parquet(p).count() for p in increments] == [0, 1, 1]
    assert spark.read.parquet(current).filter("current_flag <> 'Current'").isEmpty()
    assert spark.read.parquet(*m[("final", "dim_customer")]).exceptAll(dim).isEmpty()
    assert dim.groupBy("customer_id").count().filter("count > 1").isEmpty()
    audit = {(r["table_name"], r["action"]): r["row_count"]
             for r in spark.read.parquet(m[("audit", "merge_audit")]).collect()}
    assert audit[("customers", "updated")] == 2  # both customers that share natural key 0
    v = sorted((r["valid_from"], r["valid_to"], r["current_flag"], r["customer_city"])
               for r in dim.filter("customer_nk = '0'").collect())
    assert [x[2] for x in v] == ["Expired", "Expired", "Current"]
    assert v[0][0] == date(2024, 6, 1) and v[0][1] == date(2024, 6, 2)
    assert v[1] == (date(2024, 6, 2), date(2024, 6, 3), "Expired", "MOVED")
    assert v[2][0] == date(2024, 6, 3) and v[2][1] == date(9999, 12, 31)
    # every other key has exactly one version
    others = dim.filter("customer_nk <> '0'").groupBy("customer_nk").count()
    assert others.filter("count <> 1").count() == 0

    stg = spark.read.parquet(m[("stg", "customers")])
    assert stg.count() == spark.read.parquet(f"{base}/customers").count()
    fct = spark.read.parquet(m[("final", "fct_order_delivery")])
    assert fct.groupBy("order_nk").count().filter("count > 1").count() == 0
    assert fct.filter("created_at < updated_at").count() == fct.count()  # restated on runs 2, 3


def test_bucketed_runs_merge_without_shuffle(spark, scratch):
    """With bucketed storage the second run's staging merge reads both sides
    co-bucketed: no exchange in the merge plan, same rows as unbucketed."""
    from starloom.operators.merge import upsert_changed
    from starloom.plans.warehouse import (latest_buckets, read_version, source_ddl,
                                          staging_schema_ddl)
    base = f"{scratch}/base"
    write_source_extract(spark, "/root/testdata/sf0.001", base)
    plain, bucketed = f"{scratch}/plain", f"{scratch}/bucketed"
    for i, ts in enumerate(["2024-06-01 00:00:00", "2024-06-02 00:00:00"], 1):
        run_elt(spark, base, plain, ts, f"r{i}")
        run_elt(spark, base, bucketed, ts, f"r{i}", num_buckets=4)
    mp, mb = latest_manifest(spark, plain), latest_manifest(spark, bucketed)
    for layer, table in [("stg", "orders"), ("stg", "order_items"), ("final", "fct_order_items"),
                         ("final", "dim_customer")]:
        pa, pb = ([x] if isinstance(x, str) else x for x in (mp[(layer, table)], mb[(layer, table)]))
        a = spark.read.parquet(*pa)
        b = spark.read.parquet(*pb).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, table
    bk = latest_buckets(spark, bucketed)
    assert bk[("stg", "order_items")] == (4, ("order_id", "order_item_id"))
    cur = read_version(spark, mb[("stg", "order_items")], bk[("stg", "order_items")],
                       staging_schema_ddl("order_items"))
    inc = read_version(spark, mb[("landing", "order_items")], bk[("landing", "order_items")],
                       source_ddl("order_items"))
    m = upsert_changed(cur.select(*inc.columns, "id", "created_at", "updated_at"), inc,
                       ["order_id", "order_item_id"],
                       ["product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
                       "2024-06-03 00:00:00")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_duplicate_extract_key_fails_the_run(spark, scratch):
    import pytest
    from starloom.operators.quality import QualityError
    base = f"{scratch}/base"
    write_source_extract(spark, "/root/testdata/sf0.001", base)
    bad = f"{scratch}/bad"
    _write_day(spark, base, bad)
    sellers = spark.read.parquet(f"{base}/sellers")
    sellers.unionByName(sellers.limit(1)).write.mode("overwrite").parquet(f"{bad}/sellers")
    with pytest.raises(QualityError, match="unique key of sellers"):
        run_elt(spark, bad, f"{scratch}/wh", "2024-06-01 00:00:00", "r1")
    assert latest_manifest(spark, f"{scratch}/wh") == {}     # nothing published


def test_csv_extract_loads_like_parquet(spark, scratch):
    from starloom.sources.tables import extract_to_csv, scan_sources
    base = f"{scratch}/base"
    write_source_extract(spark, "/root/testdata/sf0.001", base)
    extract_to_csv(scan_sources(spark, base), f"{scratch}/csv")
    run_elt(spark, base, f"{scratch}/wp", "2024-06-01 00:00:00", "r1")
    run_elt(spark, f"{scratch}/csv", f"{scratch}/wc", "2024-06-01 00:00:00", "r1",
            source_format="csv")
    mp, mc = latest_manifest(spark, f"{scratch}/wp"), latest_manifest(spark, f"{scratch}/wc")
    for key in [("stg", "order_reviews"), ("stg", "orders"), ("final", "fct_order_reviews")]:
        a, b = spark.read.parquet(mp[key]), spark.read.parquet(mc[key])
        assert a.exceptAll(b.select(*a.columns)).count() == 0, key
        assert b.count() == a.count(), key


def test_incremental_facts_equal_full_restatement(spark, scratch):
    base = f"{scratch}/base"
    write_source_extract(spark, "/root/testdata/sf0.001", base)
    day2 = f"{scratch}/day2"
    _write_day(spark, base, day2, city_of_1="MOVED")
    orders = spark.read.parquet(f"{base}/orders")
    orders.withColumn("order_status", F.when(F.col("order_id") == "5", F.lit("X"))
                      .otherwise(F.col("order_status"))) \
        .write.mode("overwrite").parquet(f"{day2}/orders")
    full, inc = f"{scratch}/full", f"{scratch}/inc"
    for wh, incremental in ((full, False), (inc, True)):
        run_elt(spark, base, wh, "2024-06-01 00:00:00", "r1")
        run_elt(spark, day2, wh, "2024-06-02 00:00:00", "r2", incremental_facts=incremental)
    mf, mi = latest_manifest(spark, full), latest_manifest(spark, inc)
    touched = {"5"} | {r["order_id"] for r in spark.read.parquet(f"{base}/orders")
                       .filter("customer_id IN ('0', '1')").collect()}
    for name in ("fct_order_items", "fct_order_payments", "fct_order_reviews",
                 "fct_order_delivery"):
        a = spark.read.parquet(mf[("final", name)])
        b = spark.read.parquet(mi[("final", name)]).select(*a.columns)
        cols = [c for c in a.columns if c != "updated_at"]
        assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0, name
        assert b.count() == a.count(), name
        restated = {r["order_nk"] for r in b.filter("updated_at = '2024-06-02 00:00:00'")
                    .select("order_nk").collect()}
        assert restated <= touched, (name, sorted(restated - touched)[:5])
        assert "5" in restated or name == "fct_order_reviews", name
    d = spark.read.parquet(mi[("final", "fct_order_delivery")])
    assert d.filter("order_nk = '5'").first()["order_status"] == "X"


def test_rebuild_facts_starts_from_empty(spark, scratch):
    base = f"{scratch}/base"
    write_source_extract(spark, "/root/testdata/sf0.001", base)
    wh = f"{scratch}/wh"
    run_elt(spark, base, wh, "2024-06-01 00:00:00", "r1")
    run_elt(spark, base, wh, "2024-06-02 00:00:00", "r2", rebuild_facts=True)
    m = latest_manifest(spark, wh)
    f = spark.read.parquet(m[("final", "fct_order_items")])
    assert f.count() > 0
    assert f.filter("created_at <> '2024-06-02 00:00:00'").count() == 0   # reloaded, not merged
