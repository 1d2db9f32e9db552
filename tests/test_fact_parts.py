"""Facts by partition, co-bucketed plans, the step log, clusters, two publishers."""

import threading

import pytest
from pyspark.sql import functions as F

from starloom.operators.quality import QualityError
from starloom.operators.steplog import read_step_log
from starloom.plans import facts
from starloom.plans.fact_store import part_of, split_paths
from starloom.plans.warehouse import (ORDER_KEYS_DDL, ManifestError, build_facts, latest_buckets, latest_manifest,
                                      publish_manifest, read_dimension, read_fact, read_version, run_elt, staging_schema_ddl)
from starloom.schemas import SOURCE_TABLES
from starloom.sources.adapters import write_source_extract

SF = "/root/testdata/sf0.001"
N = 32


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """An extract, and one with one order in a hundred changed."""
    first, second = (str(tmp_path_factory.mktemp(x)) for x in ("day1", "day2"))
    write_source_extract(spark, SF, first)
    for n in SOURCE_TABLES:
        df = spark.read.parquet(f"{first}/{n}")
        if n == "orders":
            df = df.withColumn("order_status", F.when(F.col("order_id") % 1000 == 5, F.lit("X")).otherwise(F.col("order_status")))
        df.write.mode("overwrite").parquet(f"{second}/{n}")
    return first, second


def _values(df, *drop):
    cols = sorted(c for c in df.columns if c not in drop)
    return df.select(*cols)


def _same(a, b, *drop):
    a, b = _values(a, *drop), _values(b, *drop)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_runs_of_few_changes_leave_the_partitions_as_they_are(spark, scratch, days, monkeypatch):
    import starloom.plans.fact_store as store
    monkeypatch.setattr(store, "MAX_CHANGES", 1)
    whole, parts = f"{scratch}/whole", f"{scratch}/parts"
    run_elt(spark, days[0], whole, "2024-06-01", "r1")
    run_elt(spark, days[1], whole, "2024-06-02", "r2")
    run_elt(spark, days[0], parts, "2024-06-01", "r1", fact_parts=N)
    first = latest_manifest(spark, parts)
    run_elt(spark, days[1], parts, "2024-06-02", "r2", fact_parts=N, incremental_facts=True)
    second = latest_manifest(spark, parts)
    changed = spark.read.parquet(f"{days[1]}/orders").filter("order_status = 'X'").select(F.col("order_id").alias("order_nk"))
    touched = {r[0] for r in changed.select(part_of(N)).collect()}
    assert 0 < len(touched) < N
    for n in facts.FACT_KEYS:
        old, new = first[("final", n)], second[("final", n)]
        assert new[:len(old)] == old and [p.split("/")[-1] for p in new[len(old):]] in (["changes"], [])
        for k, p in split_paths(new)[0].items():  # every row lies in its partition
            assert spark.read.parquet(p).filter(part_of(N) != k).isEmpty()
        assert _same(read_fact(spark, parts, n), read_fact(spark, whole, n), "updated_at"), n
    run_elt(spark, days[1], parts, "2024-06-03", "r3", fact_parts=N, incremental_facts=True)  # nothing changed
    assert all(latest_manifest(spark, parts)[("final", n)] == second[("final", n)] for n in facts.FACT_KEYS)
    # A second folder of changes is one too many: the partitions that changed are folded, the others stay.
    run_elt(spark, days[0], parts, "2024-06-04", "r4", fact_parts=N, incremental_facts=True)
    fourth = latest_manifest(spark, parts)
    run_elt(spark, days[0], whole, "2024-06-04", "r4")
    for n in facts.FACT_KEYS:
        old, (new, changes) = split_paths(first[("final", n)])[0], split_paths(fourth[("final", n)])
        rewritten = {k for k in new if new[k] != old.get(k)}
        assert not changes and rewritten <= touched and (rewritten or n == "fct_order_reviews"), n
        assert _same(read_fact(spark, parts, n), read_fact(spark, whole, n), "updated_at"), n
    # Another number of partitions deals all rows anew; a run without partitions gathers them.
    run_elt(spark, days[1], parts, "2024-06-05", "r5", fact_parts=4, incremental_facts=True)
    run_elt(spark, days[1], whole, "2024-06-05", "r5")
    for n in facts.FACT_KEYS:
        assert split_paths(latest_manifest(spark, parts)[("final", n)])[0].keys() <= set(range(4))
        assert _same(read_fact(spark, parts, n), read_fact(spark, whole, n), "updated_at"), n
    run_elt(spark, days[1], parts, "2024-06-06", "r6", incremental_facts=True)
    for n in facts.FACT_KEYS:
        assert isinstance(latest_manifest(spark, parts)[("final", n)], str)
        assert _same(read_fact(spark, parts, n), read_fact(spark, whole, n), "updated_at"), n


def test_bucketed_fact_plans_do_not_exchange_the_order_tables(spark, scratch, days):
    wh = f"{scratch}/wh"
    paths = run_elt(spark, days[0], wh, "2024-06-01", "r1", num_buckets=4)
    stg = {n: read_version(spark, paths[("stg", n)], latest_buckets(spark, wh)[("stg", n)], staging_schema_ddl(n))
           for n in SOURCE_TABLES}
    star = {n: read_dimension(spark, wh, n) for n in ("dim_customer", "dim_seller")}
    star |= {n: spark.read.parquet(paths[("final", n)]) for n in ("dim_date", "dim_product")}
    keys = facts.order_customer_keys(stg["orders"], stg["customers"], star["dim_customer"]).repartition(4, "order_id")
    from starloom.plans.warehouse import write_version
    bucket = (4, ("order_id",))
    keys = read_version(spark, write_version(keys, wh, "work", "keys", "test", bucket), bucket, ORDER_KEYS_DDL)
    plain = {n: spark.read.parquet(paths[("stg", n)]) for n in SOURCE_TABLES}
    for n, df in build_facts(stg, star, True, keys).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning(order_id" not in plan, n
        assert _same(df, build_facts(plain, star)[n]), n
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"  # the session's, given back


def test_steps_of_good_and_failed_runs(spark, scratch, days):
    wh = f"{scratch}/wh"
    run_elt(spark, days[0], wh, "2024-06-01", "r1")
    run_elt(spark, days[1], wh, "2024-06-02", "r2")
    log = {(r["run_id"], r["step"], r["table_name"]): r for r in read_step_log(spark, wh).collect()}
    assert {r["status"] for r in log.values()} == {"Success"}
    orders = log[("r2", "stg", "orders")]
    n = spark.read.parquet(f"{days[0]}/orders").count()
    changed = spark.read.parquet(f"{days[1]}/orders").filter("order_status = 'X'").count()
    assert (orders["inserted"], orders["updated"], orders["unchanged"], orders["kept"]) == (0, changed, n - changed, 0)
    assert log[("r1", "stg", "orders")]["inserted"] == n and orders["seconds"] > 0
    audit = {(r["table_name"], r["action"]): r["row_count"]
             for r in spark.read.parquet(latest_manifest(spark, wh)[("audit", "merge_audit")]).collect()}
    assert audit[("orders", "updated")] == changed and audit[("orders", "unchanged")] == n - changed

    bad = f"{scratch}/bad"
    for t in SOURCE_TABLES:
        df = spark.read.parquet(f"{days[0]}/{t}")
        (df.filter("order_id <> '1'") if t == "orders" else df).write.parquet(f"{bad}/{t}")
    with pytest.raises(QualityError):
        run_elt(spark, bad, wh, "2024-06-03", "r3")
    failed = read_step_log(spark, wh).filter("run_id = 'r3' AND status = 'Failed'").collect()
    assert [r["step"] for r in failed] == ["landing checks"] and "foreign key" in failed[0]["error"]


def test_clusters_are_stored_and_appended(spark, scratch, days):
    wh = f"{scratch}/wh"
    ddl = "customer_id string, cluster_label string, model_version string, assigned_date date"
    from datetime import date
    v1 = spark.createDataFrame([("a", "low", "v1", date(2024, 6, 1)), ("b", "high", "v1", date(2024, 6, 1))], ddl)
    v2 = spark.createDataFrame([("a", "low", "v1", date(2024, 6, 3)), ("a", "high", "v2", date(2024, 6, 3))], ddl)
    run_elt(spark, days[0], wh, "2024-06-01", "r1", clusters=v1)
    run_elt(spark, days[0], wh, "2024-06-02", "r2")
    run_elt(spark, days[0], wh, "2024-06-03", "r3", clusters=v2)
    m = latest_manifest(spark, wh)
    labels = spark.read.parquet(m[("final", "dim_cluster")]).collect()
    assert sorted((r["cluster_label"], r["model_version"], str(r["assigned_date"])) for r in labels) == [
        ("high", "v1", "2024-06-01"), ("high", "v2", "2024-06-03"), ("low", "v1", "2024-06-01")]
    assert len(m[("final", "cluster_assignment")]) == 2
    rows = spark.read.parquet(*m[("final", "cluster_assignment")]).collect()
    assert len(rows) == 4 and {r["cluster_id"] for r in rows} <= {r["cluster_id"] for r in labels}


def test_of_two_publishers_one_raises_and_nothing_is_damaged(spark, scratch):
    wh = f"{scratch}/wh"
    publish_manifest(spark, wh, "r0", "2024-01-01 00:00:00", {("stg", "orders"): "p0"})
    for k in range(1, 5):
        start, failed = threading.Barrier(2), []

        def publish(who, k=k, start=start, failed=failed):
            start.wait()
            try:
                publish_manifest(spark, wh, f"r{k}{who}", f"2024-01-0{k + 1} 00:00:00",
                                 {("stg", "orders"): f"p{k}{who}", ("stg", "sellers"): f"s{k}{who}"}, after=k)
            except ManifestError:
                failed.append(who)
        both = [threading.Thread(target=publish, args=(w,)) for w in "ab"]
        for t in both:
            t.start()
        for t in both:
            t.join()
        assert len(failed) == 1
        winner = "b" if failed == ["a"] else "a"
        assert latest_manifest(spark, wh) == {("stg", "orders"): f"p{k}{winner}", ("stg", "sellers"): f"s{k}{winner}"}


def test_run_timestamps_are_compared_as_times(spark, scratch, days):
    wh = f"{scratch}/wh"
    run_elt(spark, days[0], wh, "2024-06-10", "r1", validate=False)
    with pytest.raises(ValueError, match="does not follow"):
        run_elt(spark, days[0], wh, "2024-6-9 23:59", "r2", validate=False)
    with pytest.raises(ValueError, match="not a timestamp"):
        run_elt(spark, days[0], wh, "tomorrow", "r2", validate=False)
