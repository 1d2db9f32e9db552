"""Runs as repeated, restartable jobs; constraints that stop a run."""

import os
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.operators.quality import QualityError
from starloom.operators.scd import scd2_merge
from starloom.plans import dims
from starloom.plans.warehouse import (ManifestError, dimension_checks, fact_checks, landing_checks,
                                      latest_manifest, publish_manifest, read_dimension, run_elt)
from starloom.schemas import SOURCE_TABLES
from starloom.sources.adapters import write_source_extract
from starloom.sources.tables import scan_sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def extract(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("extract"))
    write_source_extract(spark, SF, path)
    return path


def test_repeats_failures_and_damage(spark, scratch, extract, monkeypatch):
    wh = f"{scratch}/wh"
    run_elt(spark, extract, wh, "2024-06-01 00:00:00", "r1")
    before = latest_manifest(spark, wh)
    rows = {k: spark.read.parquet(*([p] if isinstance(p, str) else p)).count() for k, p in before.items()}
    with pytest.raises(ValueError, match="r1"):
        run_elt(spark, extract, wh, "2024-06-01 00:00:00", "r1")  # published already
    with pytest.raises(ValueError, match="does not follow"):
        run_elt(spark, extract, wh, "2024-05-01 00:00:00", "r0")  # older than the published run
    import starloom.plans.warehouse as w
    with monkeypatch.context() as m:  # fails just before it publishes
        m.setattr(w, "publish_manifest", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_elt(spark, extract, wh, "2024-06-02 00:00:00", "r2")
    assert latest_manifest(spark, wh) == before
    assert {k: spark.read.parquet(*([p] if isinstance(p, str) else p)).count()
            for k, p in before.items()} == rows
    run_elt(spark, extract, wh, "2024-06-02 00:00:00", "r2")  # the failed id may be repeated
    assert read_dimension(spark, wh, "dim_customer").count() == rows[("final", "dim_customer")]
    folder = f"{wh}/_manifests/000000002"
    part = next(f for f in os.listdir(folder) if f.startswith("part-"))
    lines = open(f"{folder}/{part}").read().splitlines()
    os.remove(f"{folder}/.{part}.crc")
    for damaged in ("{broken", "\n".join(lines[:1])):
        with open(f"{folder}/{part}", "w") as f:
            f.write(damaged)
        with pytest.raises(Exception) as e:
            run_elt(spark, extract, wh, "2024-06-03 00:00:00", "r3")
        assert isinstance(e.value, ManifestError) or "MALFORMED" in str(e.value).upper()


def test_eleven_runs_are_ordered_by_number(spark, scratch):
    wh = f"{scratch}/wh"
    assert latest_manifest(spark, wh) == {}
    for i in range(1, 12):
        publish_manifest(spark, wh, f"r{i}", f"2024-01-{i:02d} 00:00:00", {("stg", "orders"): f"p{i}"})
    assert latest_manifest(spark, wh) == {("stg", "orders"): "p11"}


def test_an_unlistable_folder_is_an_error(spark):
    with pytest.raises(Exception, match="No FileSystem"):
        latest_manifest(spark, "nosuchscheme://host/wh")


def test_many_increments_are_folded(spark, scratch, extract, monkeypatch):
    import starloom.plans.warehouse as w
    monkeypatch.setattr(w, "MAX_INCREMENTS", 2)
    wh, counts = f"{scratch}/wh", []
    for i in range(1, 5):
        run_elt(spark, extract, wh, f"2024-06-0{i} 00:00:00", f"r{i}", validate=False)
        counts.append(len(latest_manifest(spark, wh)[("final", "dim_seller")]))
    assert counts == [2, 3, 2, 3]


def test_two_changes_on_one_day_and_null_keys(spark):
    dim = dims.empty(spark, dims.DIM_SELLER_DDL)
    cols = "seller_nk string, seller_city string, seller_state string, seller_latitude double, seller_longitude double"
    for hour, city in enumerate("abc"):
        src = spark.createDataFrame([("s1", city, "X", 1.0, 2.0)], cols)
        dim = scd2_merge(dim, src, "seller_nk", ["seller_city"], f"2024-06-01 0{hour}:00:00", "seller_id")
    rows = dim.collect()
    assert len({r["seller_id"] for r in rows}) == 3
    assert sorted(r["current_flag"] for r in rows) == ["Current", "Expired", "Expired"]
    assert {r["valid_from"] for r in rows} == {date(2024, 6, 1)}
    src = spark.createDataFrame([(None, "a", "X", 1.0, 2.0)], cols)
    with pytest.raises(Exception, match="NULL natural key"):
        scd2_merge(dim, src, "seller_nk", ["seller_city"], "2024-06-02 00:00:00", "seller_id").collect()


def _fails(checks):
    with ThreadPoolExecutor(4) as pool:
        empty = list(pool.map(lambda df: df.isEmpty(), checks.values()))
    return {name for name, ok in zip(checks, empty, strict=True) if not ok}


def test_each_constraint_of_the_extract(spark, extract):
    landed = {n: df for n, df in scan_sources(spark, extract).items()}
    assert _fails(landing_checks(landed)) == set()
    first = {n: df.limit(1).cache() for n, df in landed.items()}
    bad = dict(landed)
    bad["orders"] = landed["orders"].unionByName(first["orders"]).unionByName(
        first["orders"].withColumns({"order_id": F.lit("new"), "customer_id": F.lit("nobody"),
                                     "order_approved_at": F.lit("tomorrow")}))
    bad["customers"] = landed["customers"].unionByName(
        first["customers"].withColumns({"customer_id": F.lit("new"), "customer_unique_id": F.lit(None).cast("string"),
                                        "customer_zip_code_prefix": F.lit(-5)}))
    assert _fails(landing_checks(bad)) == {
        "unique key of orders", "foreign key orders(customer_id) to customers",
        "timestamp text orders.order_approved_at", "not null in customers",
        "foreign key customers(customer_zip_code_prefix) to geolocation"}
    assert sum(len(s.foreign_keys) for s in SOURCE_TABLES.values()) == sum(
        c.startswith("foreign key") for c in landing_checks(landed))


def test_a_run_with_a_broken_extract_publishes_nothing(spark, scratch, extract):
    bad = f"{scratch}/bad"
    write_source_extract(spark, SF, bad, clean=False)  # orphan zips and categories
    with pytest.raises(QualityError, match="foreign key"):
        run_elt(spark, bad, f"{scratch}/wh", "2024-06-01 00:00:00", "r1")
    assert latest_manifest(spark, f"{scratch}/wh") == {}


def test_each_constraint_of_dimensions_and_facts(spark):
    dim = {n: spark.createDataFrame([], d) for n, d in (
        ("dim_customer", dims.DIM_CUSTOMER_DDL), ("dim_seller", dims.DIM_SELLER_DDL), ("dim_product", dims.DIM_PRODUCT_DDL))}
    assert _fails(dimension_checks(dim)) == set()
    row = ("k", "s", "c", "st", 0.0, 0.0, date(2024, 1, 1), date(9999, 12, 31), "Current", None, None)
    dim["dim_seller"] = spark.createDataFrame([row, row, ("k2", None, *row[2:])], dims.DIM_SELLER_DDL)
    assert _fails(dimension_checks(dim)) == {"unique surrogate of dim_seller", "not null in dim_seller",
                                             "one Current version in dim_seller"}
    facts = {
        "fct_order_items": spark.createDataFrame([("o", 1), ("o", 1)], "order_nk string, order_item_sequence int"),
        "fct_order_payments": spark.createDataFrame([("o", 1)], "order_nk string, payment_sequential int"),
        "fct_order_reviews": spark.createDataFrame(
            [("r", "o", 6, "Critical", "Maybe")],
            "review_nk string, order_nk string, review_score int, review_severity string, comment_status string"),
        "fct_order_delivery": spark.createDataFrame(
            [("o", "Single Seller", "Lost", None)],
            "order_nk string, multi_seller_order string, delivery_status string, late_severity string"),
    }
    assert _fails(fact_checks(facts)) == {
        "unique key of fct_order_items", "allowed values of fct_order_reviews.comment_status",
        "allowed values of fct_order_delivery.delivery_status", "range of fct_order_reviews.review_score"}
