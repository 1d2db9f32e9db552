"""Golden edge rows: one small hand-written table per rule."""

from datetime import date, datetime

from pyspark.sql import functions as F

from helpers import RUN_TS, rows
from starloom.functions import exprs as X
from starloom.functions.calendar import build_dim_date
from starloom.operators.aggregates import order_sellers
from starloom.operators.lookup import lookup_date
from starloom.operators.merge import upsert_changed
from starloom.plans import dims, facts
from starloom.sources.tables import read_csv_table, write_csv_table

T0 = datetime(2024, 1, 1)
T1 = datetime(2024, 6, 1)
STG = "customer_id string, city string, id string, created_at timestamp_ntz, updated_at timestamp_ntz"


def _stg(spark, data):
    return spark.createDataFrame(data, STG)


def test_change_detect_null_rules(spark):
    cur = _stg(spark, [("a", None, "ida", T0, T0), ("b", None, "idb", T0, T0),
                       ("c", "X", "idc", T0, T0)])
    inc = spark.createDataFrame([("a", "A"), ("b", None), ("d", "D")], "customer_id string, city string")
    out = upsert_changed(cur, inc, "customer_id", ["city"], RUN_TS, with_action=True)
    got = {r["customer_id"]: r for r in out.collect()}
    assert got["a"]["updated_at"] == T1 and got["a"]["city"] == "A"        # NULL -> value
    assert got["a"]["merge_action"] == "updated" and got["a"]["created_at"] == T0
    assert got["b"]["updated_at"] == T0 and got["b"]["merge_action"] == "unchanged"  # NULL -> NULL
    assert got["c"]["city"] == "X" and got["c"]["merge_action"] == "kept"   # only in current
    assert got["d"]["created_at"] == T1 and got["d"]["merge_action"] == "inserted"
    assert got["d"]["id"] is not None and got["a"]["id"] == "ida"


DIM = ("customer_id string, customer_nk string, customer_city string, customer_state string, "
       "customer_latitude double, customer_longitude double, valid_from date, valid_to date, "
       "current_flag string, created_at timestamp_ntz, updated_at timestamp_ntz")
STG_C = ("customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
         "customer_city string, customer_state string, id string, created_at timestamp_ntz, "
         "updated_at timestamp_ntz")
GEO = ("geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
       "geolocation_city string, geolocation_state string, id string, "
       "created_at timestamp_ntz, updated_at timestamp_ntz")
D0, EOT = date(2024, 1, 1), date(9999, 12, 31)


def _dim_row(nk, city, lat=1.0, flag="Current", vf=D0, vt=EOT):
    return (f"sk-{nk}-{vf}", nk, city, "S", lat, 1.0, vf, vt, flag, T0, T0)


def _scd2(spark, dim_rows, stg_rows, match="latest"):
    geo = spark.createDataFrame([(1, 1.0, 1.0, "g", "G", "x", T0, T0),
                                 (2, 2.0, 1.0, "g", "G", "y", T0, T0)], GEO)
    return dims.build_dim_customer(spark.createDataFrame(dim_rows, DIM),
                                   spark.createDataFrame(stg_rows, STG_C), geo, RUN_TS, match)


def test_scd2_rules(spark):
    dim_rows = [_dim_row("move", "A"), _dim_row("geo", "C"), _dim_row("same", "E"),
                _dim_row("twice", "A"),
                _dim_row("back", "Z", flag="Expired", vf=date(2023, 1, 1), vt=D0),
                _dim_row("absent", "Q")]
    stg = [("1", "new", 1, "N", "S", "i1", T0, T0),
           ("2", "move", 1, "B", "S", "i2", T0, T0),
           ("3", "geo", 2, "C", "S", "i3", T0, T0),           # same city, lat 1 -> 2
           ("4", "same", 1, "E", "S", "i4", T0, T0),
           ("5", "twice", 1, "A", "S", "i5", T0, T0),         # two addresses, equal ts
           ("6", "twice", 1, "B", "S", "i6", T0, T0),
           ("7", "back", 1, "Z", "S", "i7", T0, T0)]
    out = _scd2(spark, dim_rows, stg)
    cur = {r["customer_nk"]: r for r in out.filter("current_flag = 'Current'").collect()}
    assert cur["new"]["valid_to"] == EOT and cur["new"]["valid_from"] == date(2024, 6, 1)
    assert cur["move"]["customer_city"] == "B"
    old = out.filter("customer_nk = 'move' AND current_flag = 'Expired'").collect()
    assert len(old) == 1 and old[0]["valid_to"] == date(2024, 6, 1) and old[0]["customer_city"] == "A"
    assert cur["geo"]["customer_latitude"] == 2.0 and cur["geo"]["valid_from"] == date(2024, 6, 1)
    assert cur["same"]["valid_from"] == D0 and cur["same"]["updated_at"] == T0
    # tie on updated_at: lowest staging key ('5', city A) wins -> unchanged under 'latest'
    assert cur["twice"]["valid_from"] == D0
    assert cur["back"]["valid_from"] == date(2024, 6, 1)       # only Expired rows existed
    assert cur["absent"]["valid_from"] == D0                   # missing from source: stays
    assert out.filter("customer_nk = 'back' AND current_flag = 'Expired'").count() == 1
    # 'any': the second address differs, so the version is expired and re-inserted
    any_out = _scd2(spark, dim_rows, stg, match="any")
    assert any_out.filter("customer_nk = 'twice'").count() == 2
    assert any_out.filter("customer_nk = 'twice' AND current_flag = 'Current'").first()["valid_from"] \
        == date(2024, 6, 1)


def test_scd1_and_translation(spark):
    cur = spark.createDataFrame(
        [("p1", "p1", "TOYS", "toys", 1.0, 1.0, 1.0, 1.0, T0, T0)], dims.DIM_PRODUCT_DDL)
    products = spark.createDataFrame(
        [("p1", "GAMES", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), ("p2", "NEW", *[1.0] * 7)],
        "product_id string, product_category_name string, product_name_lenght double, "
        "product_description_lenght double, product_photos_qty double, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double")
    tr = spark.createDataFrame([("GAMES", "games")], "product_category_name string, "
                               "product_category_name_english string")
    out = {r["product_nk"]: r for r in dims.build_dim_product(cur, products, tr, RUN_TS).collect()}
    assert len(out) == 2
    assert out["p1"]["product_category_name_english"] == "games" and out["p1"]["updated_at"] == T1
    assert out["p2"]["product_category_name_english"] is None


def test_unknown_dates_and_truncation(spark):
    dd = build_dim_date(spark)
    df = spark.createDataFrame([(1, None), (2, "1997-12-31 10:00:00"), (3, "2078-01-01 00:00:00"),
                                (4, "2000-02-29 23:59:59"), (5, "2001-03-04")],
                               "k int, t string")
    got = dict(rows(lookup_date(df, X.parse_ts("t"), "d", dd), "k", "d"))
    assert got == {1: -1, 2: -1, 3: -1, 4: 20000229, 5: 20010304}
    base = datetime(2020, 1, 10)
    diffs = spark.createDataFrame([(base, datetime(2020, 1, 10, 5)), (base, datetime(2020, 1, 9, 1)),
                                   (base, datetime(2020, 1, 7, 23))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in diffs.select(X.days_between("a", "b")).collect()] == [0, 0, 2]


def test_delivery_thresholds(spark):
    e = datetime(2020, 1, 10)
    df = spark.createDataFrame(
        [(1, e, e), (2, datetime(2020, 1, 13), e), (3, datetime(2020, 1, 13, 0, 0, 1), e),
         (4, None, e), (5, datetime(2020, 1, 10, 5), e)], "k int, d timestamp_ntz, e timestamp_ntz")
    got = {r["k"]: (r["s"], r["v"], r["n"]) for r in df.select(
        "k", X.delivery_status("d", "e").alias("s"), X.late_severity("d", "e").alias("v"),
        X.days_between("d", "e").alias("n")).collect()}
    assert got[1][:2] == ("On Time", "On Time")
    assert got[2][:2] == ("Late", "Within Threshold")
    assert got[3][:2] == ("Late", "Significantly Late")
    assert got[4] == (None, None, None)
    assert got[5] == ("Late", "Within Threshold", 0)


def test_sellers_and_payments(spark):
    items = spark.createDataFrame([("o1", "s1"), ("o1", "s1"), ("o2", "s1"), ("o2", "s2"),
                                   ("o3", "10"), ("o3", "9")], "order_id string, seller_id string")
    s = {r["order_id"]: r for r in order_sellers(items, with_count=True).collect()}
    assert s["o1"]["seller_count"] == 1 and s["o2"]["seller_count"] == 2
    assert s["o3"]["first_seller_id"] == "10"                      # lexical minimum
    labels = {r[0]: r[1] for r in order_sellers(items).select(
        "order_id", X.multi_seller_label("first_seller_id", "last_seller_id")).collect()}
    assert labels == {"o1": "Single Seller", "o2": "Multi Seller", "o3": "Multi Seller"}


def test_payments_expected_and_discount(spark):
    pay = spark.createDataFrame([("o", 1, "credit_card", 1, 60.0), ("o", 2, "voucher", 1, 40.0)],
                                "order_id string, payment_sequential int, payment_type string, "
                                "payment_installments int, payment_value double")
    orders = spark.createDataFrame([("o", "c", "delivered", "2020-01-01 00:00:00", "2020-01-02 00:00:00",
                                     None, None, None)],
                                   "order_id string, customer_id string, order_status string, "
                                   "order_purchase_timestamp string, order_approved_at string, "
                                   "order_delivered_carrier_date string, "
                                   "order_delivered_customer_date string, "
                                   "order_estimated_delivery_date string")
    cust = spark.createDataFrame([("c", "n")], "customer_id string, customer_unique_id string")
    dim = spark.createDataFrame([_dim_row("n", "A")], DIM)
    out = facts.build_fct_order_payments(pay, orders, cust, dim, build_dim_date(spark))
    got = rows(out, "payment_sequential", "expected_order_value", "discount_amount", "approval_date_id")
    assert got == [(1, 100.0, 40.0, 20200102), (2, 100.0, 60.0, 20200102)]


def test_review_measures(spark):
    df = spark.createDataFrame([(1, None), (2, "   "), (3, "ok"), (4, None), (5, "x"), (None, "y")],
                               "score int, msg string")
    got = rows(df.select("score", X.sentiment_score("score").alias("s"),
                         X.review_severity("score").alias("v"),
                         X.text_length("msg").alias("n"), X.comment_status("msg").alias("c")))
    assert got == [(1, -1.0, "Critical", 0, "No Comment"), (2, -1.0, "Critical", 3, "No Comment"),
                   (3, 0.0, "Standard", 2, "Has Comment"), (4, 1.0, "Standard", 0, "No Comment"),
                   (5, 1.0, "Standard", 1, "Has Comment"), (None, 0.0, "Standard", 1, "Has Comment")]


def test_calendar_edges(spark):
    dd = build_dim_date(spark)
    days = [1, 2, 3, 11, 12, 13, 21, 22, 23, 31]
    got = {r["date_actual"].day: r["day_suffix"] for r in
           dd.filter(F.col("date_actual").isin([date(2001, 1, d) for d in days])).collect()}
    assert [got[d] for d in days] == ["1st", "2nd", "3rd", "11th", "12th", "13th", "21st",
                                      "22nd", "23rd", "31st"]
    r = dd.filter(F.col("date_id") == 20050101).first()
    assert (r["week_of_year"], r["week_of_year_iso"], r["first_day_of_week"]) == \
        (53, "2004-W53", date(2004, 12, 27))
    assert dd.count() == 29221
    u = dd.filter("date_id = -1").first()
    assert u["day_name"] == "Unknown" and u["date_actual"] == date(1900, 1, 1)


def test_csv_round_trip(spark, scratch):
    schema = "k int, msg string"
    text = 'He said "hi", then\nleft;  trailing  '
    df = spark.createDataFrame([(1, text), (2, "   "), (3, None)], schema)
    write_csv_table(df, f"{scratch}/t")
    from pyspark.sql import types as T
    back = read_csv_table(spark, f"{scratch}/t", T._parse_datatype_string(schema))
    assert rows(back) == [(1, text), (2, "   "), (3, None)]


def test_as_of_lookup_rules(spark):
    from starloom.operators.lookup import lookup_as_of
    dim = spark.createDataFrame([
        ("v1", "n", date(2020, 1, 1), date(2020, 6, 1)),
        ("v2", "n", date(2020, 6, 1), date(2020, 6, 1)),     # changed twice on one day
        ("v3", "n", date(2020, 6, 1), date(9999, 12, 31)),
        ("w1", "m", date(2021, 1, 1), date(9999, 12, 31))],
        "sk string, nk string, valid_from date, valid_to date")
    facts = spark.createDataFrame([(1, "n", datetime(2019, 3, 1)), (2, "n", datetime(2020, 5, 31, 23)),
                                   (3, "n", datetime(2020, 6, 1)), (4, "m", datetime(2020, 12, 31)),
                                   (5, "x", datetime(2020, 1, 1))], "k int, key string, t timestamp_ntz")
    got = rows(lookup_as_of(facts, "key", "t", dim, "nk", "sk", "ver"), "k", "ver")
    # before the first load date -> first version; boundary day -> the new version;
    # the empty same-day version never matches; unknown key stays (left join)
    assert got == [(1, "v1"), (2, "v1"), (3, "v3"), (4, "w1"), (5, None)]
