"""Fact builders: order items, payments, reviews (transaction facts) and
delivery (accumulating snapshot).

Join order is chosen for scale: the customer chain (orders -> staging
customers -> Current customer version) is resolved once at order grain, and
the largest table (items) is shuffled once, on ``order_id``. Seller and
product key maps are small per-key tables; AQE broadcasts them when their
measured size is under the threshold and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.aggregates import MONEY, order_sellers, order_totals
from ..operators.lookup import current_key_map, lookup_date, lookup_dates
from ..operators.merge import latest_per_key
from ..schemas import ORDER_TIMESTAMPS


def order_customer_keys(stg_orders: DataFrame, stg_customers: DataFrame,
                        dim_customer: DataFrame) -> DataFrame:
    """Per order: status, text timestamps and the Current customer surrogate.
    Orders whose customer has no Current version are dropped (inner joins).

    All four facts need it: a run stores it once (bucketed like the orders'
    children, if those are) and hands it to the builders as ``order_keys``."""
    c = stg_customers.select("customer_id", "customer_unique_id")
    dc = current_key_map(dim_customer, "customer_nk", "customer_id", "customer_unique_id",
                         "customer_sk")
    return (stg_orders.select("order_id", "customer_id", "order_status", *ORDER_TIMESTAMPS)
            .join(c, on="customer_id", how="inner")
            .join(dc, on="customer_unique_id", how="inner")
            .drop("customer_id", "customer_unique_id"))


def seller_key_map(dim_seller: DataFrame, stg_sellers: DataFrame | None, key: str = "seller_id") -> DataFrame:
    """staging seller id -> Current seller surrogate, existence-checked against staging
    unless that is None: a run that has checked the foreign keys need not do it again."""
    keys = current_key_map(dim_seller, "seller_nk", "seller_id", key, "seller_sk")
    if stg_sellers is None:
        return keys
    return keys.join(stg_sellers.select(F.col("seller_id").alias(key)), on=key, how="left_semi")


def product_key_map(dim_product: DataFrame, stg_products: DataFrame | None) -> DataFrame:
    keys = dim_product.select(F.col("product_nk").alias("product_id"), F.col("product_id").alias("product_sk"))
    if stg_products is None:
        return keys
    return keys.join(stg_products.select("product_id"), on="product_id", how="left_semi")


def item_product_keys(items: DataFrame, keys: DataFrame) -> DataFrame:
    """(order_id, order_item_id, product_sk) of the items that have a product in ``keys``."""
    return (items.select("order_id", "order_item_id", "product_id").join(keys, on="product_id", how="inner")
            .drop("product_id"))


def _keys_of(order_keys: DataFrame | None, stg_orders, stg_customers, dim_customer) -> DataFrame:
    return order_keys if order_keys is not None else order_customer_keys(stg_orders, stg_customers, dim_customer)


def build_fct_order_items(stg_order_items, stg_orders, stg_customers, dim_customer, stg_sellers,
                          dim_seller, stg_products, dim_product, dim_date,
                          order_keys: DataFrame | None = None,
                          item_products: DataFrame | None = None) -> DataFrame:
    """One row per order item with Current customer/seller, product and purchase date.
    Products are looked up first: where their keys are too many to broadcast, items are dealt
    out by product while they are narrow, and the fact lies by order. ``item_products``:
    ``item_product_keys`` of items with unique keys, if stored already."""
    orders = _keys_of(order_keys, stg_orders, stg_customers, dim_customer) \
        .select("order_id", "order_status", "order_purchase_timestamp", "customer_sk")
    orders = lookup_date(orders, X.parse_ts("order_purchase_timestamp"), "purchase_date_id", dim_date) \
        .drop("order_purchase_timestamp")
    items = stg_order_items.select(*ITEM_COLUMNS)
    if item_products is None:
        f = items.join(product_key_map(dim_product, stg_products), on="product_id", how="inner").drop("product_id")
    else:
        f = items.drop("product_id").join(item_products, on=["order_id", "order_item_id"], how="inner")
    f = (f.join(orders, on="order_id", how="inner")
         .join(seller_key_map(dim_seller, stg_sellers), on="seller_id", how="inner"))
    return f.select(
        X.surrogate_key("order_id", "order_item_id").alias("order_item_id"),
        "purchase_date_id",
        F.col("product_sk").alias("product_id"),
        F.col("customer_sk").alias("customer_id"),
        F.col("seller_sk").alias("seller_id"),
        F.col("order_id").alias("order_nk"),
        F.col("order_item_id").alias("order_item_sequence"),
        "order_status", "price", "freight_value")


def build_fct_order_payments(stg_order_payments, stg_orders, stg_customers, dim_customer,
                             dim_date, order_keys: DataFrame | None = None) -> DataFrame:
    """One row per payment; ``expected_order_value`` is the order's payment
    total and ``discount_amount`` that total minus this payment."""
    orders = _keys_of(order_keys, stg_orders, stg_customers, dim_customer) \
        .select("order_id", "order_approved_at", "customer_sk")
    orders = lookup_date(orders, X.parse_ts("order_approved_at"), "approval_date_id", dim_date) \
        .drop("order_approved_at")
    p = stg_order_payments.select("order_id", "payment_sequential", "payment_type",
                                  "payment_installments", "payment_value")
    f = (p.join(orders, on="order_id", how="inner")
         .join(order_totals(p), on="order_id", how="left"))
    total = F.col("total_order_value")
    return f.select(
        X.surrogate_key("order_id", "payment_sequential").alias("payment_id"),
        "approval_date_id",
        F.col("customer_sk").alias("customer_id"),
        F.col("order_id").alias("order_nk"),
        "payment_type", "payment_sequential", "payment_value", "payment_installments",
        total.cast("double").alias("expected_order_value"),
        (total - F.col("payment_value").cast(MONEY)).cast("double").alias("discount_amount"))


def build_fct_order_reviews(stg_order_reviews, stg_orders, stg_customers, dim_customer,
                            dim_date, dedupe: bool = True,
                            order_keys: DataFrame | None = None) -> DataFrame:
    """One row per (review, order): the latest by ``updated_at``, or with
    ``dedupe=False`` the rows as they are, for a table whose key is already
    unique (a staging table after its merge). Text measures are computed before any
    shuffle, so only their small results (not the review text) move."""
    r = stg_order_reviews.select(
        "review_id", "order_id", "review_score", "review_creation_date",
        X.text_length("review_comment_message").alias("review_length_chars"),
        X.comment_status("review_comment_message").alias("comment_status"),
        *(["updated_at"] if dedupe else []))
    if dedupe:
        r = latest_per_key(r, ["review_id", "order_id"], [("updated_at", "desc")])
    orders = _keys_of(order_keys, stg_orders, stg_customers, dim_customer) \
        .select("order_id", "order_status", "order_purchase_timestamp", "customer_sk")
    f = r.join(orders, on="order_id", how="inner")
    f = lookup_date(f, X.parse_ts("review_creation_date"), "review_date_id", dim_date)
    return f.select(
        X.surrogate_key("review_id", "order_id").alias("review_id"),
        "review_date_id",
        F.col("customer_sk").alias("customer_id"),
        F.col("review_id").alias("review_nk"),
        F.col("order_id").alias("order_nk"),
        "order_status", "review_score",
        X.sentiment_score("review_score").alias("sentiment_score"),
        "review_length_chars",
        X.review_severity("review_score").alias("review_severity"),
        "comment_status",
        X.days_between(X.parse_ts("review_creation_date"),
                       X.parse_ts("order_purchase_timestamp")).alias("days_since_purchase"))


DATE_ROLES = {
    "purchase_date_id": "order_purchase_timestamp",
    "approval_date_id": "order_approved_at",
    "carrier_handoff_date_id": "order_delivered_carrier_date",
    "estimated_delivery_date_id": "order_estimated_delivery_date",
    "actual_delivery_date_id": "order_delivered_customer_date",
}


def build_fct_order_delivery(stg_orders, stg_customers, dim_customer, stg_order_items,
                             stg_sellers, dim_seller, dim_date,
                             order_keys: DataFrame | None = None) -> DataFrame:
    """Accumulating snapshot, one row per order that has items: five
    role-playing dates, first (lexically smallest) seller, multi-seller flag,
    whole-day durations between milestones, on-time status and lateness."""
    orders = _keys_of(order_keys, stg_orders, stg_customers, dim_customer)
    ts = {c: X.parse_ts(c) for c in ORDER_TIMESTAMPS}
    f = (orders.join(order_sellers(stg_order_items), on="order_id", how="inner")
         .join(seller_key_map(dim_seller, stg_sellers, "first_seller_id"),
               on="first_seller_id", how="inner"))
    f = f.select("*", *[ts[c].alias("__ts_" + c) for c in ORDER_TIMESTAMPS])
    f = lookup_dates(f, {k: "__ts_" + v for k, v in DATE_ROLES.items()}, dim_date)
    t = {c: F.col("__ts_" + c) for c in ORDER_TIMESTAMPS}
    delivered, estimated = t["order_delivered_customer_date"], t["order_estimated_delivery_date"]
    return f.select(
        X.surrogate_key("order_id").alias("delivery_id"),
        *DATE_ROLES.keys(),
        F.col("customer_sk").alias("customer_id"),
        F.col("seller_sk").alias("seller_id"),
        F.col("order_id").alias("order_nk"),
        "order_status",
        X.multi_seller_label("first_seller_id", "last_seller_id").alias("multi_seller_order"),
        X.days_between(t["order_approved_at"], t["order_purchase_timestamp"])
        .alias("days_purchase_to_approval"),
        X.days_between(delivered, t["order_approved_at"]).alias("days_approval_to_delivery"),
        X.days_between(delivered, t["order_delivered_carrier_date"])
        .alias("days_carrier_handoff_to_delivery"),
        X.days_between(delivered, estimated).alias("days_estimated_to_actual"),
        X.delivery_status(delivered, estimated).alias("delivery_status"),
        X.late_severity(delivered, estimated).alias("late_severity"))


# Columns of the items that their fact uses, and of the orders that each fact uses.
ITEM_COLUMNS = ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
ORDER_COLUMNS = {
    "fct_order_items": ("order_status", "order_purchase_timestamp"),
    "fct_order_payments": ("order_approved_at",),
    "fct_order_reviews": ("order_status", "order_purchase_timestamp"),
    "fct_order_delivery": ("order_status", *ORDER_TIMESTAMPS),
}

FACT_KEYS = {
    "fct_order_items": (("order_nk", "order_item_sequence"), "order_item_id"),
    "fct_order_payments": (("order_nk", "payment_sequential"), "payment_id"),
    "fct_order_reviews": (("review_nk", "order_nk"), "review_id"),
    "fct_order_delivery": (("order_nk",), "delivery_id"),
}
