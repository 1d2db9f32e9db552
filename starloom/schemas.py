"""Declared schemas, keys and change-compare lists of every table.

Nothing is inferred: sources are read with these StructTypes, and each merge
is parameterised by the key and compare lists kept here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()


def _struct(cols: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


@dataclass(frozen=True)
class TableSpec:
    """One source table: schema, primary key, change-compare columns."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    compare: tuple[str, ...]
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


TRANSLATION = TableSpec(
    "product_category_name_translation",
    _struct([("product_category_name", S, False), ("product_category_name_english", S, True)]),
    ("product_category_name",),
    ("product_category_name_english",),
)

PRODUCTS = TableSpec(
    "products",
    _struct([
        ("product_id", S, False), ("product_category_name", S, True),
        ("product_name_lenght", D, True), ("product_description_lenght", D, True),
        ("product_photos_qty", D, True), ("product_weight_g", D, True),
        ("product_length_cm", D, True), ("product_height_cm", D, True), ("product_width_cm", D, True),
    ]),
    ("product_id",),
    ("product_category_name", "product_name_lenght", "product_description_lenght",
     "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
     "product_width_cm"),
    ((("product_category_name",), "product_category_name_translation", ("product_category_name",)),),
)

GEOLOCATION = TableSpec(
    "geolocation",
    _struct([
        ("geolocation_zip_code_prefix", I, False), ("geolocation_lat", D, True),
        ("geolocation_lng", D, True), ("geolocation_city", S, True), ("geolocation_state", S, True),
    ]),
    ("geolocation_zip_code_prefix",),
    ("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"),
)

CUSTOMERS = TableSpec(
    "customers",
    _struct([
        ("customer_id", S, False), ("customer_unique_id", S, True),
        ("customer_zip_code_prefix", I, True), ("customer_city", S, True), ("customer_state", S, True),
    ]),
    ("customer_id",),
    ("customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
    ((("customer_zip_code_prefix",), "geolocation", ("geolocation_zip_code_prefix",)),),
)

SELLERS = TableSpec(
    "sellers",
    _struct([
        ("seller_id", S, False), ("seller_zip_code_prefix", I, True),
        ("seller_city", S, True), ("seller_state", S, True),
    ]),
    ("seller_id",),
    ("seller_zip_code_prefix", "seller_city", "seller_state"),
    ((("seller_zip_code_prefix",), "geolocation", ("geolocation_zip_code_prefix",)),),
)

ORDER_TIMESTAMPS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date")

ORDERS = TableSpec(
    "orders",
    _struct([("order_id", S, False), ("customer_id", S, True), ("order_status", S, True)]
            + [(c, S, True) for c in ORDER_TIMESTAMPS]),
    ("order_id",),
    ("customer_id", "order_status") + ORDER_TIMESTAMPS,
    ((("customer_id",), "customers", ("customer_id",)),),
)

ORDER_ITEMS = TableSpec(
    "order_items",
    _struct([
        ("order_id", S, False), ("order_item_id", I, False), ("product_id", S, True),
        ("seller_id", S, True), ("shipping_limit_date", S, True), ("price", D, True),
        ("freight_value", D, True),
    ]),
    ("order_id", "order_item_id"),
    ("product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
    ((("order_id",), "orders", ("order_id",)),
     (("product_id",), "products", ("product_id",)),
     (("seller_id",), "sellers", ("seller_id",))),
)

ORDER_PAYMENTS = TableSpec(
    "order_payments",
    _struct([
        ("order_id", S, False), ("payment_sequential", I, False), ("payment_type", S, True),
        ("payment_installments", I, True), ("payment_value", D, True),
    ]),
    ("order_id", "payment_sequential"),
    ("payment_type", "payment_installments", "payment_value"),
    ((("order_id",), "orders", ("order_id",)),),
)

ORDER_REVIEWS = TableSpec(
    "order_reviews",
    _struct([
        ("review_id", S, False), ("order_id", S, False), ("review_score", I, True),
        ("review_comment_title", S, True), ("review_comment_message", S, True),
        ("review_creation_date", S, True),
    ]),
    ("review_id", "order_id"),
    ("review_score", "review_comment_title", "review_comment_message", "review_creation_date"),
    ((("order_id",), "orders", ("order_id",)),),
)

# Ingest order: parents before children, so foreign keys can be checked as
# each table lands.
SOURCE_TABLES: dict[str, TableSpec] = {
    t.name: t for t in (TRANSLATION, PRODUCTS, GEOLOCATION, CUSTOMERS, SELLERS,
                        ORDERS, ORDER_ITEMS, ORDER_PAYMENTS, ORDER_REVIEWS)
}

# Audit columns carried by staging rows.
STAGING_AUDIT = ("id", "created_at", "updated_at")

# Fixed values of the warehouse model (must equal the reference's):
CURRENT = "Current"
EXPIRED = "Expired"
END_OF_TIME = "9999-12-31"
UNKNOWN_DATE_ID = -1
DATE_SPINE_START = "1998-01-01"
DATE_SPINE_DAYS = 29220  # 1998-01-01 .. 2077-12-31 inclusive

SCD2_CUSTOMER_TRACKED = ("customer_city", "customer_state", "customer_latitude", "customer_longitude")
SCD2_SELLER_TRACKED = ("seller_city", "seller_state", "seller_latitude", "seller_longitude")
DIM_PRODUCT_ATTRS = ("product_category_name", "product_category_name_english", "product_weight_g",
                     "product_length_cm", "product_height_cm", "product_width_cm")


# Constraints of the model that the schemas above do not carry.
NOT_NULL = {"customers": ("customer_unique_id",)}
TIMESTAMP_TEXTS = {"orders": ORDER_TIMESTAMPS, "order_reviews": ("review_creation_date",)}
DIM_KEYS = {  # surrogate, natural key
    "dim_customer": ("customer_id", "customer_nk"),
    "dim_seller": ("seller_id", "seller_nk"),
    "dim_product": ("product_id", "product_nk"),
}
FACT_DOMAINS = (
    ("fct_order_delivery", "multi_seller_order", ("Single Seller", "Multi Seller")),
    ("fct_order_delivery", "delivery_status", ("On Time", "Late")),
    ("fct_order_delivery", "late_severity", ("On Time", "Within Threshold", "Significantly Late")),
    ("fct_order_reviews", "review_severity", ("Critical", "Standard")),
    ("fct_order_reviews", "comment_status", ("Has Comment", "No Comment")),
)
REVIEW_SCORE_RANGE = (1, 5)
