"""Per-key aggregates used by dimensions and facts.

All are ``groupBy().agg()`` with partial (map-side) aggregation, so a key
that holds a large share of the rows is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def zip_centroid(geo: DataFrame, zip_col: str = "geolocation_zip_code_prefix",
                 lat: str = "geolocation_lat", lng: str = "geolocation_lng") -> DataFrame:
    """Average latitude/longitude per zip prefix (computed once, reused by
    every dimension that needs it)."""
    return geo.groupBy(zip_col).agg(F.avg(lat).alias(lat), F.avg(lng).alias(lng))


def order_totals(payments: DataFrame, key: str = "order_id",
                 value: str = "payment_value") -> DataFrame:
    """Sum of payment values per order, in exact decimal."""
    return payments.groupBy(key).agg(F.sum(F.col(value).cast(MONEY)).alias("total_order_value"))


def order_sellers(items: DataFrame, key: str = "order_id", seller: str = "seller_id",
                  with_count: bool = False) -> DataFrame:
    """Per order: lexical minimum seller ("first seller") and maximum seller.
    ``min <> max`` answers "more than one seller" in a single shuffle; the
    exact distinct count is added only on request."""
    aggs = [F.min(seller).alias("first_seller_id"), F.max(seller).alias("last_seller_id")]
    if with_count:
        aggs.append(F.countDistinct(seller).cast("int").alias("seller_count"))
    return items.groupBy(key).agg(*aggs)
