"""Dimension builders: customer and seller (type 2), product (type 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import zip_centroid
from ..operators.scd import scd1_merge, scd2_merge
from ..schemas import DIM_PRODUCT_ATTRS, SCD2_CUSTOMER_TRACKED, SCD2_SELLER_TRACKED

_AUDIT = "created_at timestamp_ntz, updated_at timestamp_ntz"
DIM_CUSTOMER_DDL = ("customer_id string, customer_nk string, customer_city string, "
                    "customer_state string, customer_latitude double, customer_longitude double, "
                    f"valid_from date, valid_to date, current_flag string, {_AUDIT}")
DIM_SELLER_DDL = DIM_CUSTOMER_DDL.replace("customer_", "seller_")
DIM_PRODUCT_DDL = ("product_id string, product_nk string, product_category_name string, "
                   "product_category_name_english string, product_weight_g double, "
                   f"product_length_cm double, product_height_cm double, product_width_cm double, "
                   f"{_AUDIT}")
DIM_CLUSTER_DDL = ("cluster_id string, cluster_label string, model_version string, "
                   f"assigned_date date, {_AUDIT}")
CLUSTER_ASSIGNMENT_DDL = ("assignment_id string, customer_id string, cluster_id string, "
                          f"model_version string, assigned_date date, {_AUDIT}")


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """An empty table of the given schema (state before the first run)."""
    return spark.createDataFrame([], ddl)


def attach_geo(df: DataFrame, zip_col: str, stg_geolocation: DataFrame,
               lat_col: str, lng_col: str) -> DataFrame:
    """Left join of the zip centroid (lat/lng NULL for an unknown zip)."""
    geo = zip_centroid(stg_geolocation).select(
        F.col("geolocation_zip_code_prefix").alias("__zip"),
        F.col("geolocation_lat").alias(lat_col), F.col("geolocation_lng").alias(lng_col))
    return left_join_non_null(df, geo, zip_col, "__zip")


def left_join_non_null(df: DataFrame, small: DataFrame, key: str, small_key: str) -> DataFrame:
    """Left join in which rows with a NULL key, which cannot match, stay out of
    the shuffle instead of meeting on one key."""
    known = df.filter(F.col(key).isNotNull()).join(small, F.col(key) == F.col(small_key), "left").drop(small_key)
    return known.unionByName(df.filter(F.col(key).isNull()), allowMissingColumns=True)


def customer_source(stg_customers: DataFrame, stg_geolocation: DataFrame) -> DataFrame:
    """Staging customers with their zip centroid, under dimension column names."""
    s = stg_customers.select(
        F.col("customer_unique_id").alias("customer_nk"), "customer_city", "customer_state",
        "customer_zip_code_prefix", "updated_at", F.col("customer_id").alias("staging_key"))
    return attach_geo(s, "customer_zip_code_prefix", stg_geolocation, "customer_latitude",
                      "customer_longitude").select(
        "customer_nk", "customer_city", "customer_state", "customer_latitude",
        "customer_longitude", "updated_at", "staging_key")


def seller_source(stg_sellers: DataFrame, stg_geolocation: DataFrame) -> DataFrame:
    s = stg_sellers.select(F.col("seller_id").alias("seller_nk"), "seller_city", "seller_state",
                           "seller_zip_code_prefix")
    return attach_geo(s, "seller_zip_code_prefix", stg_geolocation, "seller_latitude",
                      "seller_longitude").select(
        "seller_nk", "seller_city", "seller_state", "seller_latitude", "seller_longitude")


def build_dim_customer(dim_customer: DataFrame, stg_customers: DataFrame,
                       stg_geolocation: DataFrame, run_ts, match: str = "latest") -> DataFrame:
    """Type 2 customer dimension keyed by ``customer_unique_id``. Several
    staging customers may share it; the latest staged one (ties: lowest
    staging key) becomes the new version."""
    return scd2_merge(dim_customer, customer_source(stg_customers, stg_geolocation),
                      "customer_nk", SCD2_CUSTOMER_TRACKED, run_ts, sk_col="customer_id",
                      order=[("updated_at", "desc"), ("staging_key", "asc")], match=match)


def build_dim_seller(dim_seller: DataFrame, stg_sellers: DataFrame, stg_geolocation: DataFrame,
                     run_ts, match: str = "latest") -> DataFrame:
    """Type 2 seller dimension keyed by ``seller_id`` (unique in staging)."""
    return scd2_merge(dim_seller, seller_source(stg_sellers, stg_geolocation), "seller_nk",
                      SCD2_SELLER_TRACKED, run_ts, sk_col="seller_id", order=None, match=match)


def product_source(stg_products: DataFrame, stg_translation: DataFrame) -> DataFrame:
    """Products with their English category name (NULL when untranslated)."""
    t = stg_translation.select(F.col("product_category_name").alias("__category"),
                               "product_category_name_english")
    return (left_join_non_null(stg_products, t, "product_category_name", "__category")
            .select(F.col("product_id").alias("product_nk"), "product_category_name",
                    "product_category_name_english", "product_weight_g", "product_length_cm",
                    "product_height_cm", "product_width_cm"))


def build_dim_product(dim_product: DataFrame, stg_products: DataFrame,
                      stg_translation: DataFrame, run_ts) -> DataFrame:
    """Type 1 product dimension: attributes overwritten in place."""
    return scd1_merge(dim_product, product_source(stg_products, stg_translation), "product_nk",
                      DIM_PRODUCT_ATTRS, run_ts, sk_col="product_id")
