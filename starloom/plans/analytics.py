"""Reports the warehouse's own requirements ask for: segment movement across
model runs, sales by the customer's current location, on-time delivery by
the destination state at order time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.aggregates import MONEY
from ..operators.lookup import current_version_attributes, lookup_as_of


def segment_transitions(assignments: DataFrame, dim_customer: DataFrame, label: str = "cluster_label", run: str = "model_version",
                        run_date: str = "assigned_date") -> DataFrame:
    """Customers moving from one segment to another between consecutive model
    runs of the same customer, over the whole assignment history. An assignment
    points at a version of the customer; versions meet on the natural key, so a
    customer who got a new version in between is still one customer.

    The window is partitioned by customer: the table holds one row per
    customer per model run, so a partition never exceeds the number of runs.
    """
    w = Window.partitionBy("customer_nk").orderBy(run_date, run)
    named = assignments.join(dim_customer.select("customer_id", "customer_nk"), "customer_id")
    moves = named.select(
        "customer_nk", F.col(run).alias("to_model_version"), F.col(label).alias("to_label"),
        F.lag(label).over(w).alias("from_label"), F.lag(run).over(w).alias("from_model_version"))
    return (moves.filter(F.col("from_label").isNotNull())
            .groupBy("from_model_version", "to_model_version", "from_label", "to_label")
            .agg(F.count(F.lit(1)).cast("bigint").alias("customer_count")))


def sales_by_current_attribute(fact: DataFrame, version_col: str, measure: str,
                               dim: DataFrame, dim_sk: str, dim_nk: str,
                               attr: str) -> DataFrame:
    """Sum a measure by an attribute of the *Current* version, whichever
    version each fact row points to. Facts are first pre-aggregated per
    version key, so only one row per version reaches the dimension joins. Facts
    without a Current version are summed under 'Unknown': totals reconcile."""
    per_version = fact.groupBy(version_col).agg(F.sum(F.col(measure).cast(MONEY)).alias("__m"))
    return (current_version_attributes(per_version, version_col, dim, dim_sk, dim_nk, [attr])
            .groupBy(F.coalesce(attr, F.lit("Unknown")).alias(attr)).agg(F.sum("__m").cast("double").alias(f"total_{measure}")))


def on_time_by_state(stg_orders: DataFrame, stg_customers: DataFrame,
                     dim_customer_history: DataFrame) -> DataFrame:
    """Order counts per (customer state at purchase time, delivery status)."""
    d = X.parse_ts("order_delivered_customer_date")
    e = X.parse_ts("order_estimated_delivery_date")
    o = (stg_orders.select("order_id", "customer_id",
                           X.parse_ts("order_purchase_timestamp").alias("purchased"),
                           X.delivery_status(d, e).alias("delivery_status"))
         .join(stg_customers.select("customer_id", "customer_unique_id"), "customer_id"))
    v = lookup_as_of(o.drop("customer_id"), "customer_unique_id", "purchased",
                     dim_customer_history, "customer_nk", "customer_id", "__ver", how="inner",
                     attrs=("customer_state",))
    return (v.groupBy("customer_state", "delivery_status")
            .agg(F.count(F.lit(1)).cast("bigint").alias("order_count")))
