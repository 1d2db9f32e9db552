"""Registered queries: one per operator of the inventory, each a lazy
DataFrame over the provided tables (via the adapter views).

Scenario: the ``prev_*`` views are the stored state before the run, the
``src_*`` views the incoming extract, and the run timestamp is fixed
(``RUN_TS``), so every result is deterministic and checkable against SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.calendar import build_dim_date
from ..operators import aggregates as A
from ..operators import quality as Q
from ..operators.lookup import lookup_as_of, lookup_current, lookup_date, lookup_dates
from ..operators.merge import (KEPT, append_rows, insert_if_absent, latest_per_key, merge_audit,
                               upsert_overwrite)
from ..operators.scd import current_rows, scd2_replay
from ..schemas import FACT_DOMAINS, ORDER_TIMESTAMPS, SCD2_CUSTOMER_TRACKED, SOURCE_TABLES
from ..session import checkpoint_dir, ensure_utc, join_by_order, shuffles_freed
from ..sources import adapters
from ..sources.tables import land_table, read_csv_table, scan_partitioned, scan_table, write_csv_table
from . import dims, facts
from .analytics import on_time_by_state, sales_by_current_attribute, segment_transitions
from .warehouse import build_facts, load_staging, read_version, write_version

RUN_TS = adapters.RUN_TS
PREV_TS = adapters.PREV_TS
SECOND_TS = "2024-06-01 06:00:00"  # a second run on the same day
#: Keys of a dimension that are sent to the rows that look them up: some 150 bytes each in memory.
SENT_ROWS = 1_250_000
#: Items whose products are looked up in one pass, where products are too many to be sent: some
#: 70 bytes each are on the move at a time.
PASS_ROWS = 32_000_000

STAGING_VIEWS = {
    "product_category_name_translation": ("prev_translation", "src_translation"),
    **{n: (f"prev_{n}", adapters.SOURCE_VIEWS[n]) for n in SOURCE_TABLES
       if n != "product_category_name_translation"},
}
STG_QUERY = {
    "product_category_name_translation": "stg_translation",
    **{n: f"stg_{n}" for n in SOURCE_TABLES if n != "product_category_name_translation"},
}


class Run:
    """Lazy frames of one warehouse run over the adapter views."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_utc(spark)
        join_by_order(spark)
        adapters.register(spark, sf_dir)
        self.spark, self.sf_dir = spark, sf_dir
        t = spark.table
        self.t = t
        self.prev_stg = {n: t(p) for n, (p, _) in STAGING_VIEWS.items()}
        self.src = {n: t(s) for n, (_, s) in STAGING_VIEWS.items()}
        self.stg_audit = load_staging(self.src, self.prev_stg, RUN_TS, with_action=True)
        self.stg = {n: df.drop("merge_action") for n, df in self.stg_audit.items()}
        self.dim_date = build_dim_date(spark)

        self._memo: dict[str, object] = {}

    def _once(self, key: str, build: Callable[[], object]):
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def dim_customer(self, match: str = "latest") -> DataFrame:
        return self._once(f"dim_customer_{match}", lambda: dims.build_dim_customer(
            self.t("prev_dim_customer"), self.stg["customers"], self.stg["geolocation"],
            RUN_TS, match))

    def dim_seller(self) -> DataFrame:
        return self._once("dim_seller", lambda: dims.build_dim_seller(
            self.t("prev_dim_seller"), self.stg["sellers"], self.stg["geolocation"], RUN_TS))

    def dim_product(self) -> DataFrame:
        return self._once("dim_product", lambda: dims.build_dim_product(
            self.t("prev_dim_product"), self.stg["products"],
            self.stg["product_category_name_translation"], RUN_TS))

    def star(self) -> dict[str, DataFrame]:
        return {"dim_date": self.dim_date, "dim_customer": self.dim_customer(),
                "dim_seller": self.dim_seller(), "dim_product": self.dim_product()}

    def _root(self) -> str:
        return self._once("root", lambda: f"{checkpoint_dir(self.spark)}/run-{uuid.uuid4().hex}")

    def by_order(self, name: str, key: str, build: Callable[[], DataFrame | list[DataFrame]],
                 lies: bool = False) -> DataFrame:
        """A frame, or several one after the other, written once, bucketed by its order: what joins, merges or sums it by order
        afterwards, however often, finds each order's rows in one place. ``lies``: the rows
        lie by order already, so they are not dealt out for it."""
        def write() -> DataFrame:
            bucket = (int(self.spark.conf.get("spark.sql.shuffle.partitions")), (key,))
            parts = build()
            for k, df in enumerate(parts if isinstance(parts, list) else [parts]):
                df = df if lies else df.repartition(bucket[0], key)
                with shuffles_freed(self.spark):
                    path = write_version(df, self._root(), "run", name, "v1", bucket, codec="zstd", append=k > 0)
            return read_version(self.spark, path, bucket)
        return self._once(f"by_order_{name}", write)

    def _sent(self, name: str, keys: DataFrame) -> bool:
        """Whether a dimension's stored keys are few enough to be sent to the rows."""
        return self._once(f"sent_{name}", lambda: keys.count() <= SENT_ROWS)

    def _key_dims(self) -> dict[str, DataFrame]:
        """The star with the keys of sellers and products, which items look up: those that
        staging has, written once, and sent to the items if they are few enough."""
        def stored(name: str, keys: DataFrame, staged: DataFrame, nk: str) -> DataFrame:
            def write() -> DataFrame:
                rows = keys.join(staged, F.col(nk) == F.col("__staged"), "left_semi")
                with shuffles_freed(self.spark):
                    out = self.spark.read.parquet(write_version(rows, self._root(), "run", name, "v1"))
                return F.broadcast(out) if self._sent(name, out) else out
            return self._once(f"stored_{name}", write)
        sellers = current_rows(self.dim_seller()).select("seller_nk", "seller_id", "current_flag")
        products = self.dim_product().select("product_nk", "product_id")
        return {**self.star(),
                "dim_seller": stored("dim_seller", sellers, self.stg["sellers"].select(F.col("seller_id").alias("__staged")),
                                     "seller_nk"),
                "dim_product": stored("dim_product", products,
                                      self.stg["products"].select(F.col("product_id").alias("__staged")), "product_nk")}

    def _order_keys(self, keys_of: str) -> DataFrame:
        return self.by_order(f"keys_of_{keys_of}", "order_id", lambda: facts.order_customer_keys(
            self.stg["orders"], self.stg["customers"], self.dim_customer())
            .select("order_id", "customer_sk", *facts.ORDER_COLUMNS[keys_of]))

    def fact(self, name: str, keys_of: str | None = None) -> DataFrame:
        """One fact over this run's staging tables and dimensions. Of the orders, and of payments,
        which are read for their totals too, the columns that it uses are written once; of the
        orders, those that the fact ``keys_of`` uses, if that is given."""
        keys_of = keys_of or name

        def build() -> DataFrame:
            keys = self._order_keys(keys_of)
            stg = dict(self.stg)
            if name == "fct_order_payments":
                stg["order_payments"] = self.by_order("payments", "order_id", lambda: self.stg["order_payments"]
                                                      .select(*SOURCE_TABLES["order_payments"].columns))
            looks_up = name in ("fct_order_items", "fct_order_delivery")
            # Reviews alone depend on ``checked`` otherwise; the stored keys are those that staging has.
            return build_facts(stg, self._key_dims() if looks_up else self.star(), checked=looks_up, order_keys=keys,
                               only=(name,))[name]
        return self._once(f"{name}_{keys_of}", build)

    def facts(self) -> dict[str, DataFrame]:
        """All facts, over one stored set of orders: deliveries use every column that others do."""
        return {n: self.fact(n, keys_of="fct_order_delivery") for n in facts.FACT_KEYS}

    def _items_in_place(self) -> DataFrame:
        """The items fact over narrow items that lie by order, as orders do: it is made anew
        wherever it is read, which moves nothing, instead of being stored with its surrogates.
        Products that are too many to be sent are looked up aside by the item's key, a share of
        them at a time."""
        keys = self._order_keys("fct_order_items")
        dims_ = self._key_dims()
        # Lines are numbered by order, and a merge by (order, line) leaves them there.
        items = self.by_order("items", "order_id", lambda: self.stg["order_items"].select(*facts.ITEM_COLUMNS)
                              .filter("order_id IS NOT NULL"), lies=True)

        def looked_up() -> list[DataFrame]:
            products = facts.product_key_map(dims_["dim_product"], None)
            passes = -(-items.count() // PASS_ROWS) or 1
            share = F.pmod(F.xxhash64("product_id"), F.lit(passes))
            return [facts.item_product_keys(items.filter(share == k), products.filter(share == k)) for k in range(passes)]
        few = self._sent("dim_product", dims_["dim_product"])
        found = None if few else self.by_order("item_products", "order_id", looked_up)
        return build_facts({**self.stg, "order_items": items}, dims_, checked=True, order_keys=keys,
                           only=("fct_order_items",), item_products=found)["fct_order_items"]

    def merge_input(self, name: str) -> DataFrame:
        """The fact as a merge reads it, for its earlier state and for the new one. Payments
        lie by order as they are, and items where sellers can be sent to them; the others are
        written once."""
        if name == "fct_order_payments":
            return self.fact(name)
        if name == "fct_order_items" and self._sent("dim_seller", self._key_dims()["dim_seller"]):
            return self._once("items_in_place", self._items_in_place)
        fact = self.fact(name)
        # Under another name in between: an alias keeps what Spark knows of the rows' places through a union.
        stored = self.by_order(name, "order_id", lambda: fact.withColumnRenamed("order_nk", "order_id"), lies=True)
        return stored.withColumnRenamed("order_id", "order_nk").select(*fact.columns)


_RUNS: dict[tuple[str, int, str], Run] = {}


def run_for(spark: SparkSession, sf_dir: str) -> Run:
    """One Run per (application, session, data dir): the adapter views are
    registered once and the lazy plans reused (DataFrames are immutable)."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    r = _RUNS.get(key)
    if r is None or not spark.catalog.tableExists("src_orders") or \
            _RUNS.get(("last",)) is not r:
        r = Run(spark, sf_dir)
        _RUNS[key] = r
        _RUNS[("last",)] = r  # views registered last belong to this run
    return r


def _q(fn: Callable[[Run], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(run_for(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = _q(fn)
        return fn
    return deco


# ---------------------------------------------------------------- io
@query("scan_table")
def _scan_table(r: Run) -> DataFrame:
    return scan_table(r.spark, f"{r.sf_dir}/orders.parquet")


@query("csv_roundtrip")
def _csv_roundtrip(r: Run) -> DataFrame:
    """Reviews (quotes, commas, newlines in the text) through a header CSV."""
    spec = SOURCE_TABLES["order_reviews"]
    path = f"{checkpoint_dir(r.spark)}/csv-{uuid.uuid4().hex}"
    write_csv_table(r.src["order_reviews"], path)
    return read_csv_table(r.spark, path, spec.schema)


@query("scan_partitioned")
def _scan_partitioned(r: Run) -> DataFrame:
    """Orders read as eight ranges of their text key and the rows without one."""
    path = f"{checkpoint_dir(r.spark)}/ranges-{uuid.uuid4().hex}"
    land_table(r.src["orders"], path)
    return scan_partitioned(r.spark.read.parquet(path), "order_id", 8)


@query("land_table")
def _land_table(r: Run) -> DataFrame:
    path = f"{checkpoint_dir(r.spark)}/landing-{uuid.uuid4().hex}"
    land_table(r.src["customers"], path)
    return r.spark.read.parquet(path)


@query("append_rows")
def _append_rows(r: Run) -> DataFrame:
    """Payments of the earlier state with this run's payments appended."""
    cols = SOURCE_TABLES["order_payments"].columns
    return append_rows(r.prev_stg["order_payments"].select(*cols), r.src["order_payments"])


# ---------------------------------------------------------------- dates
def _orders_ts(r: Run) -> DataFrame:
    return r.src["orders"].select("order_id", *[X.parse_ts(c).alias(c) for c in ORDER_TIMESTAMPS])


@query("dim_date")
def _dim_date(r: Run) -> DataFrame:
    """Every order's purchase day with all calendar attributes (unknown member
    for days outside the calendar)."""
    o = lookup_date(_orders_ts(r), "order_purchase_timestamp", "purchase_date_id", r.dim_date)
    cal = F.broadcast(r.dim_date)
    return o.join(cal, o.purchase_date_id == cal.date_id, "inner").select("order_id", *cal.columns)


@query("unknown_member")
def _unknown_member(r: Run) -> DataFrame:
    """Orders whose approval day resolves to the unknown member."""
    o = lookup_date(_orders_ts(r), "order_approved_at", "approval_date_id", r.dim_date)
    cal = F.broadcast(r.dim_date)
    return (o.filter(F.col("approval_date_id") == -1)
            .join(cal, o.approval_date_id == cal.date_id)
            .select("order_id", "date_id", "date_actual", "day_name", "month_name_abbreviated",
                    "week_of_year_iso", "weekend_indr"))


@query("date_spine")
def _date_spine(r: Run) -> DataFrame:
    """Calendar days on which at least one order was purchased, with ISO week
    attributes (the generated spine semi-joined to the order days)."""
    days = _orders_ts(r).select(F.col("order_purchase_timestamp").cast("date").alias("d"))
    spine = r.dim_date.filter(F.col("date_id") != -1)
    return spine.join(days, spine.date_actual == days.d, "left_semi") \
        .select("date_id", "date_actual", "week_of_year", "week_of_year_iso",
                "first_day_of_week", "last_day_of_week")


@query("date_lookup")
def _date_lookup(r: Run) -> DataFrame:
    return lookup_date(_orders_ts(r), "order_purchase_timestamp", "purchase_date_id",
                       r.dim_date).select("order_id", "purchase_date_id")


@query("role_playing_dates")
def _role_playing(r: Run) -> DataFrame:
    roles = {k: v for k, v in facts.DATE_ROLES.items()}
    return lookup_dates(_orders_ts(r), roles, r.dim_date).select("order_id", *roles)


@query("insert_if_absent")
def _insert_if_absent(r: Run) -> DataFrame:
    """ON CONFLICT DO NOTHING: earlier customers kept as they are (even when
    changed), only new keys added."""
    cols = SOURCE_TABLES["customers"].columns
    return insert_if_absent(r.prev_stg["customers"].select(*cols), r.src["customers"],
                            "customer_id")


# ---------------------------------------------------------------- expressions
@query("parse_timestamps")
def _parse_timestamps(r: Run) -> DataFrame:
    return _orders_ts(r)


@query("days_between")
def _days_between(r: Run) -> DataFrame:
    t = {c: X.parse_ts(c) for c in ORDER_TIMESTAMPS}
    return r.src["orders"].select(
        "order_id",
        X.days_between(t["order_approved_at"], t["order_purchase_timestamp"])
        .alias("days_purchase_to_approval"),
        X.days_between(t["order_delivered_customer_date"], t["order_approved_at"])
        .alias("days_approval_to_delivery"),
        X.days_between(t["order_delivered_customer_date"], t["order_delivered_carrier_date"])
        .alias("days_carrier_handoff_to_delivery"),
        X.days_between(t["order_delivered_customer_date"], t["order_estimated_delivery_date"])
        .alias("days_estimated_to_actual"))


@query("delivery_status")
def _delivery_status(r: Run) -> DataFrame:
    d, e = X.parse_ts("order_delivered_customer_date"), X.parse_ts("order_estimated_delivery_date")
    return r.src["orders"].select("order_id", X.delivery_status(d, e).alias("delivery_status"))


@query("late_severity")
def _late_severity(r: Run) -> DataFrame:
    d, e = X.parse_ts("order_delivered_customer_date"), X.parse_ts("order_estimated_delivery_date")
    return r.src["orders"].select("order_id", X.late_severity(d, e).alias("late_severity"))


@query("review_sentiment")
def _review_sentiment(r: Run) -> DataFrame:
    return r.src["order_reviews"].select(
        "review_id", "review_score", X.sentiment_score("review_score").alias("sentiment_score"),
        X.review_severity("review_score").alias("review_severity"))


@query("review_text_metrics")
def _review_text_metrics(r: Run) -> DataFrame:
    m = "review_comment_message"
    return r.src["order_reviews"].select(
        "review_id", X.text_length(m).alias("review_length_chars"),
        X.comment_status(m).alias("comment_status"))


@query("change_detect")
def _change_detect(r: Run) -> DataFrame:
    """Per customer key in both states: did any compared column change?"""
    spec = SOURCE_TABLES["customers"]
    cur = r.prev_stg["customers"].select("customer_id",
                                         *[F.col(c).alias("old_" + c) for c in spec.compare])
    j = cur.join(r.src["customers"], "customer_id", "inner")
    return j.select("customer_id", X.any_changed(["old_" + c for c in spec.compare],
                                                 list(spec.compare)).alias("changed"))


@query("surrogate_key")
def _surrogate_key(r: Run) -> DataFrame:
    return r.src["order_items"].select(
        "order_id", "order_item_id",
        X.surrogate_key("order_id", "order_item_id").alias("order_item_key"))


# ---------------------------------------------------------------- joins / filters
@query("dim_current_filter")
def _dim_current_filter(r: Run) -> DataFrame:
    return current_rows(r.t("prev_dim_customer"))


@query("not_exists_current")
def _not_exists_current(r: Run) -> DataFrame:
    """Source natural keys with no Current version (the insert candidates)."""
    src = dims.customer_source(r.stg["customers"], r.stg["geolocation"]).select("customer_nk")
    cur = current_rows(r.t("prev_dim_customer")).select("customer_nk")
    return src.join(cur, "customer_nk", "left_anti").distinct()


@query("lookup_current")
def _lookup_current(r: Run) -> DataFrame:
    o = r.stg["orders"].select("order_id", "customer_id") \
        .join(r.stg["customers"].select("customer_id", "customer_unique_id"), "customer_id")
    return lookup_current(o, "customer_unique_id", r.t("prev_dim_customer"), "customer_nk",
                          "customer_id", "customer_sk").select("order_id", "customer_sk")


@query("product_translation_left_join")
def _product_translation(r: Run) -> DataFrame:
    return dims.product_source(r.stg["products"], r.stg["product_category_name_translation"])


@query("customer_geo")
def _customer_geo(r: Run) -> DataFrame:
    return dims.customer_source(r.stg["customers"], r.stg["geolocation"]).drop("updated_at")


@query("seller_product_semi_join")
def _seller_product_semi(r: Run) -> DataFrame:
    """Items whose seller and product exist in staging (existence-only joins)."""
    i = r.stg["order_items"].select("order_id", "order_item_id", "seller_id", "product_id")
    return (i.join(r.stg["sellers"].select("seller_id"), "seller_id", "left_semi")
            .join(r.stg["products"].select("product_id"), "product_id", "left_semi"))


# ---------------------------------------------------------------- aggregates
@query("zip_centroid")
def _zip_centroid(r: Run) -> DataFrame:
    return A.zip_centroid(r.t("src_geolocation_multi"))


@query("order_totals")
def _order_totals(r: Run) -> DataFrame:
    return A.order_totals(r.stg["order_payments"]).select(
        "order_id", F.col("total_order_value").cast("double").alias("total_order_value"))


@query("first_seller")
def _first_seller(r: Run) -> DataFrame:
    return A.order_sellers(r.stg["order_items"]).select("order_id", "first_seller_id")


@query("multi_seller_orders")
def _multi_seller(r: Run) -> DataFrame:
    s = A.order_sellers(r.stg["order_items"], with_count=True)
    return s.select("order_id", "seller_count",
                    X.multi_seller_label("first_seller_id", "last_seller_id")
                    .alias("multi_seller_order"))


@query("latest_per_key")
def _latest_per_key(r: Run) -> DataFrame:
    """Latest staged customer per natural key (ties: lowest staging key)."""
    src = dims.customer_source(r.stg["customers"], r.stg["geolocation"])
    return latest_per_key(src, "customer_nk", [("updated_at", "desc"), ("staging_key", "asc")])


@query("latest_per_key_text_desc")
def _latest_per_key_text_desc(r: Run) -> DataFrame:
    """The customer of each natural key whose city, then staging key, comes last as text."""
    src = dims.customer_source(r.stg["customers"], r.stg["geolocation"])
    return latest_per_key(src, "customer_nk", [("customer_city", "desc"), ("staging_key", "desc")])


# ---------------------------------------------------------------- staging merges
for _name, _q_name in STG_QUERY.items():
    def _make(n):
        def _stg(r: Run) -> DataFrame:
            return r.stg[n]
        _stg.__name__ = f"stg_{n}"
        return _stg
    query(_q_name)(_make(_name))


@query("merge_audit")
def _merge_audit(r: Run) -> DataFrame:
    return merge_audit(r.stg_audit)


# ---------------------------------------------------------------- dimensions
@query("dim_product_scd1")
def _dim_product(r: Run) -> DataFrame:
    return r.dim_product()


@query("dim_customer_scd2")
def _dim_customer(r: Run) -> DataFrame:
    return r.dim_customer("latest")


@query("dim_customer_scd2_expired")
def _dim_customer_expired(r: Run) -> DataFrame:
    return r.dim_customer("latest").filter(F.col("current_flag") == "Expired")


@query("dim_customer_scd2_any")
def _dim_customer_any(r: Run) -> DataFrame:
    return r.dim_customer("any")


@query("dim_customer_replay")
def _dim_customer_replay(r: Run) -> DataFrame:
    """Four source days of customers turned into version intervals in one pass."""
    return scd2_replay(r.t("prev_dim_customer"), r.t("customer_days"), "customer_nk", SCD2_CUSTOMER_TRACKED,
                       "customer_id", order=[("staging_key", "asc")])


@query("dim_seller_scd2")
def _dim_seller(r: Run) -> DataFrame:
    return r.dim_seller()


def _cluster_dim(assign: DataFrame) -> DataFrame:
    labels = assign.groupBy("cluster_label", "model_version") \
        .agg(F.min("assigned_date").alias("assigned_date"))
    stamp = F.col("assigned_date").cast("timestamp_ntz")
    return labels.select(X.surrogate_key("cluster_label", "model_version").alias("cluster_id"),
                         "cluster_label", "model_version", "assigned_date",
                         stamp.alias("created_at"), stamp.alias("updated_at"))


@query("dim_cluster")
def _dim_cluster(r: Run) -> DataFrame:
    """Insert-only cluster dimension: v1 labels stored, v2 labels arrive."""
    a = r.t("src_cluster_assignment")
    existing = _cluster_dim(a.filter(F.col("model_version") == "v1"))
    return insert_if_absent(existing, _cluster_dim(a), ["cluster_label", "model_version"])


@query("cluster_assignment")
def _cluster_assignment(r: Run) -> DataFrame:
    """Append-only assignments: run v2 appended to the stored run v1."""
    a = r.t("src_cluster_assignment").select(
        "assignment_id", "customer_id",
        X.surrogate_key("cluster_label", "model_version").alias("cluster_id"),
        "model_version", "assigned_date", F.col("assigned_date").cast("timestamp_ntz").alias("created_at"),
        F.col("assigned_date").cast("timestamp_ntz").alias("updated_at"))
    return append_rows(a.filter(F.col("model_version") == "v1"),
                       a.filter(F.col("model_version") == "v2"))


# ---------------------------------------------------------------- facts
for _f in facts.FACT_KEYS:
    def _make_fact(n):
        def _fact(r: Run) -> DataFrame:
            return r.fact(n)
        _fact.__name__ = n
        return _fact
    query(_f)(_make_fact(_f))


def _prev_fact(r: Run, name: str, new: DataFrame) -> DataFrame:
    """Earlier fact state: this run's rows for orders not ending in 9, with a
    stale status, stamped at the earlier timestamp, plus retired rows (copies
    of orders ending in 001 under a key that no longer arrives)."""
    key, sk = facts.FACT_KEYS[name]
    order_key = F.col("order_nk").try_cast("bigint")
    ts = X.ts_literal(PREV_TS)
    stale = "order_status" if "order_status" in new.columns else "payment_type"
    old = (new.filter(order_key % 10 != 9)
           .withColumn(stale, F.lit("stale"))
           .withColumn("created_at", ts).withColumn("updated_at", ts))
    gone = (old.filter(order_key % 1000 == 1)
            .withColumn(sk, X.surrogate_key(F.lit("gone"), sk))
            .withColumn("order_nk", F.concat(F.lit("gone-"), F.col("order_nk"))))
    # Dealt out as the other rows lie, so that the union lies by order as well.
    return old.unionByName(gone.repartition(int(r.spark.conf.get("spark.sql.shuffle.partitions")), "order_nk"))


for _f in facts.FACT_KEYS:
    def _make_merge(n):
        def _merge(r: Run) -> DataFrame:
            new = r.merge_input(n)
            return upsert_overwrite(_prev_fact(r, n, new), new, list(facts.FACT_KEYS[n][0]),
                                    RUN_TS, id_col=facts.FACT_KEYS[n][1])
        _merge.__name__ = f"{n}_merge"
        return _merge
    query(f"{_f}_merge")(_make_merge(_f))


# ---------------------------------------------------------------- quality
@query("dq_unique")
def _dq_unique(r: Run) -> DataFrame:
    """Customer natural keys are not unique in staging (shared buyers)."""
    return Q.check_unique(r.stg["customers"], "customer_unique_id")


@query("dq_unique_composite")
def _dq_unique_composite(r: Run) -> DataFrame:
    """(order, line number) of the raw line items is not a key."""
    li = r.t("lineitem").select(F.col("l_orderkey").cast("string").alias("order_id"),
                                F.col("l_linenumber").alias("line_number"))
    return Q.check_unique(li, ["order_id", "line_number"])


@query("dq_orphans")
def _dq_orphans(r: Run) -> DataFrame:
    """Customers whose zip prefix has no geolocation row."""
    return Q.check_foreign_key(r.stg["customers"], "customer_zip_code_prefix",
                               r.stg["geolocation"], "geolocation_zip_code_prefix") \
        .select("customer_id", "customer_zip_code_prefix")


@query("dq_not_null")
def _dq_not_null(r: Run) -> DataFrame:
    return Q.check_not_null(r.stg["orders"], list(ORDER_TIMESTAMPS), ["order_id"])


# Fixed domain of the review title language accepted by the check below.
REVIEW_TITLE_LANGS = ("en", "pt")


@query("dq_domain")
def _dq_domain(r: Run) -> DataFrame:
    return Q.check_domain(r.stg["order_reviews"], "review_comment_title", REVIEW_TITLE_LANGS) \
        .select("review_id", "order_id", "review_comment_title")


@query("dq_review_score")
def _dq_review_score(r: Run) -> DataFrame:
    """Score range check on a deliberately broken feed (score = key mod 7)."""
    broken = r.src["order_reviews"].withColumn(
        "review_score", (F.col("review_id").try_cast("bigint") % 7).cast("int"))
    return Q.check_range(broken, "review_score", 1, 5).select("review_id", "review_score")


@query("dq_single_current")
def _dq_single_current(r: Run) -> DataFrame:
    """A dimension where keys divisible by 11 received a second Current row."""
    d = r.t("prev_dim_customer")
    dup = current_rows(d).filter((F.col("customer_nk") != "gone")) \
        .filter(F.col("customer_nk").try_cast("bigint") % 11 == 0) \
        .withColumn("customer_id", X.surrogate_key("customer_nk", F.lit("dup")))
    return Q.check_single_current(d.unionByName(dup), "customer_nk")


@query("dq_version_intervals")
def _dq_version_intervals(r: Run) -> DataFrame:
    """Versions whose ends were moved: gaps, overlaps, empty and reversed intervals."""
    return Q.check_version_intervals(r.t("broken_versions"), "customer_nk")


# Foreign keys whose children have a parent in the given tables, every one of them.
WHOLE_FOREIGN_KEYS = [(n, spec, fk) for n, spec in SOURCE_TABLES.items() for fk in spec.foreign_keys
                      if n in ("orders", "order_items", "order_payments", "order_reviews")]


@query("dq_fk_changed")
def _dq_fk_changed(r: Run) -> DataFrame:
    """Orphans of an extract whose parents lost the keys ending in 3, from what changed since
    the earlier state; the same as full checks find."""
    out = None
    for n, spec, (fk, parent, pk) in WHOLE_FOREIGN_KEYS:
        landed = _without_threes(r.src[parent], pk)
        merged = load_staging({**r.src, parent: landed}, r.prev_stg, RUN_TS)
        changed = F.col("updated_at") == X.ts_literal(RUN_TS)
        found = Q.check_foreign_key_changed(r.stg_audit[n], changed, spec.key, fk, r.src[n], landed, merged[parent],
                                            pk, kept=F.col("merge_action") == KEPT)
        found = found.select(F.lit(n).alias("child"), F.lit(fk[0]).alias("foreign_key"),
                             F.concat_ws("|", *spec.key).alias("row_key"), F.col(fk[0]).cast("string").alias("value"))
        out = found if out is None else out.unionByName(found)
    return out


# ---------------------------------------------------------------- requirements
def _buyers(r: Run) -> DataFrame:
    o = r.stg["orders"].select("order_id", "customer_id",
                               X.parse_ts("order_purchase_timestamp").alias("purchased"))
    return o.join(r.stg["customers"].select("customer_id", "customer_unique_id"), "customer_id")


def _items_as_of(r: Run) -> DataFrame:
    i = r.stg["order_items"].select("order_id", "order_item_id", "price").join(_buyers(r), "order_id")
    return lookup_as_of(i, "customer_unique_id", "purchased", r.t("hist_dim_customer"),
                        "customer_nk", "customer_id", "customer_version_id", how="left")


@query("fct_items_as_of")
def _fct_items_as_of(r: Run) -> DataFrame:
    """Each order item with the customer version valid on its purchase day."""
    return _items_as_of(r).select(F.col("order_id").alias("order_nk"),
                                  F.col("order_item_id").alias("order_item_sequence"),
                                  "customer_version_id")


@query("fct_delivery_as_of_seller")
def _fct_delivery_as_of_seller(r: Run) -> DataFrame:
    """Each order's first seller, in the version valid on the purchase day."""
    o = r.stg["orders"].select("order_id", X.parse_ts("order_purchase_timestamp").alias("purchased"))
    s = A.order_sellers(r.stg["order_items"]).select("order_id", "first_seller_id")
    v = lookup_as_of(o.join(s, "order_id"), "first_seller_id", "purchased", r.t("hist_dim_seller"),
                     "seller_nk", "seller_id", "seller_version_id", attrs=("seller_state",))
    return v.select(F.col("order_id").alias("order_nk"), "seller_version_id", "seller_state")


@query("dq_dim_key_unique")
def _dq_dim_key_unique(r: Run) -> DataFrame:
    """Surrogates of a dimension whose customers changed twice on one day."""
    once = r.dim_customer("latest")
    moved = r.stg["customers"].withColumn("customer_city", F.concat("customer_city", F.lit(" 2")))
    twice = dims.build_dim_customer(once, moved, r.stg["geolocation"], SECOND_TS)
    return twice.groupBy("customer_id").agg(F.count("*").alias("row_count")).select("customer_id", "row_count")


def _without_threes(df: DataFrame, keys) -> DataFrame:
    """A parent table that lost the keys ending in 3."""
    return df.filter(~F.col(keys[0]).cast("string").endswith("3"))


for _child, _spec in SOURCE_TABLES.items():
    for _fk, _parent, _pk in _spec.foreign_keys:
        def _make_fk(child, fk, parent, pk, key):
            def _dq_fk(r: Run) -> DataFrame:
                found = Q.check_foreign_key(r.src[child], fk, _without_threes(r.src[parent], pk), pk)
                return found.select(*dict.fromkeys([*key, *fk]))
            return _dq_fk
        query(f"dq_fk_{_child}_{_fk[0]}")(_make_fk(_child, _fk, _parent, _pk, _spec.key))


def _orders_of(n: str):
    return F.col("order_nk").try_cast("bigint") % 10 == int(n)


for _table, _column, _allowed in FACT_DOMAINS:
    def _make_domain(table, column, allowed):
        def _dq(r: Run) -> DataFrame:
            broken = r.fact(table).withColumn(
                column, F.when(_orders_of("7"), F.lit("broken")).otherwise(F.col(column)))
            return Q.check_domain(broken, column, allowed).select(*facts.FACT_KEYS[table][0], column)
        return _dq
    query(f"dq_check_{_column}")(_make_domain(_table, _column, _allowed))


for _table, (_key, _) in facts.FACT_KEYS.items():
    def _make_unique(table, key):
        def _dq(r: Run) -> DataFrame:
            rows = r.fact(table).select(*key)
            return Q.check_unique(rows.unionByName(rows.filter(_orders_of("7"))), list(key))
        return _dq
    query(f"dq_unique_{_table}")(_make_unique(_table, _key))


@query("segment_transitions")
def _segment_transitions(r: Run) -> DataFrame:
    return segment_transitions(r.t("src_cluster_assignment"), r.t("hist_dim_customer"))


@query("sales_by_current_state")
def _sales_by_current_state(r: Run) -> DataFrame:
    """Prices are summed by order first: versions are looked up for orders, not for items."""
    per_order = r.stg["order_items"].groupBy("order_id").agg(F.sum(F.col("price").cast(A.MONEY)).alias("price"))
    sold = lookup_as_of(per_order.join(_buyers(r), "order_id"), "customer_unique_id", "purchased",
                        r.t("hist_dim_customer"), "customer_nk", "customer_id", "customer_version_id", how="left")
    return sales_by_current_attribute(sold, "customer_version_id", "price",
                                      r.t("hist_dim_customer"), "customer_id", "customer_nk",
                                      "customer_state")


@query("on_time_by_state")
def _on_time_by_state(r: Run) -> DataFrame:
    return on_time_by_state(r.stg["orders"], r.stg["customers"], r.t("hist_dim_customer"))


# ---------------------------------------------------------------- whole run
@query("star_row_counts")
def _star_row_counts(r: Run) -> DataFrame:
    tables = {**r.star(), **r.facts()}
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
