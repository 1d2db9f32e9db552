"""Map the provided benchmark tables onto the nine order-system source shapes.

Each view is one SQL text that runs unchanged on Spark SQL and on DuckDB (the
oracle), so both engines see identical inputs. ``{ts}`` is the timestamp type
name: ``timestamp_ntz`` on Spark, ``timestamp`` on DuckDB. Every view reads
the given tables, so its size grows with the scale factor.

The ``prev_*`` views are a derived *earlier* state of each target, used to
exercise merges: rows whose key ends in 9 are missing (they become inserts),
keys divisible by 7 carry an old value and keys divisible by 21 a NULL in the
first compared column, and one row with a key that no longer arrives is added.
"""

from __future__ import annotations

from ..schemas import SOURCE_TABLES, TableSpec

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "documents")

# Run timestamps used by every registered query (never the wall clock).
PREV_TS = "2024-01-01 00:00:00"
RUN_TS = "2024-06-01 00:00:00"

_ORDER_TS = """substr(cast(o_orderdate + {days} * interval '1' day + {hours} * interval '1' hour
    as string), 1, 19)"""


def _order_ts(days: str, hours: str) -> str:
    return _ORDER_TS.format(days=days, hours=hours)


ADAPTERS: dict[str, str] = {
    "src_geolocation": """
SELECT cast(n.n_nationkey AS int) AS geolocation_zip_code_prefix,
       cast(n.n_nationkey * 3 % 50 AS double) AS geolocation_lat,
       cast(n.n_nationkey * 7 % 90 AS double) AS geolocation_lng,
       n.n_name AS geolocation_city,
       r.r_name AS geolocation_state
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "src_geolocation_multi": """
SELECT cast(s.s_nationkey AS int) AS geolocation_zip_code_prefix,
       cast(s.s_suppkey % 90 AS double) AS geolocation_lat,
       cast(s.s_suppkey % 180 AS double) AS geolocation_lng,
       n.n_name AS geolocation_city,
       r.r_name AS geolocation_state
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "src_customers": """
SELECT cast(c.c_custkey AS string) AS customer_id,
       cast(CASE WHEN c.c_custkey % 5 = 1 THEN c.c_custkey - 1 ELSE c.c_custkey END AS string)
           AS customer_unique_id,
       cast(CASE WHEN c.c_custkey % 12 = 5 THEN c.c_nationkey + 1000 ELSE c.c_nationkey END AS int)
           AS customer_zip_code_prefix,
       n.n_name AS customer_city,
       r.r_name AS customer_state
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "src_sellers": """
SELECT cast(s.s_suppkey AS string) AS seller_id,
       cast(CASE WHEN s.s_suppkey % 12 = 5 THEN s.s_nationkey + 1000 ELSE s.s_nationkey END AS int)
           AS seller_zip_code_prefix,
       n.n_name AS seller_city,
       r.r_name AS seller_state
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "src_translation": """
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part""",
    "src_products": """
SELECT cast(p_partkey AS string) AS product_id,
       CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 17 = 1 THEN 'UNLISTED' ELSE p_type END
           AS product_category_name,
       cast(length(p_name) AS double) AS product_name_lenght,
       cast(p_size * 10 AS double) AS product_description_lenght,
       cast(p_partkey % 5 AS double) AS product_photos_qty,
       cast(p_size AS double) AS product_weight_g,
       cast(p_partkey % 30 AS double) AS product_length_cm,
       cast(p_partkey % 20 AS double) AS product_height_cm,
       cast(p_partkey % 10 AS double) AS product_width_cm
FROM part""",
    "src_orders": f"""
SELECT cast(o_orderkey AS string) AS order_id,
       cast(o_custkey AS string) AS customer_id,
       o_orderstatus AS order_status,
       substr(cast(o_orderdate AS string), 1, 19) AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL
            ELSE {_order_ts('(o_orderkey % 3)', '(o_orderkey % 24)')} END AS order_approved_at,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            ELSE {_order_ts('(o_orderkey % 5)', '(o_orderkey % 23)')} END
           AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 10 = 0 THEN NULL
            ELSE {_order_ts('(o_orderkey % 20)', '(o_orderkey % 24)')} END
           AS order_delivered_customer_date,
       {_order_ts('10', '0')} AS order_estimated_delivery_date
FROM orders""",
    # lineitem's (l_orderkey, l_linenumber) is not unique in the generated
    # data, so item numbers are regenerated per order (lines per order are
    # bounded by the generator; a real source ships order_item_id).
    "src_order_items": """
SELECT cast(l_orderkey AS string) AS order_id,
       cast(row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS int)
           AS order_item_id,
       cast(l_partkey AS string) AS product_id,
       cast(l_suppkey AS string) AS seller_id,
       substr(cast(l_shipdate AS string), 1, 19) AS shipping_limit_date,
       l_extendedprice AS price,
       l_quantity AS freight_value
FROM lineitem""",
    "src_order_reviews": f"""
SELECT cast(d.doc_id AS string) AS review_id,
       cast(o.o_orderkey AS string) AS order_id,
       CASE WHEN d.doc_id % 19 = 0 THEN NULL ELSE cast(d.doc_id % 5 + 1 AS int) END AS review_score,
       d.lang AS review_comment_title,
       CASE WHEN d.doc_id % 6 = 0 THEN NULL WHEN d.doc_id % 7 = 0 THEN '   ' ELSE d.text END
           AS review_comment_message,
       substr(cast(o.o_orderdate + (d.doc_id % 40) * interval '1' day AS string), 1, 19)
           AS review_creation_date
FROM documents d CROSS JOIN (SELECT max(o_orderkey) + 1 AS n FROM orders) top
JOIN orders o ON o.o_orderkey = d.doc_id * 7 % top.n""",
}

# Payments: one per line item (sequential = the item's number within its order).
ADAPTERS["src_order_payments"] = """
SELECT cast(l_orderkey AS string) AS order_id,
       order_item_id AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
            WHEN 'R' THEN 'voucher' END AS payment_type,
       cast(l_linenumber AS int) AS payment_installments,
       l_extendedprice AS payment_value
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag,
             cast(row_number() OVER (PARTITION BY l_orderkey
                  ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)
                  AS int) AS order_item_id
      FROM lineitem) numbered"""

# What Spark runs in place of the two texts above, for the same rows: lines are numbered
# within the order's text key, so that they lie by the key that merges and joins use and
# are not dealt out again for them. Other columns are made of the numbered lines, so that
# only the given, narrow ones are dealt out. The key gets its name there too: what Spark
# knows of the rows' places passes a union only under another name.
_NUMBERED_LINES = """(
SELECT *, cast(row_number() OVER (PARTITION BY order_key
       ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS int) AS line_number
FROM (SELECT *, cast(l_orderkey AS string) AS order_key FROM lineitem) keyed) numbered"""
SPARK_ADAPTERS: dict[str, str] = {
    "src_order_items": f"""
SELECT order_key AS order_id,
       line_number AS order_item_id,
       cast(l_partkey AS string) AS product_id,
       cast(l_suppkey AS string) AS seller_id,
       substr(cast(l_shipdate AS string), 1, 19) AS shipping_limit_date,
       l_extendedprice AS price,
       l_quantity AS freight_value
FROM {_NUMBERED_LINES}""",
    "src_order_payments": f"""
SELECT order_key AS order_id,
       line_number AS payment_sequential,
       CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto'
            WHEN 'R' THEN 'voucher' END AS payment_type,
       cast(l_linenumber AS int) AS payment_installments,
       l_extendedprice AS payment_value
FROM {_NUMBERED_LINES}""",
}

# Staging table name -> adapter view holding its incoming rows.
SOURCE_VIEWS = {
    "product_category_name_translation": "src_translation",
    "products": "src_products",
    "geolocation": "src_geolocation",
    "customers": "src_customers",
    "sellers": "src_sellers",
    "orders": "src_orders",
    "order_items": "src_order_items",
    "order_payments": "src_order_payments",
    "order_reviews": "src_order_reviews",
}

# Numeric expression of the key that drives the prev-state rules.
_PREV_KEY = {
    "products": "try_cast(product_id AS bigint)",
    "geolocation": "geolocation_zip_code_prefix",
    "customers": "try_cast(customer_id AS bigint)",
    "sellers": "try_cast(seller_id AS bigint)",
    "orders": "try_cast(order_id AS bigint)",
    "order_items": "try_cast(order_id AS bigint)",
    "order_payments": "try_cast(order_id AS bigint)",
    "order_reviews": "try_cast(review_id AS bigint)",
}

_SQL_TYPE = {"StringType()": "string", "IntegerType()": "int", "DoubleType()": "double"}


def _sql_type(dt) -> str:
    return _SQL_TYPE[repr(dt)]


def surrogate_sql(cols) -> str:
    """SQL text of the deterministic surrogate key (same rule as functions.surrogate_key)."""
    return "md5(concat_ws('|', " + ", ".join(f"cast({c} AS string)" for c in cols) + "))"


def _prev_staging(spec: TableSpec) -> str:
    view = SOURCE_VIEWS[spec.name]
    audit = (f"{surrogate_sql(spec.key)} AS id, cast('{PREV_TS}' AS {{ts}}) AS created_at, "
             f"cast('{PREV_TS}' AS {{ts}}) AS updated_at")
    first = spec.compare[0]
    first_type = _sql_type(spec.schema[first].dataType)
    if spec.name == "product_category_name_translation":
        body = ", ".join(
            c if c != first else
            f"CASE WHEN product_category_name = 'ECONOMY' THEN 'OLD' ELSE {c} END AS {c}"
            for c in spec.columns)
        where = "product_category_name <> 'SMALL'"
    else:
        k = _PREV_KEY[spec.name]
        old = "'OLD'" if first_type == "string" else f"cast(-1 AS {first_type})"
        body = ", ".join(
            c if c != first else
            f"CASE WHEN {k} % 21 = 0 THEN cast(NULL AS {first_type}) "
            f"WHEN {k} % 7 = 0 THEN {old} ELSE {c} END AS {c}"
            for c in spec.columns)
        where = f"{k} % 10 <> 9"
    gone_vals = []
    for f in spec.schema.fields:
        t = _sql_type(f.dataType)
        if f.name in spec.key or f.name == "customer_unique_id":  # a natural key is never NULL
            gone_vals.append(f"cast({'-1' if t != 'string' else repr('gone')} AS {t}) AS {f.name}")
        else:
            gone_vals.append(f"cast(NULL AS {t}) AS {f.name}")
    gone_audit = audit.replace(surrogate_sql(spec.key), surrogate_sql(
        [("'gone'" if _sql_type(spec.schema[k].dataType) == "string" else "-1") for k in spec.key]))
    return (f"SELECT {body}, {audit} FROM {view} WHERE {where}\n"
            f"UNION ALL SELECT {', '.join(gone_vals)}, {gone_audit}")


PREV_VIEWS: dict[str, str] = {f"prev_{name}": _prev_staging(spec)
                              for name, spec in SOURCE_TABLES.items()}
PREV_VIEWS["prev_translation"] = PREV_VIEWS.pop("prev_product_category_name_translation")

# Dimension source rows (staging joined to the zip centroid), one per natural
# key; used only to derive the earlier dimension state.
_DIM_SEED = {
    "customer": ("src_customers", "customer_unique_id", "customer_id", "customer_zip_code_prefix"),
    "seller": ("src_sellers", "seller_id", "seller_id", "seller_zip_code_prefix"),
}


def _prev_scd2(role: str, boundary: str, expired_from: str, history_mod: int,
               old_mod: int = 7, null_mod: int = 21, drop_mod: int = 10) -> str:
    view, nk, sk, zip_col = _DIM_SEED[role]
    p = role
    # Each natural key has one staging row whose own key equals it (customer k
    # with k % 5 = 0 for shared keys); that row seeds the earlier version.
    seed = f"""
SELECT {nk} AS nk, {p}_city AS city, {p}_state AS state, g.geolocation_lat AS lat,
       g.geolocation_lng AS lng, 1 AS rn
FROM {view} s LEFT JOIN src_geolocation g ON s.{zip_col} = g.geolocation_zip_code_prefix
WHERE s.{sk} = s.{nk}"""
    cols = (f"{p}_id, {p}_nk, {p}_city, {p}_state, {p}_latitude, {p}_longitude, valid_from, valid_to, "
            "current_flag, created_at, updated_at")
    k = "try_cast(nk AS bigint)"
    ts = f"cast('{PREV_TS}' AS {{ts}})"
    current = f"""
SELECT {surrogate_sql(['nk', f"cast('{boundary} 00:00:00' AS {{ts}})"])} AS {p}_id,
       nk AS {p}_nk,
       CASE WHEN {k} % {null_mod} = 0 THEN cast(NULL AS string)
            WHEN {k} % {old_mod} = 0 THEN 'OLD' ELSE city END AS {p}_city,
       state AS {p}_state, lat AS {p}_latitude, lng AS {p}_longitude,
       cast('{boundary}' AS date) AS valid_from, cast('9999-12-31' AS date) AS valid_to,
       'Current' AS current_flag, {ts} AS created_at, {ts} AS updated_at
FROM seed WHERE rn = 1 AND {k} % {drop_mod} <> 9"""
    expired = f"""
SELECT {surrogate_sql(['nk', f"cast('{expired_from} 00:00:00' AS {{ts}})"])} AS {p}_id,
       nk AS {p}_nk, 'ANCIENT' AS {p}_city, state AS {p}_state, lat AS {p}_latitude,
       lng AS {p}_longitude, cast('{expired_from}' AS date) AS valid_from,
       cast('{boundary}' AS date) AS valid_to, 'Expired' AS current_flag,
       {ts} AS created_at, {ts} AS updated_at
FROM seed WHERE rn = 1 AND {k} % {history_mod} = 0"""
    gone = f"""
SELECT {surrogate_sql(["'gone'", f"cast('{boundary} 00:00:00' AS {{ts}})"])} AS {p}_id, 'gone' AS {p}_nk,
       'NOWHERE' AS {p}_city, cast(NULL AS string) AS {p}_state,
       cast(NULL AS double) AS {p}_latitude, cast(NULL AS double) AS {p}_longitude,
       cast('{boundary}' AS date) AS valid_from, cast('9999-12-31' AS date) AS valid_to,
       'Current' AS current_flag, {ts} AS created_at, {ts} AS updated_at"""
    return (f"SELECT {cols} FROM (\nWITH seed AS ({seed})\n{current}\nUNION ALL{expired}\n"
            f"UNION ALL{gone}) x")


PREV_VIEWS["prev_dim_customer"] = _prev_scd2("customer", "2024-01-01", "2023-01-01", 50)
PREV_VIEWS["prev_dim_seller"] = _prev_scd2("seller", "2024-01-01", "2023-01-01", 50)
# Version history with a boundary inside the order date range, for as-of lookups:
# every key's first version starts at 1998-06-01; keys divisible by 3 changed
# city on 1999-06-01 (earlier version kept as Expired).
PREV_VIEWS["hist_dim_customer"] = _prev_scd2("customer", "1999-06-01", "1998-06-01", 3,
                                             old_mod=10 ** 9, null_mod=10 ** 9, drop_mod=10 ** 9)
PREV_VIEWS["hist_dim_seller"] = _prev_scd2("seller", "1999-06-01", "1998-06-01", 3,
                                           old_mod=10 ** 9, null_mod=10 ** 9, drop_mod=10 ** 9)

# Earlier product dimension (type 1): keys ending in 9 missing, an old category
# for keys divisible by 7, NULL for keys divisible by 21, plus a retired key.
PREV_VIEWS["prev_dim_product"] = f"""
SELECT {surrogate_sql(['p.product_id'])} AS product_id, p.product_id AS product_nk,
       CASE WHEN try_cast(p.product_id AS bigint) % 21 = 0 THEN cast(NULL AS string)
            WHEN try_cast(p.product_id AS bigint) % 7 = 0 THEN 'OLD'
            ELSE p.product_category_name END AS product_category_name,
       t.product_category_name_english, p.product_weight_g, p.product_length_cm,
       p.product_height_cm, p.product_width_cm,
       cast('{PREV_TS}' AS {{ts}}) AS created_at, cast('{PREV_TS}' AS {{ts}}) AS updated_at
FROM src_products p LEFT JOIN src_translation t
  ON p.product_category_name = t.product_category_name
WHERE try_cast(p.product_id AS bigint) % 10 <> 9
UNION ALL
SELECT {surrogate_sql(["'gone'"])} AS product_id, 'gone' AS product_nk,
       'RETIRED' AS product_category_name, cast(NULL AS string) AS product_category_name_english,
       cast(NULL AS double) AS product_weight_g, cast(NULL AS double) AS product_length_cm,
       cast(NULL AS double) AS product_height_cm, cast(NULL AS double) AS product_width_cm,
       cast('{PREV_TS}' AS {{ts}}) AS created_at, cast('{PREV_TS}' AS {{ts}}) AS updated_at"""

# Customer segment assignments from two model runs, by the customer's version: every
# third customer moved in between, so the runs name two versions of it.
PREV_VIEWS["src_cluster_assignment"] = f"""
SELECT {surrogate_sql(['customer_id', "'v1'"])} AS assignment_id, customer_id,
       concat('segment_', cast(try_cast(customer_nk AS bigint) % 4 AS string)) AS cluster_label,
       'v1' AS model_version, cast('2024-01-01' AS date) AS assigned_date
FROM hist_dim_customer
WHERE current_flag = 'Expired' OR try_cast(customer_nk AS bigint) % 3 <> 0
UNION ALL
SELECT {surrogate_sql(['customer_id', "'v2'"])} AS assignment_id, customer_id,
       concat('segment_', cast((try_cast(customer_nk AS bigint) * 3 + 1) % 4 AS string)) AS cluster_label,
       'v2' AS model_version, cast('2024-06-01' AS date) AS assigned_date
FROM hist_dim_customer
WHERE current_flag = 'Current' AND customer_nk <> 'gone'"""


# Four source days of customers for a replay: on each, some moved (and are back the day after),
# some have no city, some are missing.
PREV_VIEWS["customer_days"] = "\nUNION ALL\n".join(f"""
SELECT cast('2024-06-0{d} 00:00:00' AS {{ts}}) AS run_ts, customer_unique_id AS customer_nk,
       CASE WHEN try_cast(customer_unique_id AS bigint) % 4 = {d - 1} THEN concat(customer_city, ' moved')
            WHEN try_cast(customer_unique_id AS bigint) % 9 = {d} THEN cast(NULL AS string)
            ELSE customer_city END AS customer_city,
       customer_state, cast(customer_zip_code_prefix % 50 AS double) AS customer_latitude,
       cast(customer_zip_code_prefix % 90 AS double) AS customer_longitude, customer_id AS staging_key
FROM src_customers WHERE try_cast(customer_unique_id AS bigint) % 7 <> {d}""" for d in (1, 2, 3, 4))

# Customer versions whose ends were moved: gaps, overlaps, empty and reversed ones.
PREV_VIEWS["broken_versions"] = """
SELECT customer_nk, valid_from, current_flag,
       CASE WHEN current_flag = 'Current' OR customer_nk = 'gone' THEN valid_to
            WHEN try_cast(customer_nk AS bigint) % 10 = 0 THEN cast(valid_to - interval '1' day AS date)
            WHEN try_cast(customer_nk AS bigint) % 10 = 2 THEN cast(valid_to + interval '1' day AS date)
            WHEN try_cast(customer_nk AS bigint) % 10 = 4 THEN valid_from
            WHEN try_cast(customer_nk AS bigint) % 10 = 6 THEN cast(valid_from - interval '1' day AS date)
            ELSE valid_to END AS valid_to
FROM hist_dim_customer"""


def all_views() -> dict[str, str]:
    """Adapter then derived views, in dependency order."""
    out = dict(ADAPTERS)
    out.update(PREV_VIEWS)
    return out


def _spark_views(parts: int) -> dict[str, str]:
    """Spark's texts of the views on line items. The earlier state's condition on the order
    also names the line number (which is above 0 in every row), so that it is not moved before
    the numbering: both states then number one and the same shuffled lines. The row that no
    longer arrives is dealt out as the lines lie, into ``parts``, so that the earlier state as a
    whole lies by order and a merge does not deal it out again."""
    out = dict(SPARK_ADAPTERS)
    for view, number in (("order_items", "order_item_id"), ("order_payments", "payment_sequential")):
        cond = f"{_PREV_KEY[view]} % 10 <> 9"
        lines, gone = PREV_VIEWS[f"prev_{view}"].split("UNION ALL SELECT")
        lines = lines.replace(f"WHERE {cond}", f"WHERE coalesce({cond}, false) = ({number} > 0)")
        # The key comes from a row, not from a constant, whose place Spark would not compare.
        gone = gone.replace("cast('gone' AS string) AS order_id", "gone.order_id")
        out[f"prev_{view}"] = (f"{lines}UNION ALL SELECT /*+ REPARTITION({parts}, order_id) */{gone} "
                               "FROM VALUES ('gone') AS gone(order_id)")
    return out


def render(sql: str, engine: str) -> str:
    return sql.replace("{ts}", "timestamp_ntz" if engine == "spark" else "timestamp")


def register(spark, sf_dir: str) -> None:
    """Register base tables and every adapter view on a Spark session."""
    for t in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, sql in {**all_views(), **_spark_views(parts)}.items():
        spark.sql(render(sql, "spark")).createOrReplaceTempView(name)


def oracle_with(names: list[str]) -> str:
    """DuckDB ``WITH`` prefix defining the named views (plus their dependencies)."""
    views = all_views()
    needed: list[str] = []

    def add(n: str) -> None:
        if n in needed:
            return
        for dep in views:
            if dep != n and dep in views[n] and _mentions(views[n], dep):
                add(dep)
        needed.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({render(views[n], 'duckdb')})" for n in needed)


def _mentions(sql: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", sql) is not None


# The views hold orphans on purpose (zips beyond 999, an unlisted category), for
# the check queries; an extract that a run accepts has none.
_CLEAN = {
    "customers": "CASE WHEN {c} >= 1000 THEN {c} - 1000 ELSE {c} END",
    "sellers": "CASE WHEN {c} >= 1000 THEN {c} - 1000 ELSE {c} END",
    "products": "nullif({c}, 'UNLISTED')",
}
_CLEANED = {"customers": "customer_zip_code_prefix", "sellers": "seller_zip_code_prefix",
            "products": "product_category_name"}


def write_source_extract(spark, sf_dir: str, out_root: str, clean: bool = True) -> None:
    """Write the nine source tables (adapter views) as parquet under
    ``out_root/<table>``: the extract a warehouse run starts from. ``clean``
    mends the views' orphans, which a validating run would refuse."""
    register(spark, sf_dir)
    for table, view in SOURCE_VIEWS.items():
        df = spark.table(view)
        if clean and table in _CLEAN:
            c = _CLEANED[table]
            df = df.selectExpr(*[f"{_CLEAN[table].format(c=c)} AS {x}" if x == c else x for x in df.columns])
        df.write.mode("overwrite").parquet(f"{out_root}/{table}")
