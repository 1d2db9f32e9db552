"""Warehouse runs: staging load, star build, versioned writes and a manifest.

Storage layout under a shared warehouse root::

    <root>/<layer>/<table>/<run_id>-<attempt>/   parquet, one folder per attempt
    <root>/_manifests/<sequence>/                (layer, table, path) rows of a run

Every attempt of a run writes folders of its own, so nothing that a published
run names is ever overwritten. The manifest is written last, aside, and renamed to
the sequence number after the one the run started from: of two runs that started
from the same state one publishes, and the other raises. Readers take the
complete manifest with the highest number. A published run id and a run timestamp
that is not later than the published one are refused. A type 2 dimension is stored as its Current rows plus one
increment of Expired rows per run; the manifest names all of them, and they are
folded into one when there are many. Writing each layer and reading it back
also cuts the lineage between layers, so a lost executor is recomputed from
stored data.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.merge import insert_if_absent, upsert_changed, upsert_delta, upsert_overwrite
from ..operators.scd import current_rows
from ..operators.steplog import StepLog, counted, counted_by, stamp_action
from ..operators.quality import (QualityError, check_domain, check_foreign_key, check_not_null,
                                 check_foreign_key_changed, check_parse_failures, check_range,
                                 check_single_current, check_unique, check_version_intervals)
from ..schemas import (DIM_KEYS, FACT_DOMAINS, NOT_NULL, ORDER_TIMESTAMPS, REVIEW_SCORE_RANGE, SOURCE_TABLES, STAGING_AUDIT,
                       TIMESTAMP_TEXTS)
from ..sources.tables import land_table, scan_sources
from . import dims, fact_store, facts
from ..functions.calendar import build_dim_date

MANIFEST_DDL = ("run_id string, run_ts string, layer string, table_name string, path string, "
                "num_buckets int, bucket_cols string, n_rows int")

# Increments of Expired rows that a manifest names before they are folded into one.
MAX_INCREMENTS = 24

# (number of buckets, bucket columns) of a stored version, or None.
Bucketing = tuple[int, tuple[str, ...]] | None


def write_all(jobs: dict[str, Callable[[], object]], max_parallel: int = 4) -> dict[str, object]:
    """Run independent table writes of one layer as concurrent Spark jobs.

    Tables of a layer do not depend on each other, so their jobs share the
    executors instead of queueing; each job still plans and shuffles on its own.
    """
    from concurrent.futures import ThreadPoolExecutor
    if max_parallel <= 1 or len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(jobs))) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def version_path(root: str, layer: str, table: str, attempt: str) -> str:
    return f"{root}/{layer}/{table}/{attempt}"


def _catalog_name(path: str) -> str:
    """Session-catalog name of a bucketed version (derived from its path)."""
    import hashlib
    tail = re.sub(r"\W", "_", "_".join(path.rstrip("/").split("/")[-3:-1]))
    return f"stl_{tail}_{hashlib.md5(path.encode()).hexdigest()[:10]}"


def bucket_prefix(cols: tuple[str, ...]) -> tuple[str, ...]:
    """The columns a version sorted on ``cols`` is hashed by. An order and its
    items, payments and reviews are hashed by the order alone, so that joins
    and totals per order, as well as merges on the whole key, find them in one place."""
    return ("order_id",) if "order_id" in cols else cols


def write_version(df: DataFrame, root: str, layer: str, table: str, attempt: str,
                  bucket: Bucketing = None, codec: str | None = None, append: bool = False) -> str:
    """Write one table version to a folder that must not exist, or with ``append`` add rows
    to one; returns its path.

    With ``bucket = (n, cols)`` the version is stored hash-bucketed on the
    ``bucket_prefix`` of ``cols`` and sorted on all of them (an external table in
    the session catalog), so a later merge or join on those columns, or on
    the prefix, with an equally bucketed side needs no shuffle.
    """
    path = version_path(root, layer, table, attempt)
    w = df.write.format("parquet")
    if append:
        w = w.mode("append")
    if codec:
        w = w.option("compression", codec)
    if bucket:
        n, cols = bucket
        w.bucketBy(n, *bucket_prefix(cols)).sortBy(*cols).option("path", path).saveAsTable(_catalog_name(path))
    else:
        w.save(path)
    return path


def read_version(spark: SparkSession, path: str, bucket: Bucketing = None,
                 ddl: str | None = None) -> DataFrame:
    """Read a stored version; a bucketed one is (re-)registered with its bucket
    spec so the planner can use it (needs the column list ``ddl``)."""
    if not bucket:
        return spark.read.parquet(path)
    n, cols = bucket
    name = _catalog_name(path)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
                  f"CLUSTERED BY ({', '.join(bucket_prefix(cols))}) SORTED BY ({', '.join(cols)}) "
                  f"INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(name)


class ManifestError(Exception):
    """The stored manifests do not describe a complete run."""


def _sequences(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete manifests, ascending; a listing that fails raises."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_manifests")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    done = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_manifests/{name}/_SUCCESS")):
            done.append(int(name))
    return sorted(done)


def publish_manifest(spark: SparkSession, root: str, run_id: str, run_ts: str,
                     paths: dict[tuple[str, str], str | list[str]],
                     buckets: dict[tuple[str, str], Bucketing] | None = None,
                     after: int | None = None) -> int:
    """Name the tables of a run, under the number after ``after`` (the number of the
    manifest the run started from; by default the latest). Returns the number.

    The manifest is written to a hidden folder and renamed, which the file system does
    at once and only if the number is free (HDFS and local disks; an object store needs
    a committer of its own). When another run has published in between, the number
    is taken and this one raises ``ManifestError``; nothing is damaged.
    """
    buckets = buckets or {}
    rows = []
    for (layer, table), found in sorted(paths.items()):
        b = buckets.get((layer, table))
        for path in [found] if isinstance(found, str) else found:
            rows.append((run_id, run_ts, layer, table, path, b[0] if b else None,
                         ",".join(b[1]) if b else None))
    if after is None:
        done = _sequences(spark, root)
        after = done[-1] if done else 0
    aside, number = f"{root}/_manifests/.{uuid.uuid4().hex}", after + 1
    spark.createDataFrame([(*r, len(rows)) for r in rows], MANIFEST_DDL).coalesce(1).write.json(aside)
    jvm = spark._jvm
    source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (aside, f"{root}/_manifests/{number:09d}"))
    taken = f"manifest {number} under {root} was published by another run"
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(source, target, spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as e:
        if files.util().exists(target):
            raise ManifestError(taken) from e
        raise
    # A file system that moves into an existing folder instead of refusing is found out here.
    if {r["path"] for r in _read_manifest(spark, root, number)} != {r[4] for r in rows}:
        raise ManifestError(taken)
    return number


def _read_manifest(spark: SparkSession, root: str, number: int) -> list:
    rows = spark.read.schema(MANIFEST_DDL).option("mode", "FAILFAST").json(
        f"{root}/_manifests/{number:09d}").collect()
    if not rows or any(r["n_rows"] != len(rows) or not r["path"] for r in rows):
        raise ManifestError(f"manifest {number} under {root} is damaged")
    return rows


def _latest_rows(spark: SparkSession, root: str) -> list:
    """Rows of the latest complete manifest; [] only when none was ever published."""
    done = _sequences(spark, root)
    return _read_manifest(spark, root, done[-1]) if done else []


def latest_manifest(spark: SparkSession, root: str) -> dict[tuple[str, str], str | list[str]]:
    """(layer, table) -> path of the latest published run, or the list of paths
    that together hold a type 2 dimension or a fact stored by partition (empty if
    nothing was published)."""
    out: dict[tuple[str, str], str | list[str]] = {}
    for r in _latest_rows(spark, root):
        key = (r["layer"], r["table_name"])
        if key[1] in SCD2_DIMS or key == ("final", "cluster_assignment") or (key[0] == "final" and r["num_buckets"]):
            out.setdefault(key, []).append(r["path"])
        else:
            out[key] = r["path"]
    return out


SCD2_DIMS = ("dim_customer", "dim_seller")


def read_dimension(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The whole type 2 dimension, Current and Expired versions, in one scan."""
    return spark.read.parquet(*latest_manifest(spark, root)[("final", name)])


def read_fact(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored fact, whether one folder or one per partition (and their changes) hold it."""
    found = latest_manifest(spark, root)[("final", name)]
    return spark.read.parquet(found) if isinstance(found, str) else fact_store.read_stored(spark, name, found)


def latest_buckets(spark: SparkSession, root: str) -> dict[tuple[str, str], Bucketing]:
    return {(r["layer"], r["table_name"]): (r["num_buckets"], tuple(r["bucket_cols"].split(",")))
            for r in _latest_rows(spark, root) if r["num_buckets"]}


def staging_schema_ddl(name: str) -> str:
    spec = SOURCE_TABLES[name]
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema.fields)
    return f"{cols}, id string, created_at timestamp_ntz, updated_at timestamp_ntz"


def load_staging(sources: dict[str, DataFrame], staging: dict[str, DataFrame], run_ts,
                 with_action: bool = False) -> dict[str, DataFrame]:
    """Change-aware upsert of every source table into its staging table."""
    out = {}
    for name, spec in SOURCE_TABLES.items():
        cur = staging[name].select(*spec.columns, *STAGING_AUDIT)
        out[name] = upsert_changed(cur, sources[name].select(*spec.columns), spec.key,
                                   spec.compare, run_ts, with_action=with_action)
    return out


def build_star(spark: SparkSession, stg: dict[str, DataFrame], final: dict[str, DataFrame],
               run_ts, match: str = "latest") -> dict[str, DataFrame]:
    """Dimensions, then facts restated against the new Current versions.
    ``final`` holds the previous dimension and fact states."""
    out: dict[str, DataFrame] = {}
    out["dim_date"] = final["dim_date"] if final.get("dim_date") is not None \
        else build_dim_date(spark)
    out["dim_customer"] = dims.build_dim_customer(final["dim_customer"], stg["customers"],
                                                  stg["geolocation"], run_ts, match)
    out["dim_product"] = dims.build_dim_product(final["dim_product"], stg["products"],
                                                stg["product_category_name_translation"], run_ts)
    out["dim_seller"] = dims.build_dim_seller(final["dim_seller"], stg["sellers"],
                                              stg["geolocation"], run_ts, match)
    return out


ORDER_CHILDREN = ("order_items", "order_payments", "order_reviews")


def affected_orders(stg: dict[str, DataFrame], star: dict[str, DataFrame], run_ts) -> DataFrame:
    """Orders whose fact rows can differ from the previous run: the order or
    one of its items / payments / reviews changed, its customer's staging row
    or Current version changed, or one of its items points to a seller with a
    new Current version or to a product that is new in the dimension.

    Every input is filtered on ``updated_at`` / ``created_at = run_ts`` (pushed
    into the Parquet scan); the result is a distinct set of order ids.
    """
    ts = X.ts_literal(run_ts)
    ids = [stg[n].filter(F.col("updated_at") == ts).select("order_id")
           for n in ("orders",) + ORDER_CHILDREN]
    new_cust = current_rows(star["dim_customer"]).filter(F.col("created_at") == ts) \
        .select(F.col("customer_nk").alias("customer_unique_id"))
    cust = stg["customers"].select("customer_id", "customer_unique_id", "updated_at")
    moved = (cust.join(new_cust, "customer_unique_id", "left_semi").select("customer_id")
             .unionByName(cust.filter(F.col("updated_at") == ts).select("customer_id")))
    ids.append(stg["orders"].select("order_id", "customer_id")
               .join(moved, "customer_id", "left_semi").select("order_id"))
    new_seller = current_rows(star["dim_seller"]).filter(F.col("created_at") == ts) \
        .select(F.col("seller_nk").alias("seller_id"))
    new_product = star["dim_product"].filter(F.col("created_at") == ts) \
        .select(F.col("product_nk").alias("product_id"))
    items = stg["order_items"].select("order_id", "seller_id", "product_id")
    ids.append(items.join(new_seller, "seller_id", "left_semi").select("order_id"))
    ids.append(items.join(new_product, "product_id", "left_semi").select("order_id"))
    out = ids[0]
    for i in ids[1:]:
        out = out.unionByName(i)
    return out.distinct()


def restrict_to_orders(stg: dict[str, DataFrame], orders: DataFrame) -> dict[str, DataFrame]:
    """Staging with orders and their children limited to ``orders`` (semi-joins;
    dimension-side tables are left whole)."""
    out = dict(stg)
    for n in ("orders",) + ORDER_CHILDREN:
        out[n] = stg[n].join(orders, "order_id", "left_semi")
    return out


def build_facts(stg: dict[str, DataFrame], star: dict[str, DataFrame], checked: bool = False,
                order_keys: DataFrame | None = None,
                only: tuple[str, ...] = tuple(facts.FACT_KEYS),
                item_products: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four facts, or those named in ``only``. ``checked``: the run has checked staging's keys and foreign keys,
    so reviews need not be reduced to the latest row per key, nor sellers and products
    looked up in staging. ``order_keys``: ``order_customer_keys``, if stored already;
    ``item_products``: the items' product surrogates, if looked up already."""
    d, sellers, products = star, stg["sellers"], stg["products"]
    if checked:
        sellers = products = None
    builders = {
        "fct_order_items": lambda: facts.build_fct_order_items(
            stg["order_items"], stg["orders"], stg["customers"], d["dim_customer"],
            sellers, d["dim_seller"], products, d["dim_product"], d["dim_date"], order_keys, item_products),
        "fct_order_payments": lambda: facts.build_fct_order_payments(
            stg["order_payments"], stg["orders"], stg["customers"], d["dim_customer"],
            d["dim_date"], order_keys),
        "fct_order_reviews": lambda: facts.build_fct_order_reviews(
            stg["order_reviews"], stg["orders"], stg["customers"], d["dim_customer"],
            d["dim_date"], dedupe=not checked, order_keys=order_keys),
        "fct_order_delivery": lambda: facts.build_fct_order_delivery(
            stg["orders"], stg["customers"], d["dim_customer"], stg["order_items"],
            sellers, d["dim_seller"], d["dim_date"], order_keys),
    }
    return {n: builders[n]() for n in only}


def merge_facts(new_facts: dict[str, DataFrame], current: dict[str, DataFrame],
                run_ts, rebuild: bool = False, delta: bool = False, with_action: bool = False) -> dict[str, DataFrame]:
    """Upsert each restated fact into its stored state (incoming wins).
    ``rebuild`` starts from empty facts (the truncate-and-reload variant);
    ``delta`` uses the small-delta plan (``upsert_delta``)."""
    out = {}
    for name, df in new_facts.items():
        key, sk = facts.FACT_KEYS[name]
        cur = None if rebuild else current.get(name)
        if delta and cur is not None:
            out[name] = upsert_delta(cur, df, list(key), run_ts, id_col=sk, with_action=with_action)
            continue
        if cur is None:
            cur = fact_store.with_audit(df.limit(0))
        out[name] = upsert_overwrite(cur, df, list(key), run_ts, id_col=sk, with_action=with_action)
    return out


def _assert_all(checks: dict[str, DataFrame], max_parallel: int) -> None:
    """Run independent checks concurrently; raise naming every failed one."""
    results = write_all({name: (lambda d: lambda: d.isEmpty())(df) for name, df in checks.items()},
                        max_parallel)
    failed = sorted(name for name, ok in results.items() if not ok)
    if failed:
        raise QualityError("data-quality checks failed: " + ", ".join(failed))


def changed_key_checks(landed: dict[str, DataFrame], stg: dict[str, DataFrame], run_ts) -> dict[str, DataFrame]:
    """The foreign keys of an extract merged into a checked staging, by what changed."""
    changed = F.col("updated_at") == X.ts_literal(run_ts)
    return {f"foreign key {n}({', '.join(fk)}) to {parent}": check_foreign_key_changed(
                stg[n], changed, spec.key, fk, landed[n], landed[parent], stg[parent], pk)
            for n, spec in SOURCE_TABLES.items() for fk, parent, pk in spec.foreign_keys}


def landing_checks(landed: dict[str, DataFrame], foreign_keys: bool = True) -> dict[str, DataFrame]:
    """Constraints of the nine source tables: violating rows by check name."""
    out = {}
    for n, spec in SOURCE_TABLES.items():
        df = landed[n]
        out[f"unique key of {n}"] = check_unique(df, spec.key)
        needed = [f.name for f in spec.schema.fields if not f.nullable or f.name in NOT_NULL.get(n, ())]
        out[f"not null in {n}"] = check_not_null(df, needed, list(spec.key))
        for fk, parent, pk in spec.foreign_keys if foreign_keys else ():
            out[f"foreign key {n}({', '.join(fk)}) to {parent}"] = check_foreign_key(df, fk, landed[parent], pk)
        for c in TIMESTAMP_TEXTS.get(n, ()):
            out[f"timestamp text {n}.{c}"] = check_parse_failures(df, c, X.parse_ts(c))
    return out


def dimension_checks(star: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    for n, (sk, nk) in DIM_KEYS.items():
        out[f"unique surrogate of {n}"] = check_unique(star[n], sk)
        out[f"not null in {n}"] = check_not_null(star[n], [nk], [sk])
        if n in SCD2_DIMS:
            out[f"one Current version in {n}"] = check_single_current(star[n], nk)
            # A version that is there twice is the surrogate check's to report, not an overlap.
            out[f"version history of {n}"] = check_version_intervals(star[n].dropDuplicates([sk]), nk)
        else:
            out[f"unique key of {n}"] = check_unique(star[n], nk)
    return out


def fact_checks(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Constraints of the facts in ``stored``. A run restates an order's rows whole, and changes
    replace stored rows by key, so the rows that a run wrote can be checked by themselves."""
    out = {f"unique key of {n}": check_unique(df, facts.FACT_KEYS[n][0]) for n, df in stored.items()}
    for n, column, allowed in FACT_DOMAINS:
        if n in stored:
            out[f"allowed values of {n}.{column}"] = check_domain(stored[n], column, allowed)
    if "fct_order_reviews" in stored:
        out["range of fct_order_reviews.review_score"] = check_range(
            stored["fct_order_reviews"], "review_score", *REVIEW_SCORE_RANGE)
    return out


ORDER_KEYS_DDL = ("order_id string, order_status string, "
                  + ", ".join(f"{c} string" for c in ORDER_TIMESTAMPS) + ", customer_sk string")


def source_ddl(name: str) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}"
                     for f in SOURCE_TABLES[name].schema.fields)


def _moment(ts) -> datetime:
    """A run timestamp (datetime or text, fields of any width) to compare with others."""
    if isinstance(ts, datetime):
        return ts.replace(tzinfo=None)
    parts = re.fullmatch(r"\s*(\d+)-(\d+)-(\d+)(?:[ T](\d+):(\d+)(?::(\d+)(?:\.(\d{1,6})\d*)?)?)?\s*", str(ts))
    if not parts:
        raise ValueError(f"run_ts {ts!r} is not a timestamp")
    *fields, fraction = parts.groups()
    return datetime(*(int(x or 0) for x in fields), int((fraction or "0").ljust(6, "0")))


def _is_published(spark: SparkSession, root: str, run_id: str) -> bool:
    """Does a complete manifest name the run? Its marker folder, made before the run
    publishes, holds the numbers that it tried to publish under."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_published/{run_id}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    tried = [int(s.getPath().getName()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
    done = set(_sequences(spark, root))
    return any(_read_manifest(spark, root, n)[0]["run_id"] == run_id for n in tried if n in done)


def run_elt(spark: SparkSession, source_root: str, warehouse_root: str, run_ts, run_id: str,
            source_format: str = "parquet", match: str = "latest",
            timings: dict[str, float] | None = None, max_parallel: int = 4,
            rebuild_facts: bool = False, num_buckets: int | None = None,
            validate: bool | str = True, incremental_facts: bool = False, fact_parts: int | None = None,
            clusters: DataFrame | None = None) -> dict[tuple[str, str], str | list[str]]:
    """Extract -> land -> staging upserts -> dimensions -> facts -> manifest.

    Each layer is written, then read back by the next, so stages share one
    consistent snapshot and lineage stays short. ``timings`` (optional)
    receives wall-clock seconds per phase.

    ``num_buckets`` stores landing, staging and the orders' resolved keys bucketed, the
    order tables on the order alone (and sorted on their whole key). The extract is
    then shuffled once, when it lands; the merge of the (ever larger) staging table
    with it, and the facts' joins and totals per order, read co-bucketed inputs: no
    exchange on either side.

    ``validate`` enforces the model's constraints: keys, foreign keys, NOT NULL
    columns and timestamp texts of the extract before the merges; surrogates,
    one Current version per key and whole version histories of the dimensions before
    the facts read them; keys, allowed values and the score range of the facts (of the
    rows written). Nothing is published when a check fails. ``validate="changed"`` holds
    only the rows that changed, and those whose parents did not land, against the foreign
    keys; use it when the runs before were validated.

    A run id that is already published, or a ``run_ts`` that is not later than the
    published one, is refused; a failed run may be repeated under its id.

    ``incremental_facts`` restates only ``affected_orders`` and merges them
    with ``upsert_delta``: same fact values as a full restatement, but rows of
    untouched orders keep their previous ``updated_at``. ``fact_parts`` stores facts by
    hash partition of the order, with changes beside them (``fact_store``); an incremental
    run then writes and checks the restated rows only, and ``read_fact`` reads them in
    place of those they replace. Keep the number from run to run: another one rewrites all.

    ``clusters`` (``customer_id, cluster_label, model_version, assigned_date``) are a model
    run's assignments: new labels go to ``dim_cluster``, the rows are appended to
    ``cluster_assignment`` as an increment.

    What each step did, and how long it took, is appended to ``<root>/_steps``, also
    when the run fails (``read_step_log``).
    """
    started = _moment(run_ts)
    stamp = started.strftime("%Y-%m-%d %H:%M:%S") + (f".{started.microsecond:06d}" if started.microsecond else "")
    done = _sequences(spark, warehouse_root)
    base = done[-1] if done else 0
    for r in (_read_manifest(spark, warehouse_root, base) if done else [])[:1]:
        if r["run_id"] == run_id or started <= _moment(r["run_ts"]):
            raise ValueError(f"run {run_id} at {stamp} does not follow the published run "
                             f"{r['run_id']} at {r['run_ts']}")
    if _is_published(spark, warehouse_root, run_id):
        raise ValueError(f"run {run_id} is already published")
    attempt = f"{run_id}-{uuid.uuid4().hex[:12]}"
    log = StepLog(run_id, stamp)
    conf = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(conf)
    try:
        if num_buckets:  # a side that isn't bucketed yet may be shuffled to fit one bucketed on a key's prefix
            spark.conf.set(conf, "false")
        paths, buckets = _build_run(spark, source_root, warehouse_root, stamp, attempt, log, source_format, match, timings,
                                    max_parallel, rebuild_facts, num_buckets, validate, incremental_facts, fact_parts, clusters)
        marker = spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse_root}/_published/{run_id}/{base + 1}")
        marker.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(marker)
        log.step("publish", "manifest", lambda: publish_manifest(spark, warehouse_root, run_id, stamp, paths, buckets,
                                                                after=base))()
    finally:
        spark.conf.set(conf, before)
        if log.rows:
            log.frame(spark).write.parquet(f"{warehouse_root}/_steps/{attempt}")
    return paths


def _build_run(spark, source_root, warehouse_root, run_ts, attempt, log, source_format, match, timings, max_parallel,
               rebuild_facts, num_buckets, validate, incremental_facts, fact_parts, clusters):
    """Writes the tables of a run; returns their paths and bucketing."""
    clock = [time.perf_counter()]

    def lap(phase: str) -> None:
        now = time.perf_counter()
        if timings is not None:
            timings[phase] = round(now - clock[0], 3)
        clock[0] = now

    prev = latest_manifest(spark, warehouse_root)
    prev_buckets = latest_buckets(spark, warehouse_root)
    read = spark.read.parquet
    paths: dict[tuple[str, str], str | list[str]] = {}
    buckets: dict[tuple[str, str], Bucketing] = {}
    table_bucket = {n: (num_buckets, tuple(spec.key)) if num_buckets else None
                    for n, spec in SOURCE_TABLES.items()}

    def write(layer: str, name: str, df: DataFrame, bucket: Bucketing = None, action=None):
        seen = None
        if bucket:
            buckets[(layer, name)] = bucket
        if action is not None:
            df, seen = counted(df, action)
        return log.step(layer, name, lambda: write_version(df, warehouse_root, layer, name, attempt, bucket), seen)

    def check(step: str, checks: dict[str, DataFrame]) -> None:
        if validate:
            log.step(step, "constraints", lambda: _assert_all(checks, max_parallel))()

    # Extract + land: the landing copy is replaced every run.
    sources = scan_sources(spark, source_root, source_format)
    jobs = {}
    for name, df in sources.items():
        b = table_bucket[name]
        if b:
            jobs[name] = write("landing", name, df.repartition(b[0], *bucket_prefix(b[1])), b)
        else:
            p = version_path(warehouse_root, "landing", name, attempt)
            jobs[name] = log.step("landing", name, (lambda d, q: lambda: (land_table(d, q), q)[1])(df, p))
    for name, p in write_all(jobs, max_parallel).items():
        paths[("landing", name)] = p
    landed = {n: read_version(spark, paths[("landing", n)], table_bucket[n], source_ddl(n))
              for n in sources}
    only_changed = validate == "changed" and bool(prev)
    check("landing checks", landing_checks(landed, not only_changed) if validate else {})
    lap("extract_land")

    # Staging upserts against the previous staging version.
    staging_prev = {n: (read_version(spark, prev[("stg", n)], prev_buckets.get(("stg", n)),
                                     staging_schema_ddl(n)) if ("stg", n) in prev
                        else spark.createDataFrame([], staging_schema_ddl(n)))
                    for n in SOURCE_TABLES}
    merged = load_staging(landed, staging_prev, run_ts, with_action=True)
    for name, p in write_all({n: write("stg", n, df, table_bucket[n], "merge_action")
                              for n, df in merged.items()}, max_parallel).items():
        paths[("stg", name)] = p
    stg = {n: read_version(spark, paths[("stg", n)], table_bucket[n], staging_schema_ddl(n))
           for n in SOURCE_TABLES}
    if only_changed:
        check("changed foreign keys", changed_key_checks(landed, stg, run_ts))
    lap("staging")

    # Dimensions. Only Current rows take part in the type 2 merge. What a run
    # expires is written once, as an increment; history is never copied.
    ddl = {"dim_customer": dims.DIM_CUSTOMER_DDL, "dim_seller": dims.DIM_SELLER_DDL,
           "dim_product": dims.DIM_PRODUCT_DDL}
    final_prev = {}
    for n, d in ddl.items():
        stored = prev.get(("final", n))
        if stored is None:
            final_prev[n] = dims.empty(spark, d)
        else:  # the first path of a type 2 dimension holds its Current rows
            final_prev[n] = read(stored[0] if n in SCD2_DIMS else stored)
    if ("final", "dim_date") in prev:
        final_prev["dim_date"] = read(prev[("final", "dim_date")])
    star = build_star(spark, stg, final_prev, run_ts, match)
    star["dim_date"] = star["dim_date"].coalesce(1).sortWithinPartitions("date_id")  # one file of fixed size, in date order
    written = write_all({n: write("work" if n in SCD2_DIMS else "final", n, df,
                                  action=None if n == "dim_date" else stamp_action(run_ts)) for n, df in star.items()},
                        max_parallel)
    star = {n: read(p) for n, p in written.items()}
    increments, jobs = {}, {}
    for n in SCD2_DIMS:
        current = F.col("current_flag") == "Current"
        expired = star[n].filter(~current)
        old = list(prev.get(("final", n), []))[1:]
        if len(old) >= MAX_INCREMENTS:
            expired, old = expired.unionByName(read(*old)), []
        increments[n] = old
        jobs[n] = write("final", n, star[n].filter(current))
        jobs[f"{n}_expired"] = write("final", f"{n}_expired", expired)
    parts = write_all(jobs, max_parallel)
    for n, p in written.items():
        paths[("final", n)] = [parts[n], *increments[n], parts[f"{n}_expired"]] if n in SCD2_DIMS else p
    star = {n: read(*p) if n in SCD2_DIMS else read(p) for n, p in
            ((n, paths[("final", n)]) for n in star)}
    check("dimension checks", dimension_checks(star) if validate else {})
    _store_clusters(spark, clusters, prev, paths, write, run_ts)
    lap("dimensions")

    # Facts restated against the new Current versions, then merged.
    stored = {n: prev[("final", n)] for n in facts.FACT_KEYS if ("final", n) in prev}
    delta = incremental_facts and not rebuild_facts and len(stored) == len(facts.FACT_KEYS)
    fact_stg = stg
    if delta:
        # Affected orders and the restated rows are written once to the work
        # area and read back: computed a single time, sized from stored data.
        fact_stg = restrict_to_orders(stg, read(write("work", "affected_orders", affected_orders(stg, star, run_ts))()))
    bucket = (num_buckets, ("order_id",)) if num_buckets and not delta else None
    keys = facts.order_customer_keys(fact_stg["orders"], fact_stg["customers"], star["dim_customer"])
    if bucket:
        keys = keys.repartition(num_buckets, "order_id")
    keys = read_version(spark, write("work", "order_keys", keys, bucket)(), bucket, ORDER_KEYS_DDL)
    restated = build_facts(fact_stg, star, validate, keys)
    if delta:
        written = write_all({n: write("work", n, df) for n, df in restated.items()}, max_parallel)
        restated = {n: read(p) for n, p in written.items()}
    folders = {n: [p] if isinstance(p, str) else p for n, p in stored.items()}
    if fact_parts:
        bucket = (fact_parts, (fact_store.ORDER_KEY,))

        def store(n: str):
            seen, path = Observation(), version_path(warehouse_root, "final", n, attempt)
            few = delta and prev_buckets.get(("final", n)) == bucket  # else all rows are dealt anew

            def job():
                if few:
                    return fact_store.store_changes(restated[n], folders[n], n, path, fact_parts, run_ts,
                                                    lambda df: counted_by(df, seen))
                return fact_store.store_all(restated[n], [] if rebuild_facts else folders.get(n, []), n, path, fact_parts,
                                            run_ts, lambda df: counted_by(df, seen))
            # Without restated rows nothing is written, and so nothing counted.
            return log.step("final", n, job, None if few and restated[n].isEmpty() else seen)
        results = write_all({n: store(n) for n in facts.FACT_KEYS}, max_parallel)
        for n, (all_paths, _) in results.items():
            paths[("final", n)], buckets[("final", n)] = all_paths, bucket
        to_check = {n: read(*new) for n, (_, new) in results.items() if new}
    else:
        current = {n: fact_store.read_stored(spark, n, f) for n, f in folders.items()} if not rebuild_facts else {}
        new_facts = merge_facts(restated, current, run_ts, rebuild_facts, delta, with_action=True)
        paths |= {("final", n): p for n, p in write_all({n: write("final", n, df, action="merge_action")
                                                         for n, df in new_facts.items()}, max_parallel).items()}
        to_check = {n: read(paths[("final", n)]) for n in facts.FACT_KEYS}
    check("fact checks", fact_checks(to_check) if validate else {})
    lap("facts")
    audit = log.audit(spark, "stg")
    paths[("audit", "merge_audit")] = write_version(audit, warehouse_root, "audit", "merge_audit", attempt)
    return paths, buckets


def _store_clusters(spark, clusters, prev, paths, write, run_ts) -> None:
    """A model run's labels and assignments; without one, what is stored stays as it is."""
    labels, rows = ("final", "dim_cluster"), ("final", "cluster_assignment")
    if clusters is None:
        paths |= {k: prev[k] for k in (labels, rows) if k in prev}
        return
    ts, old = X.ts_literal(run_ts), prev.get(rows, [])
    known = spark.read.parquet(prev[labels]) if labels in prev else dims.empty(spark, dims.DIM_CLUSTER_DDL)
    new = clusters.groupBy("cluster_label", "model_version").agg(F.min("assigned_date").alias("assigned_date"))
    new = new.withColumns({"cluster_id": X.surrogate_key("cluster_label", "model_version"), "created_at": ts, "updated_at": ts})
    paths[labels] = write("final", "dim_cluster", insert_if_absent(known, new, ["cluster_label", "model_version"]),
                          action=stamp_action(run_ts))()
    given = clusters.select(X.surrogate_key("customer_id", "model_version").alias("assignment_id"), "customer_id",
                            X.surrogate_key("cluster_label", "model_version").alias("cluster_id"), "model_version",
                            "assigned_date", ts.alias("created_at"), ts.alias("updated_at"))
    if len(old) >= MAX_INCREMENTS:
        given, old = given.unionByName(spark.read.parquet(*old)), []
    paths[rows] = [*old, write("final", "cluster_assignment", given, action=stamp_action(run_ts))()]
