"""Facts stored by hash partition of the order they belong to, with changes beside them.

A fact version is a set of folders, one per hash partition of ``order_nk``
(``<root>/final/<fact>/<attempt>/part_no=<k>``), and up to ``MAX_CHANGES`` folders of
changed rows (``<root>/final/<fact>/<attempt>/changes``), oldest first; the manifest names
them one by one. A run that restates few orders reads key and stamp of those orders'
partitions, and writes and checks the restated rows only: its cost follows the change, even
when the changed orders are spread over all partitions. When the folders of changes are
many, they are folded into the partitions they touch; all others keep their paths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import surrogate_key, ts_literal
from ..operators.merge import INSERTED, UPDATED, latest_per_key, upsert_overwrite
from . import facts

PART, CHANGES = "part_no", "changes"
#: Folders of changes that a fact keeps before they are folded into its partitions.
MAX_CHANGES = 12
ORDER_KEY = "order_nk"


def part_of(n_parts: int, key: str = ORDER_KEY) -> Column:
    """The partition of an order key: Spark's own hash partitioning function."""
    return F.pmod(F.hash(F.col(key)), F.lit(n_parts))


def write_parts(df: DataFrame, path: str, n_parts: int) -> dict[int, str]:
    """Write ``df`` by partition below ``path`` (which must not exist); returns the folders
    by partition. Rows are rebalanced by partition, so small ones share a task and
    a large one (an order with very many rows) is split over several files."""
    out = df.withColumn(PART, part_of(n_parts)).hint("rebalance", F.col(PART))
    out.write.partitionBy(PART).parquet(path)
    return list_parts(df.sparkSession, path)


def list_parts(spark: SparkSession, path: str) -> dict[int, str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return {int(x.split("=")[1]): f"{path}/{x}" for x in names if x.startswith(f"{PART}=")}


def split_paths(paths: list[str]) -> tuple[dict[int, str], list[str]]:
    """(partition folders by number, folders of changes) of a fact's manifest paths. The only
    folder of a fact that isn't stored by partition counts as partition -1."""
    parts = {int(p.rsplit(f"{PART}=", 1)[1]) if f"{PART}=" in p else -1: p for p in paths if not p.endswith(f"/{CHANGES}")}
    return parts, [p for p in paths if p.endswith(f"/{CHANGES}")]


def with_audit(df: DataFrame) -> DataFrame:
    """The columns of a stored fact: those of a restated one and its two stamps."""
    none = F.lit(None).cast("timestamp_ntz")
    return df.withColumn("created_at", none).withColumn("updated_at", none)


def latest_changes(changes: DataFrame, name: str) -> DataFrame:
    return latest_per_key(changes, facts.FACT_KEYS[name][0], [("updated_at", "desc")])


def read_stored(spark: SparkSession, name: str, paths: list[str], like: DataFrame | None = None) -> DataFrame:
    """The rows of a stored fact: those of its partitions that no change replaces, and the
    latest changes. Without rows, none with the columns of ``like``."""
    parts, changes = split_paths(paths)
    if not parts and not changes:
        return like.limit(0)
    if not changes:
        return spark.read.parquet(*parts.values())
    latest = latest_changes(spark.read.parquet(*changes), name)
    if not parts:
        return latest
    key = list(facts.FACT_KEYS[name][0])
    old = spark.read.parquet(*parts.values())
    return old.join(latest.select(*key), key, "left_anti").unionByName(latest)


def _as_changes(restated: DataFrame, known: DataFrame | None, name: str, run_ts) -> DataFrame:
    """Restated rows as they are stored: with the surrogate and ``created_at`` of the row they
    replace, if there is one, and a ``merge_action``."""
    key, sk = facts.FACT_KEYS[name]
    key, ts = list(key), ts_literal(run_ts)
    rows = restated.drop(sk)
    if known is not None:
        ours = known.select(*key, F.col(sk).alias("__sk"), F.col("created_at").alias("__created")).join(
            restated.select(*key), key, "left_semi")
        ours = ours.groupBy(*key).agg(F.min("__sk").alias("__sk"), F.min("__created").alias("__created"))
        rows = rows.join(ours, key, "left")
    else:
        rows = rows.withColumns({"__sk": F.lit(None).cast("string"), "__created": F.lit(None).cast("timestamp_ntz")})
    own = [F.coalesce("__sk", surrogate_key(*key)).alias(c) if c == sk else F.col(c) for c in restated.columns]
    return rows.select(*own, F.coalesce("__created", ts).alias("created_at"), ts.alias("updated_at"),
                       F.when(F.col("__sk").isNull(), F.lit(INSERTED)).otherwise(F.lit(UPDATED)).alias("merge_action"))


def store_all(restated: DataFrame, paths: list[str], name: str, path: str, n_parts: int, run_ts,
              watch: Callable[[DataFrame], DataFrame]) -> tuple[list[str], list[str]]:
    """Merge a whole restated fact and write every partition anew: (paths of the new version,
    those written now). ``watch`` gets rows with a ``merge_action`` and returns them without."""
    key, sk = facts.FACT_KEYS[name]
    old = read_stored(restated.sparkSession, name, paths, with_audit(restated))
    merged = upsert_overwrite(old, restated, list(key), run_ts, id_col=sk, with_action=True)
    written = write_parts(watch(merged), path, n_parts)
    written = [written[k] for k in sorted(written)]
    return written, written


def store_changes(restated: DataFrame, paths: list[str], name: str, path: str, n_parts: int, run_ts,
                  watch: Callable[[DataFrame], DataFrame], max_changes: int | None = None) -> tuple[list[str], list[str]]:
    """Store the restated rows of a few orders beside the partitions; same results as ``store_all``.

    ``restated`` is read more than once, so it should be a stored table. The driver sees the
    numbers of the touched partitions, at most ``n_parts``.
    """
    spark = restated.sparkSession
    parts, changes = split_paths(paths)
    touched = {r[0] for r in restated.select(part_of(n_parts)).distinct().collect()}
    if not touched:
        return paths, []
    known = [parts[k] for k in sorted(touched & parts.keys())] + changes
    rows = _as_changes(restated, spark.read.parquet(*known) if known else None, name, run_ts)
    watch(rows).write.parquet(f"{path}/{CHANGES}")
    changes = [*changes, f"{path}/{CHANGES}"]
    if len(changes) <= (MAX_CHANGES if max_changes is None else max_changes):
        return [*paths, changes[-1]], [changes[-1]]
    return fold(spark, parts, changes, name, f"{path}/folded", n_parts), [changes[-1]]


def fold(spark: SparkSession, parts: dict[int, str], changes: list[str], name: str, path: str, n_parts: int) -> list[str]:
    """Rewrite the partitions that changes touch, with the changes in them."""
    touched = {r[0] for r in spark.read.parquet(*changes).select(part_of(n_parts)).distinct().collect()}
    rows = read_stored(spark, name, [parts[k] for k in touched & parts.keys()] + changes)
    parts = {**parts, **write_parts(rows, path, n_parts)}
    return [parts[k] for k in sorted(parts)]
