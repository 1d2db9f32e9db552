"""Merge algebra: ``(current, incoming, run_ts) -> new state`` as lazy DataFrames.

Parquet has no MERGE, so a merge is a pure function whose output is written
to a new version directory (see ``plans.warehouse``). Every merge is one
key-partitioned full outer join: both sides shuffle once on the key (or not
at all when they are stored bucketed / co-partitioned on it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import any_changed, surrogate_key, ts_literal

# Merge actions reported by merge_audit (fixed vocabulary).
INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"

_IN = "__in_"  # prefix of incoming columns after the join
_HAS_C, _HAS_I = "__has_current", "__has_incoming"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _full_join(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    inc = incoming.select(*keys, *[F.col(c).alias(_IN + c) for c in incoming.columns if c not in keys],
                          F.lit(True).alias(_HAS_I))
    cur = current.withColumn(_HAS_C, F.lit(True))
    return cur.join(inc, on=keys, how="full_outer")


def upsert_changed(current: DataFrame, incoming: DataFrame, key, compare: Sequence[str], run_ts,
                   id_col: str = "id", created_col: str = "created_at",
                   updated_col: str = "updated_at", with_action: bool = False) -> DataFrame:
    """Change-aware upsert (INSERT ... ON CONFLICT DO UPDATE with a guarded timestamp).

    * key only in ``incoming``: inserted; ``id`` = surrogate of the key,
      ``created_at = updated_at = run_ts``.
    * key in both: data columns take the incoming values; ``id`` and
      ``created_at`` are kept; ``updated_at = run_ts`` only if some ``compare``
      column IS DISTINCT FROM (null-safe) its old value.
    * key only in ``current``: kept untouched (deletes never propagate).

    ``incoming`` must be unique on ``key`` (run ``quality.check_unique`` first).
    """
    keys = _keys(key)
    ts = ts_literal(run_ts)
    data_cols = [c for c in incoming.columns if c not in keys]
    j = _full_join(current, incoming, keys)
    has_c, has_i = F.col(_HAS_C).isNotNull(), F.col(_HAS_I).isNotNull()
    changed = any_changed(list(compare), [_IN + c for c in compare])
    action = (F.when(~has_c, F.lit(INSERTED)).when(~has_i, F.lit(KEPT))
              .when(changed, F.lit(UPDATED)).otherwise(F.lit(UNCHANGED)))
    out: list[Column] = []
    for c in current.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in data_cols:
            out.append(F.when(has_i, F.col(_IN + c)).otherwise(F.col(c)).alias(c))
        elif c == id_col:
            out.append(F.coalesce(F.col(c), surrogate_key(*keys)).alias(c))
        elif c == created_col:
            out.append(F.when(has_c, F.col(c)).otherwise(ts).alias(c))
        elif c == updated_col:
            out.append(F.when(~has_c | (has_i & changed), ts).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    if with_action:
        out.append(action.alias("merge_action"))
    return j.select(*out)


def upsert_overwrite(current: DataFrame, incoming: DataFrame, key, run_ts, id_col: str,
                     created_col: str = "created_at", updated_col: str = "updated_at",
                     with_action: bool = False) -> DataFrame:
    """Unconditional upsert: a matched row takes every incoming value and
    ``updated_at = run_ts`` (facts are restated each run); new keys are
    inserted; rows absent from ``incoming`` are kept."""
    keys = _keys(key)
    ts = ts_literal(run_ts)
    data_cols = [c for c in incoming.columns if c not in keys and c != id_col]
    j = _full_join(current, incoming.drop(id_col) if id_col in incoming.columns else incoming, keys)
    has_c, has_i = F.col(_HAS_C).isNotNull(), F.col(_HAS_I).isNotNull()
    out: list[Column] = []
    for c in current.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in data_cols:
            out.append(F.when(has_i, F.col(_IN + c)).otherwise(F.col(c)).alias(c))
        elif c == id_col:
            out.append(F.coalesce(F.col(c), surrogate_key(*keys)).alias(c))
        elif c == created_col:
            out.append(F.when(has_c, F.col(c)).otherwise(ts).alias(c))
        elif c == updated_col:
            out.append(F.when(has_i, ts).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    if with_action:
        out.append(F.when(~has_c, F.lit(INSERTED)).when(~has_i, F.lit(KEPT))
                   .otherwise(F.lit(UPDATED)).alias("merge_action"))
    return j.select(*out)


def insert_if_absent(current: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """INSERT ... ON CONFLICT DO NOTHING: add incoming rows whose key is new."""
    keys = _keys(key)
    new_rows = incoming.join(current.select(*keys), on=keys, how="left_anti")
    return current.unionByName(new_rows.select(*current.columns))


def append_rows(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append-only table: a union by column name (no key, no dedup)."""
    return current.unionByName(incoming.select(*current.columns))


# Hexadecimal digits and their complements (fixed values).
_HEX, _HEX_REVERSED = "0123456789ABCDEF", "FEDCBA9876543210"


def _reversed_text(x: Column) -> Column:
    """A text that sorts the other way round than ``x`` does (by bytes, as texts sort): the
    complements of its hexadecimal digits, and an end mark above all digits, because the
    longer of two texts that begin alike comes first."""
    return F.concat(F.translate(F.hex(x), _HEX, _HEX_REVERSED), F.lit("G"))


def _order_value(c: str, descending: bool, dtype: str) -> list[Column]:
    """Sort-key fields such that the smallest struct is the wanted row.

    Mirrors SQL ORDER BY defaults: ASC puts NULLs last, DESC puts them first.
    """
    x = F.col(c)
    if not descending:
        return [x.isNull(), x]
    if dtype == "timestamp_ntz":
        v = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") - x  # zone-free, orderable interval
    elif dtype == "timestamp":
        v = -F.unix_micros(x)
    elif dtype == "date":
        v = -F.unix_date(x)
    elif dtype in ("string", "binary"):
        v = _reversed_text(x)
    else:
        v = -x
    return [x.isNotNull(), v]


def latest_per_key(df: DataFrame, key, order: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per key: the first row under ``order`` (DISTINCT ON ... ORDER BY).

    ``order`` is a list of ``(column, 'asc'|'desc')``. Implemented as a
    ``min_by`` aggregate, so rows are combined map-side before the shuffle and
    a key holding a large share of the rows never lands whole in one task.
    """
    keys = _keys(key)
    types = dict(df.dtypes)
    fields: list[Column] = []
    for c, direction in order:
        fields.extend(_order_value(c, direction.lower() == "desc", types[c]))
    sort_key = F.struct(*[f.alias(f"o{i}") for i, f in enumerate(fields)])
    payload = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    picked = df.groupBy(*keys).agg(F.min_by(payload, sort_key).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def merge_audit(merged: dict[str, DataFrame]) -> DataFrame:
    """Row counts per (table, merge action) over merge outputs that carry a
    ``merge_action`` column: the data-level replacement of per-step summaries."""
    parts = [df.groupBy("merge_action").agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "merge_action", "row_count")
             for name, df in merged.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def upsert_delta(current: DataFrame, incoming: DataFrame, key, run_ts, id_col: str,
                 created_col: str = "created_at", updated_col: str = "updated_at",
                 with_action: bool = False) -> DataFrame:
    """Same rows as ``upsert_overwrite``, written for an
    ``incoming`` that touches few stored rows: untouched rows pass an anti-join on
    the delta's keys, touched ones are rebuilt from the delta. No join is hinted;
    adaptive execution broadcasts the delta when its measured size allows."""
    keys = _keys(key)
    ts = ts_literal(run_ts)
    untouched = current.join(incoming.select(*keys), on=keys, how="left_anti")
    given = [c for c in incoming.columns if c not in keys and c != id_col]
    old = current.join(incoming.select(*keys), on=keys, how="left_semi").select(
        *keys, *[F.col(c).alias("__old_" + c) for c in current.columns if c not in keys and c not in given])
    restated = incoming.select(*keys, *given).join(old, on=keys, how="left").select(
        *[F.coalesce(F.col("__old_" + c), surrogate_key(*keys)).alias(c) if c == id_col
          else F.coalesce(F.col("__old_" + c), ts).alias(c) if c == created_col
          else ts.alias(c) if c == updated_col
          else F.col(c) if c in keys or c in given
          else F.col("__old_" + c).alias(c) for c in current.columns],
        *([F.when(F.col("__old_" + id_col).isNull(), F.lit(INSERTED)).otherwise(F.lit(UPDATED)).alias("merge_action")]
          if with_action else []))
    if with_action:
        untouched = untouched.withColumn("merge_action", F.lit(KEPT))
    return untouched.unionByName(restated)
