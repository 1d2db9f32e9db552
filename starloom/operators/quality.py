"""Data-quality checks: each returns the violating rows as a DataFrame.

Parquet tables cannot enforce PRIMARY KEY / FOREIGN KEY / UNIQUE / NOT NULL /
CHECK, so every constraint of the warehouse model is an explicit check that
runs before a merge. All checks are aggregations or anti-joins (distributed,
partial-aggregated); ``assert_quality`` only fetches one emptiness flag each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CURRENT


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def check_unique(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, with their count (PRIMARY KEY / UNIQUE).
    A NULL key component is reported as well (PRIMARY KEY implies NOT NULL)."""
    keys = _keys(key)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
            .filter((F.col("row_count") > 1) | any_null))


def check_foreign_key(child: DataFrame, fk, parent: DataFrame, pk) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row (orphans)."""
    fks, pks = _keys(fk), _keys(pk)
    non_null = child
    for c in fks:
        non_null = non_null.filter(F.col(c).isNotNull())
    parent_keys = parent.select(*[F.col(p).alias(f) for p, f in zip(pks, fks)])
    return non_null.join(parent_keys, on=fks, how="left_anti")


def check_not_null(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """One row per (row id, NULL column) for every NOT NULL column that is NULL."""
    names = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return (df.select(*id_cols, F.explode(F.filter(names, lambda x: x.isNotNull()))
                      .alias("null_column")))


def check_domain(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """CHECK (col IN (...)): rows with a non-NULL value outside the list
    (NULL passes, as in SQL CHECK semantics)."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(*allowed))


def check_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """CHECK (col BETWEEN low AND high): non-NULL values outside the range."""
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.between(low, high))


def check_single_current(dim: DataFrame, nk: str, flag_col: str = "current_flag") -> DataFrame:
    """Natural keys with more than one Current version."""
    return (dim.groupBy(nk)
            .agg(F.count_if(F.col(flag_col) == F.lit(CURRENT)).cast("bigint").alias("current_count"))
            .filter(F.col("current_count") > 1))


def check_version_intervals(dim: DataFrame, nk: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                            flag_col: str = "current_flag") -> DataFrame:
    """Versions that do not fit their key's history: ``nk, valid_from, valid_to, problem``.

    A sweep over each key's half-open intervals in order. ``reversed``: it ends before it
    begins; ``overlap``: it begins before all earlier ones have ended; ``gap``: it begins
    after that; ``empty``: it ends on the day it begins. An Expired version replaced on its
    first day, by one that begins on that day, is accepted.
    """
    start, end = F.col(valid_from), F.col(valid_to)
    by_time = Window.partitionBy(nk).orderBy(valid_from, valid_to)
    swept = dim.select(nk, valid_from, valid_to, flag_col,
                       F.max(end).over(by_time.rowsBetween(Window.unboundedPreceding, -1)).alias("__reached"),
                       F.lead(start).over(by_time).alias("__next"))
    replaced = (F.col(flag_col) != F.lit(CURRENT)) & F.coalesce(F.col("__next") == start, F.lit(False))
    problem = (F.when(end < start, F.lit("reversed")).when(start < F.col("__reached"), F.lit("overlap"))
               .when(start > F.col("__reached"), F.lit("gap")).when((start == end) & ~replaced, F.lit("empty")))
    return swept.select(nk, valid_from, valid_to, problem.alias("problem")).filter("problem IS NOT NULL")


def check_foreign_key_changed(staged: DataFrame, changed: Column, key, fk, landed: DataFrame, landed_parent: DataFrame,
                              staged_parent: DataFrame, pk, kept: Column | None = None) -> DataFrame:
    """Orphans of an extract whose predecessors were checked: the rows that
    ``check_foreign_key(landed, fk, landed_parent, pk)`` gives, as ``key`` and ``fk`` columns.

    ``staged`` and ``staged_parent`` are the tables after the extract was merged into them,
    ``changed`` tells the rows that the merge inserted or updated. Those are held against the
    parents that landed. A row that did not change had its parent when it was checked, so
    the parent is staged, and it is an orphan only if that parent did not land: the few
    parents that did not land are looked up in the children, which are not shuffled for it as
    long as adaptive execution can send those parents to them.

    ``kept``, if given, tells the rows that the merge kept without one of their key in the
    extract; without it, those that did not change are looked up in ``landed``.
    """
    keys, fks, pks = _keys(key), _keys(fk), _keys(pk)
    out = list(dict.fromkeys([*keys, *fks]))
    parents = landed_parent.select(*(F.col(p).alias(f) for p, f in zip(pks, fks)))
    fresh = check_foreign_key(staged.filter(changed), fks, landed_parent, pks).select(*out)
    absent = staged_parent.select(*(F.col(p).alias(f) for p, f in zip(pks, fks))).join(parents, fks, "left_anti")
    same = staged.filter(~changed if kept is None else ~changed & ~kept).select(*out)
    left = same.join(absent, fks, "left_semi")
    if kept is None:
        left = left.join(landed.select(*keys), keys, "left_semi")
    return fresh.unionByName(left.select(*out))


def check_parse_failures(df: DataFrame, text_col: str, parsed) -> DataFrame:
    """Rows whose non-NULL timestamp text did not parse."""
    return df.filter(F.col(text_col).isNotNull() & parsed.isNull())


class QualityError(Exception):
    pass


def assert_quality(checks: dict[str, DataFrame]) -> None:
    """Raise if any check returns rows. Fetches one row per check at most."""
    failed = [name for name, df in checks.items() if not df.isEmpty()]
    if failed:
        raise QualityError(f"data-quality checks failed: {', '.join(failed)}")
