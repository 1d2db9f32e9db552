"""Dimension lookups: date role lookups, Current-version lookups, as-of lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import col
from ..schemas import UNKNOWN_DATE_ID
from .scd import FLAG, VALID_FROM, VALID_TO, current_rows


def date_keys(dim_date: DataFrame) -> DataFrame:
    """(date_actual, date_id) pairs for lookups. The calendar is generated: its
    size is fixed by ``DATE_SPINE_DAYS``, so it is always broadcast."""
    return F.broadcast(dim_date.select("date_actual", "date_id"))


def _lookup_with_keys(df: DataFrame, when, out_col: str, keys: DataFrame) -> DataFrame:
    # The build side is the same plan for every role (only the alias differs),
    # so all role lookups share one broadcast exchange.
    k = keys.alias("__cal_" + out_col)
    joined = df.join(k, col(when).cast("date") == F.col(f"__cal_{out_col}.date_actual"), "left")
    return joined.select(*[df[c] for c in df.columns],
                         F.coalesce(F.col(f"__cal_{out_col}.date_id"),
                                    F.lit(UNKNOWN_DATE_ID)).cast("int").alias(out_col))


def lookup_date(df: DataFrame, when, out_col: str, dim_date: DataFrame) -> DataFrame:
    """Add ``out_col`` = date_id of the day of ``when`` (timestamp or date);
    NULL or out-of-calendar days map to the unknown member -1."""
    return _lookup_with_keys(df, when, out_col, date_keys(dim_date))


def lookup_dates(df: DataFrame, roles: dict[str, object], dim_date: DataFrame) -> DataFrame:
    """Role-playing lookups: one left join per ``{out_col: when}``, all against
    the same calendar keys."""
    keys = date_keys(dim_date)
    for out_col, when in roles.items():
        df = _lookup_with_keys(df, when, out_col, keys)
    return df


def current_key_map(dim: DataFrame, nk: str, sk: str, out_key: str, out_sk: str) -> DataFrame:
    """natural key -> surrogate key of the Current version."""
    return current_rows(dim).select(F.col(nk).alias(out_key), F.col(sk).alias(out_sk))


def lookup_current(df: DataFrame, key: str, dim: DataFrame, nk: str, sk: str,
                   out_col: str) -> DataFrame:
    """Inner join to the Current version (``dim.nk = df.key AND flag='Current'``).
    The flag filter runs before the join so only active rows are shuffled."""
    return df.join(current_key_map(dim, nk, sk, key, out_col), on=key, how="inner")


def current_version_attributes(df: DataFrame, version_col: str, dim: DataFrame, sk: str,
                               nk: str, attrs: list[str]) -> DataFrame:
    """Attach attributes of the *Current* version to rows that reference any
    version of a type 2 dimension (version key -> natural key -> Current). Rows
    without a version, or whose key has no Current one, keep NULL attributes."""
    versions = dim.select(F.col(sk).alias(version_col), F.col(nk).alias("__nk"))
    cur = current_rows(dim).select(F.col(nk).alias("__nk"), *attrs)
    return df.join(versions, version_col, "left").join(cur, "__nk", "left").drop("__nk")


def versions_on(days: DataFrame, dim: DataFrame, nk: str, sk: str, open_first: bool = True,
                attrs: tuple[str, ...] = ()) -> DataFrame:
    """The version valid on each of the distinct (``__key, __day``) of ``days``: those, with
    ``__sk`` and ``attrs``; days without a version are left out.

    Days and versions of a key are one stream in time order, and the latest version is
    carried forward over the days that follow it. A key's stream holds its versions and
    at most one row per calendar day, however many events it has.
    """
    start, kind = F.col("__day"), F.col("__kind")
    version = F.struct(F.col(sk).alias("__sk"), F.col(VALID_FROM).alias("from"), F.col(VALID_TO).alias("to"),
                       *(F.col(a).alias(a) for a in attrs))
    # Empty versions (changed again on their first day) are never valid, but a key begins with its first one.
    starts = dim.select(F.col(nk).alias("__key"), F.col(VALID_FROM).alias("__day"), F.lit(0).alias("__kind"),
                        F.when(F.col(VALID_FROM) < F.col(VALID_TO), version).alias("__version"))
    stream = days.select("__key", "__day", F.lit(1).alias("__kind")).unionByName(starts, allowMissingColumns=True)
    by_time = Window.partitionBy("__key").orderBy("__day", "__kind", F.col("__version.to"))
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stream = stream.withColumns({
        "__latest": F.last("__version", ignorenulls=True).over(so_far),
        "__first": F.first("__version", ignorenulls=True).over(whole),
        "__began": F.min(F.when(kind == 0, start)).over(whole)})
    opened = F.lit(open_first) & F.col("__latest").isNull() & (F.col("__first.from") == F.col("__began"))
    found = F.when(opened, F.col("__first")).otherwise(F.col("__latest"))
    out = stream.filter(kind == 1).select("__key", "__day", found.alias("__v")).filter(start < F.col("__v.to"))
    return out.select("__key", "__day", "__v.__sk", *(f"__v.{a}" for a in attrs))


def lookup_as_of(df: DataFrame, key: str, when, dim: DataFrame, nk: str, sk: str,
                 out_col: str, open_first: bool = True, how: str = "left",
                 attrs: tuple[str, ...] = ()) -> DataFrame:
    """Point-in-time lookup: the version valid on ``when`` (half-open
    ``[valid_from, valid_to)``).

    ``valid_from`` is the load date of a version, so with ``open_first`` the
    first version of each key also covers every earlier event. Versions with
    ``valid_from = valid_to`` (changed twice on one day) never match. ``attrs``
    are columns of the matched version to bring along.

    Versions are found for the distinct (key, day) of the events and joined back on both,
    at most one to an event: no event meets a version that it does not get, and a key
    with a third of all events is cut by day (a day with as many by adaptive execution).
    """
    day = col(when).cast("date")
    asked = df.select(F.col(key).alias("__key"), day.alias("__day")).filter("__key IS NOT NULL AND __day IS NOT NULL")
    found = versions_on(asked.distinct(), dim, nk, sk, open_first, attrs).withColumnRenamed("__sk", out_col)
    return df.join(found, (F.col(key) == F.col("__key")) & (day == F.col("__day")), how).drop("__key", "__day")


__all__ = ["lookup_date", "lookup_dates", "lookup_current", "lookup_as_of", "versions_on", "current_key_map",
           "current_version_attributes", "date_keys", "FLAG"]
