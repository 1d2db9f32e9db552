"""Slowly changing dimensions (type 1 overwrite, type 2 versioning)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import any_changed, date_literal, surrogate_key, ts_literal
from ..schemas import CURRENT, END_OF_TIME, EXPIRED
from .merge import latest_per_key, upsert_changed

FLAG, VALID_FROM, VALID_TO = "current_flag", "valid_from", "valid_to"


def current_rows(dim: DataFrame, flag_col: str = FLAG) -> DataFrame:
    """Rows of the active version (``current_flag = 'Current'``)."""
    return dim.filter(F.col(flag_col) == F.lit(CURRENT))


def scd1_merge(current: DataFrame, source: DataFrame, nk: str, attrs: Sequence[str], run_ts,
               sk_col: str) -> DataFrame:
    """Type 1: overwrite attributes in place, one row per natural key, no history.
    ``updated_at`` moves only when an attribute really changed."""
    return upsert_changed(current, source, nk, attrs, run_ts, id_col=sk_col)


def scd2_merge(current: DataFrame, source: DataFrame, nk: str, tracked: Sequence[str], run_ts,
               sk_col: str, order: Sequence[tuple[str, str]] | None = None,
               match: str = "latest") -> DataFrame:
    """Type 2 versioning.

    ``current`` holds every version (sk, nk, attributes, valid_from, valid_to,
    current_flag, created_at, updated_at). ``source`` carries ``nk`` and the
    attribute columns under the dimension's names, plus any ``order`` columns.

    1. Pick one source row per natural key by ``order`` (skip when the source is
       already unique on ``nk``).
    2. Expire: the Current version of a key whose tracked attributes differ
       (null-safe) gets ``valid_to = run date``, flag Expired, ``updated_at = run_ts``.
       ``match='latest'`` compares with the picked row; ``match='any'`` expires
       when any source row of that key differs.
    3. Insert a Current version (``valid_from = run date``, ``valid_to = 9999-12-31``)
       for every picked key left without a Current version.
    A version's surrogate is made of its natural key and the run timestamp, so two
    changes on one day give two keys. A NULL natural key in ``source`` fails the job.

    4. Expired history and keys absent from the source pass through untouched.

    Only Current rows take part in the join; history is a plain union. The
    join is one full outer join on ``nk`` with both sides unique on it.
    """
    if match not in ("latest", "any"):
        raise ValueError("match must be 'latest' or 'any'")
    ts, run_date = ts_literal(run_ts), ts_literal(run_ts).cast("date")
    attrs = [c for c in current.columns
             if c not in (sk_col, nk, VALID_FROM, VALID_TO, FLAG, "created_at", "updated_at")]
    history = current.filter(F.col(FLAG) != F.lit(CURRENT))
    active = current_rows(current)
    src = source.select(nk, *attrs, *[c for c, _ in (order or []) if c not in attrs and c != nk])
    src = src.withColumn(nk, F.when(F.col(nk).isNull(), F.raise_error(
        F.lit(f"NULL natural key {nk}"))).otherwise(F.col(nk)))
    picked = latest_per_key(src, nk, order) if order else src
    picked = picked.select(nk, *attrs)

    new = picked.select(nk, *[F.col(a).alias("__new_" + a) for a in attrs],
                        F.lit(True).alias("__has_src"))
    j = active.join(new, on=nk, how="full_outer")
    if match == "latest":
        changed = any_changed(list(tracked), ["__new_" + a for a in tracked])
    else:
        # Per key: does any source row differ from the Current version?
        cmp = (active.select(nk, *tracked)
               .join(src.select(nk, *[F.col(a).alias("__s_" + a) for a in tracked]), on=nk)
               .groupBy(nk)
               .agg(F.max(any_changed(list(tracked), ["__s_" + a for a in tracked]).cast("int"))
                    .alias("__any_diff")))
        j = j.join(cmp, on=nk, how="left")
        changed = F.coalesce(F.col("__any_diff") == 1, F.lit(False))

    has_cur, has_src = F.col(sk_col).isNotNull(), F.col("__has_src").isNotNull()
    expire = has_cur & has_src & changed
    insert = has_src & (~has_cur | expire)
    old_version = F.when(has_cur, F.struct(
        F.col(sk_col).alias(sk_col), *[F.col(a).alias(a) for a in attrs],
        F.col(VALID_FROM).alias(VALID_FROM),
        F.when(expire, run_date).otherwise(F.col(VALID_TO)).alias(VALID_TO),
        F.when(expire, F.lit(EXPIRED)).otherwise(F.col(FLAG)).alias(FLAG),
        F.col("created_at").alias("created_at"),
        F.when(expire, ts).otherwise(F.col("updated_at")).alias("updated_at")))
    new_version = F.when(insert, F.struct(
        surrogate_key(nk, ts).alias(sk_col), *[F.col("__new_" + a).alias(a) for a in attrs],
        run_date.alias(VALID_FROM), date_literal(END_OF_TIME).alias(VALID_TO),
        F.lit(CURRENT).alias(FLAG), ts.alias("created_at"), ts.alias("updated_at")))
    versions = (j.select(nk, F.explode(F.filter(F.array(old_version, new_version),
                                                lambda v: v.isNotNull())).alias("__v"))
                .select(nk, "__v.*"))
    return history.unionByName(versions.select(*current.columns))


def scd2_replay(current: DataFrame, changes: DataFrame, nk: str, tracked: Sequence[str], sk_col: str,
                at: str = "run_ts", order: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Type 2 versioning of many source days in one pass: what ``scd2_merge`` gives when it is
    run once per ``at``, oldest first, on that day's rows of ``changes``.

    ``changes`` holds ``nk``, the attributes, ``at`` (a run timestamp, later than the stored
    rows' ``created_at``) and the ``order`` columns; a key absent on a day keeps its
    version. Of a key's rows, in time order, those whose tracked attributes differ from the
    row before begin a version, which lasts until the next one begins. One shuffle by key;
    a key's group holds at most one row a day. A NULL natural key fails the job.
    """
    attrs = [c for c in current.columns
             if c not in (sk_col, nk, VALID_FROM, VALID_TO, FLAG, "created_at", "updated_at")]
    rows = changes.withColumn(nk, F.when(F.col(nk).isNull(), F.raise_error(
        F.lit(f"NULL natural key {nk}"))).otherwise(F.col(nk)))
    rows = latest_per_key(rows, [nk, at], order) if order else rows
    rows = rows.select(nk, F.col(at).cast("timestamp_ntz").alias("__at"), *attrs)
    stored = current_rows(current).select(nk, F.col("created_at").alias("__at"), *attrs, F.col(sk_col).alias("__sk"),
                                          F.col(VALID_FROM).alias("__from"), F.col(VALID_TO).alias("__to"),
                                          F.col("updated_at").alias("__updated"))
    by_time = Window.partitionBy(nk).orderBy(F.col("__sk").isNull(), "__at")
    state = F.struct(*tracked)
    stream = stored.unionByName(rows, allowMissingColumns=True)
    begins = stream.withColumn("__before", F.lag(state).over(by_time)).filter(~state.eqNullSafe(F.col("__before")))
    versions = begins.withColumn("__until", F.lead("__at").over(by_time))
    ended = F.col("__until").isNotNull()
    out = {
        sk_col: F.coalesce("__sk", surrogate_key(nk, "__at")), nk: F.col(nk), **{a: F.col(a) for a in attrs},
        VALID_FROM: F.coalesce("__from", F.col("__at").cast("date")),
        VALID_TO: F.when(ended, F.col("__until").cast("date")).otherwise(F.coalesce("__to", date_literal(END_OF_TIME))),
        FLAG: F.when(ended, F.lit(EXPIRED)).otherwise(F.lit(CURRENT)),
        "created_at": F.col("__at"),
        "updated_at": F.coalesce("__until", "__updated", "__at"),
    }
    history = current.filter(F.col(FLAG) != F.lit(CURRENT))
    return history.unionByName(versions.select(*(out[c].alias(c) for c in current.columns)))
