"""Column expressions shared by merges, dimensions and facts.

All are built-in Spark expressions (JVM side, whole-stage codegen); none is a
Python UDF.
"""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (labels and scores that must equal the reference's):
ON_TIME, LATE = "On Time", "Late"
WITHIN_THRESHOLD, SIGNIFICANTLY_LATE = "Within Threshold", "Significantly Late"
LATE_THRESHOLD_DAYS = 3
CRITICAL, STANDARD = "Critical", "Standard"
HAS_COMMENT, NO_COMMENT = "Has Comment", "No Comment"
MULTI_SELLER, SINGLE_SELLER = "Multi Seller", "Single Seller"
SENTIMENT_POSITIVE, SENTIMENT_NEUTRAL, SENTIMENT_NEGATIVE = 1.0, 0.0, -1.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(ts) -> Column:
    """A run timestamp as a TIMESTAMP_NTZ literal (wall clock, zone free)."""
    if isinstance(ts, datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(str(ts)).cast("timestamp_ntz")


def date_literal(d) -> Column:
    if isinstance(d, (date, datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.lit(str(d)).cast("date")


def surrogate_key(*cols) -> Column:
    """Deterministic surrogate key: md5 of the '|'-joined key values.

    Replaces random UUID defaults so a retried task writes the same key.
    """
    return F.md5(F.concat_ws("|", *[col(c).cast("string") for c in cols]))


def any_changed(left_cols: list, right_cols: list) -> Column:
    """Null-safe 'IS DISTINCT FROM' over column pairs, OR-ed together."""
    diffs = [~col(a).eqNullSafe(col(b)) for a, b in zip(left_cols, right_cols)]
    return reduce(lambda x, y: x | y, diffs, F.lit(False))


def parse_ts(c) -> Column:
    """Text timestamp ('yyyy-MM-dd HH:mm:ss', or date only) -> TIMESTAMP_NTZ.

    Unparseable text gives NULL instead of failing the job (ANSI mode).
    """
    return col(c).try_cast("timestamp_ntz")


def days_between(later, earlier) -> Column:
    """Whole 24-hour days in ``later - earlier``, truncated toward zero.

    This is the day field of the interval, not a calendar-day difference.
    NULL when either side is NULL.
    """
    return F.extract(F.lit("DAY"), col(later) - col(earlier)).cast("int")


def delivery_status(delivered, estimated) -> Column:
    d, e = col(delivered), col(estimated)
    both = d.isNotNull() & e.isNotNull()
    return (F.when(both & (d <= e), F.lit(ON_TIME))
            .when(both & (d > e), F.lit(LATE)))


def late_severity(delivered, estimated, threshold_days: int = LATE_THRESHOLD_DAYS) -> Column:
    d, e = col(delivered), col(estimated)
    both = d.isNotNull() & e.isNotNull()
    inner = (F.when(d <= e, F.lit(ON_TIME))
             .when(d <= e + F.make_dt_interval(F.lit(threshold_days)), F.lit(WITHIN_THRESHOLD))
             .otherwise(F.lit(SIGNIFICANTLY_LATE)))
    return F.when(both, inner)


def sentiment_score(score) -> Column:
    s = col(score)
    return (F.when(s >= 4, F.lit(SENTIMENT_POSITIVE)).when(s == 3, F.lit(SENTIMENT_NEUTRAL))
            .when(s <= 2, F.lit(SENTIMENT_NEGATIVE)).otherwise(F.lit(SENTIMENT_NEUTRAL)))


def review_severity(score) -> Column:
    return F.when(col(score) <= 2, F.lit(CRITICAL)).otherwise(F.lit(STANDARD))


def text_length(text) -> Column:
    """Length in characters; 0 for NULL."""
    return F.coalesce(F.length(col(text)), F.lit(0)).cast("int")


def comment_status(text) -> Column:
    """'Has Comment' only for text that is non-blank after trimming spaces."""
    t = col(text)
    return (F.when(t.isNotNull() & (F.length(F.trim(t)) > 0), F.lit(HAS_COMMENT))
            .otherwise(F.lit(NO_COMMENT)))


def multi_seller_label(min_seller, max_seller) -> Column:
    """'Multi Seller' iff more than one distinct non-null seller (min <> max)."""
    return (F.when(col(min_seller) != col(max_seller), F.lit(MULTI_SELLER))
            .otherwise(F.lit(SINGLE_SELLER)))
