"""Calendar dimension: generated day rows, attribute columns, unknown member."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATE_SPINE_DAYS, DATE_SPINE_START, UNKNOWN_DATE_ID
from .exprs import col

# Fixed values (must equal the reference's calendar):
QUARTER_NAMES = ("First", "Second", "Third", "Fourth")
WEEKEND, WEEKDAY = "weekend", "weekday"
UNKNOWN_MEMBER = {
    "date_id": UNKNOWN_DATE_ID, "date_actual": "1900-01-01", "day_suffix": "1st",
    "day_name": "Unknown", "day_of_year": 1, "week_of_month": 1, "week_of_year": 1,
    "week_of_year_iso": "1900-W01", "month_actual": 1, "month_name": "Unknown",
    "month_name_abbreviated": "Unk", "quarter_actual": 1, "quarter_name": "First",
    "year_actual": 1900, "first_day_of_week": "1900-01-01", "last_day_of_week": "1900-01-07",
    "first_day_of_month": "1900-01-01", "last_day_of_month": "1900-01-31",
    "first_day_of_quarter": "1900-01-01", "last_day_of_quarter": "1900-03-31",
    "first_day_of_year": "1900-01-01", "last_day_of_year": "1900-12-31",
    "mmyyyy": "011900", "mmddyyyy": "01011900", "weekend_indr": "weekday",
}

DIM_DATE_COLUMNS = list(UNKNOWN_MEMBER)
_DATE_COLS = {c for c in DIM_DATE_COLUMNS if c.startswith(("first_day", "last_day"))} | {"date_actual"}
_STRING_COLS = {"day_suffix", "day_name", "week_of_year_iso", "month_name",
                "month_name_abbreviated", "quarter_name", "mmyyyy", "mmddyyyy", "weekend_indr"}


def date_spine(spark: SparkSession, start: str = DATE_SPINE_START,
               days: int = DATE_SPINE_DAYS) -> DataFrame:
    """One row per day: ``start`` + 0 .. ``days - 1`` (29,220 days by default)."""
    return (spark.range(0, days, numPartitions=max(1, days // 8192))
            .select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("d")))


def day_suffix(d) -> Column:
    """Day of month with its English ordinal suffix: 1st, 2nd, 3rd, 4th, 11th..."""
    day = F.dayofmonth(col(d))
    suffix = (F.when((day % 100).between(11, 13), "th").when(day % 10 == 1, "st")
              .when(day % 10 == 2, "nd").when(day % 10 == 3, "rd").otherwise("th"))
    return F.concat(day.cast("string"), suffix)


def calendar_columns(d) -> list[Column]:
    """All dim_date attribute columns for the date column ``d``."""
    d = col(d)
    q = F.quarter(d)
    wd = F.weekday(d)  # 0 = Monday .. 6 = Sunday (ISO day - 1)
    first_q = F.trunc(d, "quarter")
    year = F.year(d)
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d.alias("date_actual"),
        day_suffix(d).alias("day_suffix"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofyear(d).alias("day_of_year"),
        (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int").alias("week_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("-W"),
                 F.lpad(F.weekofyear(d).cast("string"), 2, "0")).alias("week_of_year_iso"),
        F.month(d).alias("month_actual"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_abbreviated"),
        q.alias("quarter_actual"),
        F.element_at(F.array(*[F.lit(n) for n in QUARTER_NAMES]), q).alias("quarter_name"),
        year.alias("year_actual"),
        F.date_sub(d, wd).alias("first_day_of_week"),
        F.date_add(d, 6 - wd).alias("last_day_of_week"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        first_q.alias("first_day_of_quarter"),
        F.date_sub(F.add_months(first_q, 3), 1).alias("last_day_of_quarter"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("first_day_of_year"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("last_day_of_year"),
        F.date_format(d, "MMyyyy").alias("mmyyyy"),
        F.date_format(d, "MMddyyyy").alias("mmddyyyy"),
        F.when(wd >= 5, F.lit(WEEKEND)).otherwise(F.lit(WEEKDAY)).alias("weekend_indr"),
    ]


def unknown_member(spark: SparkSession) -> DataFrame:
    """The single 'unknown date' row (date_id -1, 1900-01-01)."""
    cols = []
    for name, v in UNKNOWN_MEMBER.items():
        c = F.lit(v)
        if name in _DATE_COLS:
            c = c.cast("date")
        elif name not in _STRING_COLS:
            c = c.cast("int")
        cols.append(c.alias(name))
    return spark.range(1).select(*cols)


def build_dim_date(spark: SparkSession, start: str = DATE_SPINE_START,
                   days: int = DATE_SPINE_DAYS) -> DataFrame:
    """Calendar rows plus the unknown member (29,221 rows by default).

    The row count is fixed by ``days``, never by the data, so the table is
    safe to broadcast in every date lookup.
    """
    from ..operators.merge import insert_if_absent
    spine = date_spine(spark, start, days).select(*calendar_columns("d"))
    if start > UNKNOWN_MEMBER["date_actual"]:
        # Spine keys are yyyymmdd of later days, never -1: no conflict possible.
        return spine.unionByName(unknown_member(spark))
    return insert_if_absent(spine, unknown_member(spark), ["date_id"])
