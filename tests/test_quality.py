"""Quality checks on small hand-written tables, including assert_quality."""

import pytest

from helpers import rows
from starloom.functions.exprs import parse_ts
from starloom.operators.quality import (QualityError, assert_quality, check_domain,
                                        check_foreign_key, check_not_null, check_parse_failures,
                                        check_range, check_single_current, check_unique)


def test_checks_report_violating_rows(spark):
    child = spark.createDataFrame([("a", "p1", 3, "x"), ("b", "p9", 7, None), ("c", None, None, "y"),
                                   ("c", "p1", 0, "z")], "k string, fk string, n int, t string")
    parent = spark.createDataFrame([("p1",)], "pk string")
    assert rows(check_unique(child, "k"), "k", "row_count") == [("c", 2)]
    assert rows(check_foreign_key(child, "fk", parent, "pk"), "k") == [("b",)]   # NULL fk passes
    assert rows(check_not_null(child, ["fk", "t"], ["k"])) == [("b", "t"), ("c", "fk")]
    assert rows(check_domain(child, "t", ["x", "y"]), "k") == [("c",)]        # NULL passes
    assert rows(check_range(child, "n", 1, 5), "k", "n") == [("b", 7), ("c", 0)]


def test_parse_failures_and_single_current(spark):
    df = spark.createDataFrame([("1", "2020-01-01 10:00:00"), ("2", "not a time"), ("3", None),
                                ("4", "2020-02-30 00:00:00")], "k string, t string")
    assert rows(check_parse_failures(df, "t", parse_ts("t")), "k") == [("2",), ("4",)]
    dim = spark.createDataFrame([("a", "Current"), ("a", "Current"), ("b", "Current"), ("b", "Expired")],
                                "nk string, current_flag string")
    assert rows(check_single_current(dim, "nk")) == [("a", 2)]


def test_assert_quality_names_failed_checks(spark):
    ok = spark.createDataFrame([], "k string")
    bad = spark.createDataFrame([("x",)], "k string")
    assert_quality({"fine": ok})
    with pytest.raises(QualityError, match="broken"):
        assert_quality({"fine": ok, "broken": bad})
