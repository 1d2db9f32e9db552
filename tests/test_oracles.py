"""Every registered query against its SQL oracle (DuckDB) at sf0.001, and
the calendar against a brute-force DuckDB calendar."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

import __spark_entry__ as E  # noqa: E402
from compare import _rows, compare, duck_connect  # noqa: E402
from starloom.plans.oracles import ORACLES  # noqa: E402
from starloom.plans.registry import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "delivery_status" in df.columns


# A representative subset runs by default; STARLOOM_FULL_ORACLE=1 runs all
# registered queries (the driver's gate runs all of them at sf0.01).
SUBSET = ["scan_table", "csv_roundtrip", "role_playing_dates", "dim_date", "days_between",
          "late_severity", "change_detect", "latest_per_key", "stg_order_items", "merge_audit",
          "dim_product_scd1", "dim_customer_scd2", "dim_customer_scd2_any", "dim_seller_scd2",
          "fct_order_payments", "fct_order_delivery", "fct_order_reviews_merge",
          "dq_single_current", "fct_items_as_of", "segment_transitions", "on_time_by_state"]
NAMES = sorted(QUERIES) if os.environ.get("STARLOOM_FULL_ORACLE") else SUBSET


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)
    assert res[name][0] == "OK", res[name]


def test_dim_date_full_calendar(spark):
    from starloom.functions.calendar import build_dim_date
    from starloom.plans.oracles import sql
    con = duck_connect(SF)
    rel = con.execute(sql("SELECT * FROM dim_date"))
    cols = [d[0] for d in rel.description]
    duck = [dict(zip(cols, r)) for r in rel.fetchall()]
    df = build_dim_date(spark)
    mine = [r.asDict() for r in df.collect()]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(mine, sorted(cols)) == _rows(duck, sorted(cols))
