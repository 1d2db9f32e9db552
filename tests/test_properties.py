"""Merge properties, checked against a brute-force Python model on random inputs."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import RUN_TS, rows
from starloom.operators.merge import latest_per_key, upsert_changed, upsert_overwrite
from starloom.operators.quality import check_single_current
from starloom.plans import dims
from test_golden import DIM, GEO, STG_C, T0

CUR = "k int, a string, b int, id string, created_at timestamp_ntz, updated_at timestamp_ntz"
T1 = datetime(2024, 6, 1)
vals_a = st.sampled_from([None, "x", "y"])
vals_b = st.sampled_from([None, 1, 2])


def _model(cur, inc):
    """Brute-force upsert: dict in, dict out."""
    out = {}
    for k, (a, b, i, c, u) in cur.items():
        out[k] = (a, b, i, c, u)
    for k, (a, b) in inc.items():
        if k in cur:
            oa, ob, i, c, u = cur[k]
            changed = (oa != a) or (ob != b)
            out[k] = (a, b, i, c, T1 if changed else u)
        else:
            out[k] = (a, b, "new", T1, T1)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.integers(0, 12), st.tuples(vals_a, vals_b), max_size=10),
       st.dictionaries(st.integers(0, 12), st.tuples(vals_a, vals_b), max_size=10))
def test_upsert_matches_model_and_is_idempotent(spark, cur_d, inc_d):
    cur_rows = {k: (a, b, f"id{k}", T0, T0) for k, (a, b) in cur_d.items()}
    cur = spark.createDataFrame([(k, *v) for k, v in cur_rows.items()], CUR)
    inc = spark.createDataFrame([(k, a, b) for k, (a, b) in inc_d.items()], "k int, a string, b int")
    out = upsert_changed(cur, inc, "k", ["a", "b"], RUN_TS)
    got = {r["k"]: (r["a"], r["b"], r["id"], r["created_at"], r["updated_at"]) for r in out.collect()}
    want = _model(cur_rows, inc_d)
    assert set(got) == set(want)                       # |new| = |current| + |inserted|
    for k in want:
        g, w = got[k], want[k]
        assert g[:2] == w[:2] and g[3:] == w[3:]
        assert (g[2] == w[2]) if w[2] != "new" else g[2] is not None
    again = upsert_changed(out, inc, "k", ["a", "b"], RUN_TS)
    assert rows(again) == rows(out)                    # idempotent


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["A", "B", None]),
                          st.integers(0, 3)), min_size=1, max_size=12))
def test_latest_per_key_matches_sort(spark, data):
    df = spark.createDataFrame([(k, c, i, datetime(2024, 1, 1 + t)) for i, (k, c, t) in
                                enumerate(data)], "k int, c string, i int, ts timestamp_ntz")
    got = rows(latest_per_key(df, "k", [("ts", "desc"), ("i", "asc")]), "k", "i")
    best = {}
    for i, (k, c, t) in enumerate(data):
        if k not in best or (-t, i) < (-best[k][0], best[k][1]):
            best[k] = (t, i)
    assert got == sorted((k, v[1]) for k, v in best.items())


def test_upsert_overwrite_always_restates(spark):
    cur = spark.createDataFrame([(1, "a", "id1", T0, T0), (2, "b", "id2", T0, T0)],
                                "k int, v string, sk string, created_at timestamp_ntz, "
                                "updated_at timestamp_ntz")
    inc = spark.createDataFrame([(1, "a", "zz"), (3, "c", "zz")], "k int, v string, sk string")
    got = {r["k"]: r for r in upsert_overwrite(cur, inc, "k", RUN_TS, id_col="sk").collect()}
    assert got[1]["updated_at"] == T1 and got[1]["sk"] == "id1" and got[1]["created_at"] == T0
    assert got[2]["updated_at"] == T0
    assert got[3]["created_at"] == T1 and got[3]["sk"] != "zz"


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["n1", "n2", "n3"]), st.sampled_from(["A", "B"]),
                          st.sampled_from([1, 2])), min_size=1, max_size=8))
def test_scd2_invariants(spark, data):
    geo = spark.createDataFrame([(1, 1.0, 1.0, "g", "G", "x", T0, T0),
                                 (2, 2.0, 2.0, "g", "G", "y", T0, T0)], GEO)
    stg = spark.createDataFrame([(str(i), nk, z, c, "S", f"i{i}", T0, T0)
                                 for i, (nk, c, z) in enumerate(data)], STG_C)
    empty = spark.createDataFrame([], DIM)
    for match in ("latest", "any"):
        d1 = dims.build_dim_customer(empty, stg, geo, RUN_TS, match)
        d2 = dims.build_dim_customer(d1, stg, geo, "2024-07-01 00:00:00", match)
        for d in (d1, d2):
            assert check_single_current(d, "customer_nk").count() == 0
            assert d.filter("current_flag = 'Current'").count() == len({nk for nk, _, _ in data})
        # history is never lost
        assert d2.count() >= d1.count()
        if match == "latest":
            assert rows(d2) == rows(d1)                # unchanged input: no new version
        # versions of a key never overlap
        for nk in {nk for nk, _, _ in data}:
            vs = sorted((r["valid_from"], r["valid_to"]) for r in
                        d2.filter(f"customer_nk = '{nk}'").collect())
            for (f1, t1), (f2, _) in zip(vs, vs[1:]):
                assert t1 <= f2
