"""As-of streams, replayed histories, interval sweeps, changed keys, text order, text-keyed scans, CSV lines."""

import random
from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import rows
from starloom.operators.lookup import lookup_as_of
from starloom.operators.merge import latest_per_key
from starloom.operators.quality import QualityError, check_foreign_key, check_foreign_key_changed, check_version_intervals
from starloom.operators.scd import scd2_merge, scd2_replay
from starloom.plans import dims
from starloom.schemas import SOURCE_TABLES, T
from starloom.sources.tables import (cut_query, range_predicates, read_csv_table, sample_cuts, scan_partitioned,
                                     write_csv_table)

START = date(2000, 1, 1)
DIM = "nk string, sk string, valid_from date, valid_to date, color string"


def _versions():
    """A key with 1,000 versions (some empty, some gaps), one with a few, one whose first is empty."""
    out, at = [], START
    for i in range(1000):
        end = at + timedelta(days=i % 4)
        out.append(("hot", f"hot{i}", at, end, f"c{i}"))
        at = end + timedelta(days=5 if i % 50 == 7 else 0)
    out += [("a", "a1", START, START + timedelta(9), "x"), ("a", "a2", START + timedelta(9), date(9999, 12, 31), "y"),
            ("b", "b1", START, START, "x"), ("b", "b2", START, date(9999, 12, 31), "y"),
            ("c", "c1", START, START, "x"), ("c", "c2", START + timedelta(3), date(9999, 12, 31), "y")]
    return out


def test_as_of_a_key_with_a_third_of_events_and_a_thousand_versions(spark):
    rng = random.Random(4)
    versions = _versions()
    events = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "none", None]),
               None if i % 97 == 0 else datetime(2000, 1, 1) + timedelta(days=rng.randrange(-20, 1700), hours=rng.randrange(24)))
              for i in range(6000)]
    first = {}
    for nk, _, frm, _, _ in versions:
        first[nk] = min(first.get(nk, frm), frm)
    by_key = {}
    for v in versions:
        by_key.setdefault(v[0], []).append(v)

    def brute(key, when, open_first):
        for _, sk, frm, to, color in by_key.get(key, []) if when else []:
            if frm < to and when.date() < to and (frm <= when.date() or (open_first and frm == first[key])):
                return sk, color
        return None, None
    dim = spark.createDataFrame(versions, DIM)
    df = spark.createDataFrame(events, "id long, key string, at timestamp_ntz").repartition(4)
    for open_first in (True, False):
        got = lookup_as_of(df, "key", "at", dim, "nk", "sk", "version", open_first, attrs=("color",))
        assert got.columns == ["id", "key", "at", "version", "color"]
        found = {r["id"]: (r["version"], r["color"]) for r in got.collect()}
        assert found == {i: brute(k, t, open_first) for i, k, t in events}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    inner = lookup_as_of(df, "key", "at", dim, "nk", "sk", "version", how="inner")
    assert inner.count() == sum(brute(k, t, True)[0] is not None for _, k, t in events)


SELLER = "seller_nk string, seller_city string, seller_state string, seller_latitude double, seller_longitude double"


def test_replay_equals_day_by_day_merges(spark):
    rng = random.Random(9)
    tracked = ["seller_city", "seller_latitude"]
    start = spark.createDataFrame([(f"s{i}", "old", "S", 1.0, None) for i in range(20)], SELLER)
    dim = scd2_merge(dims.empty(spark, dims.DIM_SELLER_DDL), start, "seller_nk", tracked, "2024-01-01 00:00:00", "seller_id")
    dim = dim.unionByName(dim.limit(1).withColumns({"seller_nk": F.lit("gone"), "current_flag": F.lit("Expired")}))
    days = [f"2024-0{m}-0{d} 0{h}:00:00" for m, d, h in ((2, 1, 0), (2, 1, 5), (2, 2, 0), (3, 1, 0), (3, 2, 0))]
    log = [(f"s{i}", rng.choice(["old", "new", None]), f"t{rng.randrange(3)}", rng.choice([1.0, 2.0]), float(k), day, k)
           for day in days for k in range(2) for i in range(30) if rng.random() < 0.6]
    changes = spark.createDataFrame(log, SELLER + ", run_ts string, pick int").withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz"))
    dim = spark.createDataFrame(dim.collect(), dim.schema)
    want = dim
    for day in days:
        want = scd2_merge(want, changes.filter(F.col("run_ts") == F.lit(day).cast("timestamp_ntz")), "seller_nk", tracked, day,
                          "seller_id", order=[("pick", "desc")])
        want = spark.createDataFrame(want.collect(), want.schema)
    got = scd2_replay(dim, changes.repartition(5), "seller_nk", tracked, "seller_id", order=[("pick", "desc")])
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(scd2_replay(dim, changes.limit(0), "seller_nk", tracked, "seller_id")) == rows(dim)
    with pytest.raises(Exception, match="NULL natural key"):
        scd2_replay(dim, changes.withColumn("seller_nk", F.lit(None).cast("string")), "seller_nk", tracked, "seller_id").collect()


def test_intervals(spark):
    d = lambda n: START + timedelta(n)
    cases = {
        "fine": [(0, 5, "Expired"), (5, 5, "Expired"), (5, 9000, "Current")],
        "gap": [(0, 5, "Expired"), (6, 9000, "Current")],
        "overlap": [(0, 5, "Expired"), (4, 9000, "Current")],
        "inside": [(0, 50, "Expired"), (10, 20, "Expired"), (50, 60, "Current")],
        "empty": [(0, 5, "Expired"), (5, 5, "Expired"), (6, 7, "Current")],
        "ends": [(0, 5, "Expired"), (5, 5, "Current")],
        "back": [(3, 1, "Current")],
    }
    dim = spark.createDataFrame([(k, d(a), d(b), f) for k, v in cases.items() for a, b, f in v],
                                "nk string, valid_from date, valid_to date, current_flag string")
    got = {(r["nk"], (r["valid_from"] - START).days, r["problem"]) for r in check_version_intervals(dim, "nk").collect()}
    assert got == {("gap", 6, "gap"), ("overlap", 4, "overlap"), ("inside", 10, "overlap"), ("empty", 5, "empty"),
                   ("empty", 6, "gap"), ("ends", 5, "empty"), ("back", 3, "reversed")}


def test_changed_foreign_keys_equal_the_full_check_without_shuffling_children(spark, scratch):
    """Parents that vanished, children that changed, kept children that did not arrive."""
    ts = "2024-06-02"
    staged = spark.range(20000).selectExpr("id", "cast(id % 100 as string) AS fk", f"IF(id % 500 = 7, '{ts}', '2024-06-01') AS at")
    staged = staged.withColumn("fk", F.when(F.col("id") == 507, "nobody").when(F.col("id") == 508, None).otherwise(F.col("fk")))
    staged.write.parquet(f"{scratch}/staged")
    staged = spark.read.parquet(f"{scratch}/staged")
    landed = staged.filter(f"id % 11 <> 0 OR at = '{ts}'").select("id", "fk")  # what changed has landed
    staged_parent = spark.range(100).selectExpr("cast(id as string) AS pk")
    parent = staged_parent.filter("pk NOT IN ('3', '7')")
    got = check_foreign_key_changed(staged, F.col("at") == ts, "id", "fk", landed, parent, staged_parent, "pk")
    assert rows(got, "id", "fk") == rows(check_foreign_key(landed, "fk", parent, "pk"), "id", "fk")
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    assert "BroadcastHashJoin" in final and "hashpartitioning(fk" not in final


def test_a_run_that_checks_changes_refuses_the_same_extracts(spark, scratch):
    from starloom.plans.warehouse import latest_manifest, run_elt
    from starloom.sources.adapters import write_source_extract
    good, bad, wh = f"{scratch}/good", f"{scratch}/bad", f"{scratch}/wh"
    write_source_extract(spark, "/root/testdata/sf0.001", good)
    run_elt(spark, good, wh, "2024-06-01", "r1")
    first = latest_manifest(spark, wh)
    for n in SOURCE_TABLES:  # a parent goes, its children stay as they are
        df = spark.read.parquet(f"{good}/{n}")
        (df.filter("seller_id <> '1'") if n == "sellers" else df).write.parquet(f"{bad}/{n}")
    with pytest.raises(QualityError, match="order_items.seller_id"):
        run_elt(spark, bad, wh, "2024-06-02", "r2", validate="changed")
    assert latest_manifest(spark, wh) == first
    run_elt(spark, good, wh, "2024-06-03", "r3", validate="changed")
    dates = spark.read.parquet(latest_manifest(spark, wh)[("final", "dim_date")])
    ids = [r[0] for r in dates.select("date_id").collect()]
    assert ids == sorted(ids)  # the calendar's file is in date order


def test_descending_text_first_per_key(spark):
    rng = random.Random(12)
    letters = ["", "a", "b", "ab", "é", "z", "zz", "𝔘", " ", "\x00", "\U0010ffff", "A"]
    data = [(i % 40, rng.choice([None, "", "".join(rng.choice(letters) for _ in range(rng.randrange(4)))]), i) for i in range(600)]
    df = spark.createDataFrame(data, "k int, t string, n int")
    want = {}
    for k, t, n in data:  # NULL first, then the last text by bytes, then the smallest number
        new = (t is None, (t or "").encode(), -n)
        if k not in want or new > want[k][0]:
            want[k] = (new, t, n)
    for frame in (df, df.withColumn("t", F.col("t").cast("binary"))):
        got = latest_per_key(frame, "k", [("t", "desc"), ("n", "asc")])
        assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
        assert {r["k"]: r["n"] for r in got.collect()} == {k: v[2] for k, v in want.items()}


def test_ranges_of_a_text_key_are_the_table_once_each(spark):
    rng = random.Random(3)
    keys = [None, "", "it's", "it''s", "ü", "Z", "z"] + [f"k{rng.randrange(500)}" for _ in range(2000)] + ["same"] * 900
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int").repartition(3)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k varchar, i int)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(k, i) for i, k in enumerate(keys)])
    for cuts in (sample_cuts(df, "k", 7), [r[0] for r in con.execute(cut_query("t", "k", 7)).fetchall()], [], ["it's"]):
        conditions = range_predicates("k", cuts)
        assert len(conditions) == max(len(set(cuts)) + 2, 2)
        duck = [r[0] for c in conditions for r in con.execute(f"SELECT i FROM t WHERE {c}").fetchall()]
        mine = [r["i"] for c in conditions for r in df.filter(F.expr(c.replace("''", "\\'"))).select("i").collect()]
        assert sorted(duck) == sorted(mine) == list(range(len(keys)))
    assert sorted(r["i"] for r in scan_partitioned(df, "k", 5).collect()) == list(range(len(keys)))


def test_csv_lines_of_texts_with_breaks(spark, scratch):
    nasty = ["a\nb", "a\r\nb", "\\n", "\\\n", "\\\\n\\", '"quoted",\n"', "\x00\\\x00", "a\\rb\r", " x ", None, "ü\n𝔘"]
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("t", T.StringType())])
    df = spark.createDataFrame(list(enumerate(nasty)), schema)
    write_csv_table(df, f"{scratch}/nasty")
    assert {r["k"]: r["t"] for r in read_csv_table(spark, f"{scratch}/nasty", schema).collect()} == dict(enumerate(nasty))
    big = spark.range(0, 60000, 1, 1).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("line\n"), F.repeat(F.lit("x"), 60)).alias("t"))
    write_csv_table(big, f"{scratch}/big")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
        back = read_csv_table(spark, f"{scratch}/big", schema)
        assert back.rdd.getNumPartitions() > 2 and back.exceptAll(big).isEmpty() and back.count() == 60000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    write_csv_table(big.limit(10), f"{scratch}/foreign", escaped=False, max_rows=4)  # for readers without escapes
    back = read_csv_table(spark, f"{scratch}/foreign", schema, multi_line=True, escaped=False)
    assert back.count() == 10 and back.filter("t LIKE 'line\n%'").count() == 10 and back.rdd.getNumPartitions() >= 3
