import numpy as np
import pytest

import brute

from starloom.llm.embeddings import Similar, drop_similar, similar_vectors


@pytest.mark.parametrize("tile", [8, 512])
def test_against_all_pairs(spark, tile):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.3])).astype(np.float32).tolist(),
             int(i % 4 == 0)) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1], 0) for i in range(9)]  # equal vectors
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0),
             (304, [float("inf")] + [1.0] * 15, 0), (305, [None] + [1.0] * 15, 0), (306, rows[0][1], None),
             (307, [1.0, 0.0], 0), (308, [2.0, 0.0], 0), (309, [3e38] * 16, 0), (310, [1e-38] * 16, 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, rep string, n int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           similar_vectors(df, params=Similar(tile=tile, steps=(2, 4, 8))).collect()}
    bad = {300, 301, 302, 303, 304, 305, 306}
    links = []
    for i, v, x in rows:
        for j, w, y in rows:
            if i < j and x == y and not {i, j} & bad and len(v) == len(w):
                a, b = (np.array(z, np.float32).astype(float) for z in (v, w))
                if a / np.linalg.norm(a) @ (b / np.linalg.norm(b)) >= 0.93:
                    links.append((i, j))
    comp = brute.components([r[0] for r in rows], links)
    n = {i: sum(i in p for p in links) for i in comp}
    assert len(links) > 300
    assert got == {i: (n[i], comp[i], comp[i] == i) for i in comp}


def test_null_ids_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(None, [1.0, 2.0], 1), (5, [1.0, 2.0], 1)], schema)
    got = sorted((str(r[0]), r[1], r[2], r[3]) for r in similar_vectors(df).collect())
    assert got == [("5", 0, 5, True), ("None", 0, None, True)]
    assert similar_vectors(df.limit(0)).collect() == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (6, [1.0, 0.01], 1), (6, [1.0, 0.01], 1), (9, [0.0, 1.0], 2),
            (None, [1.0, 0.0], 1), (7, [1.0, 0.0], None), (2, [0.01, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr(
        "*", "1 AS row", "2 AS component", "3 AS good", "4 AS id", "5 AS first")
    got = sorted(tuple(r) for r in similar_vectors(df.filter("vec_id is not null")).collect())
    assert got == [(2, 1, 2, True), (5, 1, 2, False), (5, 2, 5, True), (6, 2, 5, False), (6, 2, 5, False),
                   (7, 0, 7, True), (9, 0, 9, True)]
    left = drop_similar(df)
    assert left.columns == df.columns
    assert sorted((str(r["vec_id"]), [round(x, 2) for x in r["embedding"]]) for r in left.collect()) == [
        ("2", [0.01, 1.0]), ("5", [1.0, 0.0]), ("7", [1.0, 0.0]), ("9", [0.0, 1.0]), ("None", [1.0, 0.0])]


def test_copies_of_one_row_leave_one(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 1)] * 3 + [(0, [2.0, -1.0], 1)],
                               "vec_id long, embedding array<float>, label int")
    assert sorted(r["vec_id"] for r in drop_similar(df).collect()) == [0, 1]
