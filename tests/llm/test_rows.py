"""The filter stages decide per row: tables with repeated and null ids."""

import random

from texts import prose

import corpus_pipeline
from starloom.llm.decontam import drop_contaminated
from starloom.llm.quality import classify, drop_rejected
from starloom.llm.superminhash import drop_near_duplicates


def _left(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_near_dedup_leaves_one_row_of_each_group(spark, make_docs):
    rng = random.Random(3)
    a, b, c, d = (prose(rng, 80, 5000) for _ in range(4))
    rows = [(7, a), (7, a), (3, a + " more"), (None, a), (None, b), (None, b), (5, c), (5, d), (4, d),
            (8, ""), (8, ""), (None, None)]
    df = make_docs(rows)
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    assert _left(out) == sorted([(3, a + " more"), (None, b), (5, c), (4, d), (8, ""), (8, ""), (None, None)], key=str)


def test_near_dedup_of_a_table_loaded_twice_is_that_of_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    blank = "trim(coalesce(text, '')) = ''"
    once = drop_near_duplicates(docs).filter(f"not ({blank})")
    twice = drop_near_duplicates(docs.unionByName(docs)).filter(f"not ({blank})")
    assert _left(once) == _left(twice)


def test_contaminated_rows_go_and_their_namesakes_stay(spark, make_docs):
    rng = random.Random(4)
    test, clean = prose(rng, 40, 5000), prose(rng, 60, 5000)
    bench = spark.createDataFrame([("t", test)], "item_id string, text string")
    docs = make_docs([(1, test), (1, clean), (None, test), (None, clean), (2, clean)])
    left = [(1, clean), (None, clean), (2, clean)]
    assert _left(drop_contaminated(docs, bench, null_ids_stay=False)) == sorted(left, key=str)
    assert _left(drop_contaminated(docs, bench)) == sorted([*left, (None, test)], key=str)


def test_pipeline_stages_drop_null_ids_too(spark, make_docs, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").first()["text"]
    docs = make_docs([(None, item), (None, "clean words"), (1, item)])
    assert _left(corpus_pipeline.decontaminate(spark, docs, sf)) == [(None, "clean words")]
    assert len(_left(corpus_pipeline.near_dedup(spark, docs, sf))) == 2


def test_rejected_rows_go_and_their_namesakes_stay(spark, make_docs):
    rng = random.Random(5)
    good = [" ".join(["fine", prose(rng, 30)]) for _ in range(60)]
    bad = [" ".join(["vile", prose(rng, 30)]) for _ in range(60)]
    rows = [*enumerate(good), *enumerate(bad, 100), (900, good[0]), (900, bad[0]), (None, good[1]), (None, bad[1])]
    labels = spark.createDataFrame([(i, int(i < 100), int(i >= 100)) for i, _ in rows[:-4]],
                                   "doc_id long, quality int, toxic int")
    df = make_docs(rows)
    assert "row" not in classify(df, labels).columns
    out = drop_rejected(df, labels)
    assert out.columns == df.columns
    assert _left(out) == sorted([*enumerate(good), (900, good[0]), (None, good[1])], key=str)
