import random

import brute
from pyspark.sql import functions as F

from starloom.llm.langid import declared_language, identify, page_text, url_host
from starloom.llm.quality import classify, drop_rejected


def test_languages_of_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = docs.filter(held).select("doc_id", "text", F.lit(None).cast("string").alias("markup"),
                                    F.lit(None).cast("string").alias("host"), "lang")
    got = identify(rows, docs.filter(~held))
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_id")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * n


def test_markup_suffix_and_site_decide_where_the_text_does_not(spark):
    train = spark.createDataFrame([("der die das und ist nicht", "de"), ("the and of that with", "en")] * 5,
                                  "text string, lang string")
    rows = [("der die das und nicht", "de", "a.example.de")] * 10 + [("the and of that", "en", "b.example.com")] * 10
    rows += [("", "de", None), (None, None, "www.example.de"), (None, None, None), ("the and of", "xx", "new.org")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, text string, markup string, host string")
    got = {r["id"]: r for r in identify(df, train).collect()}
    assert [got[i]["lang_id"] for i in (0, 10, 20, 21, 23)] == ["de", "en", "de", "de", "en"]
    assert all(0 < got[i]["confidence"] <= 1 for i in got) and len(got) == len(rows)
    assert identify(df.limit(0), train).collect() == []
    assert {r["lang_id"] for r in identify(df, train.limit(0)).collect()} == {None}


def test_page_columns(spark):
    df = spark.createDataFrame([("<HTML dir=ltr LANG='de-AT'><script>x</script><p>Zu&amp;und</p>", "https://www.a.de/x"),
                                (None, None), ("plain", "nothing")], "html string, url string")
    got = df.select(declared_language("html"), url_host("url"), F.trim(page_text("html"))).collect()
    assert [tuple(r) for r in got] == [("de", "a.de", "Zu und"), (None, None, None), (None, None, "plain")]


def test_quality_catches_toxic_and_junk_and_keeps_clean(spark, sf):
    sf = sf.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    got = classify(docs, labels.filter(~held)).drop("quality", "toxic").join(labels.filter(held), "doc_id")
    r = got.agg(F.avg((F.col("kept") == ((F.col("quality") == 1) & (F.col("toxic") == 0))).cast("int"))).first()[0]
    assert r > 0.96


def test_site_posteriors_decide_when_no_word_is_significant(spark):
    """Too few labels for any word: the sites' rates alone judge, and follow by hand."""
    rows = [(i, f"word{i}", "bad.org" if i < 6 else "good.org", "x") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i >= 6), 0) for i in range(12)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in classify(docs, labels).collect()}
    assert [got[i]["kept"] for i in range(12)] == [i >= 6 for i in range(12)]
    # Rates 0 and 1 of 6 rows each around a mean of (6 + 1) / (12 + 2): the beta prior's strength
    # by moments is its least, 1; the only path of a host lies at the host's rate.
    assert abs(got[7]["site_quality"] - (6 + 0.5) / (6 + 1)) < 1e-3 and abs(got[0]["site_quality"] - 0.5 / 7) < 1e-3
    assert got[0]["quality"] < 0.5 < got[7]["quality"]


def test_quality_edges(spark, make_docs, edge_texts):
    labels = spark.createDataFrame([(None, 1, 0), (3, None, 1), (4, 7, 0), (0, 1, 0), (0, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    df = make_docs([*enumerate(edge_texts), (None, "null id"), (0, None)])
    assert classify(df, labels).count() == len(edge_texts) + 2
    assert classify(df, labels.limit(0)).filter("not kept").isEmpty()
    assert classify(df.limit(0), labels).collect() == []
    kept = drop_rejected(df, labels)
    assert kept.columns == df.columns and not kept.filter("doc_id is null").isEmpty()


def test_labels_that_are_all_alike_reject_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i}", "a.org", "x") for i in range(8)],
                                 "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i > 1), 1) for i in range(4)], "doc_id long, quality int, toxic int")
    got = classify(docs, labels).collect()
    assert [r["kept"] for r in got] == [r["quality"] >= 0.5 for r in got]
    assert classify(docs, labels.filter("doc_id < 2")).filter("not kept").isEmpty()


def test_quality_against_brute_force(spark):
    """Posteriors, site rates and decisions row by row; hosts and paths seen, unseen, sparse and null."""
    rng = random.Random(8)
    good, bad, toxic = ["river", "theorem", "garden", "method"], ["click", "buy", "$$$", "!!"], ["vile", "scum"]
    docs, labels = [], {}
    for i in range(240):
        q, t = int(rng.random() < 0.6), int(rng.random() < 0.3)
        words = rng.choices(["the", "a", "of", "Zeit", "été", *(good if q else bad), *(toxic if t else [])], k=rng.randrange(40))
        host = rng.choice(["a.org", "b.org", "c.org", None]) if q else rng.choice(["a.org", "spam.net", "spam.net", None])
        docs.append((i, rng.choice([" ", "\n", "|"]).join(words), host, rng.choice(["x", "y", None])))
        if i % 3:
            labels[i] = (q, t)
    docs += [(900, None, "new.org", "x"), (901, "", "a.org", "new"), (902, "river!! " * 3000, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(3)
    table = spark.createDataFrame([(i, *v) for i, v in labels.items()], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in classify(df, table, min_g=4.0, l2=0.01).collect()}
    want = brute.quality(docs, labels, 4.0, 0.01)
    assert got.keys() == want.keys()
    for i, (q, t, sq, st, kept) in want.items():
        r = got[i]
        assert max(abs(r["quality"] - q), abs(r["toxic"] - t)) < 1e-2, (i, r, want[i])
        assert max(abs(r["site_quality"] - sq), abs(r["site_toxic"] - st)) < 1e-9
        assert r["kept"] == kept or min(abs(q - 0.5), abs(t - 0.5)) < 1e-2
