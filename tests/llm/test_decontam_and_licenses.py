import random

import brute
import pytest

from starloom.llm.decontam import contamination, drop_contaminated, longest_matches
from starloom.llm.licenses import BASE_PHRASES, TEMPLATES, read_templates, scan_licenses


@pytest.fixture()
def tables(spark, sf):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(str(r[0]), r[1]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 900])
def test_contamination_against_brute_force(spark, make_docs, tables, edge_texts, block_bytes):
    docs, items = tables
    docs = docs[:60] + [(10_000 + i, t) for i, t in enumerate(edge_texts)]
    items = [*items, ("short", "One"), ("none", None), ("blank", " -- "), (None, items[0][1]), (items[0][0], "Tail")]
    docs += [(20_000, f"{items[1][1]} {items[0][1]}"), (20_000, None), (None, items[2][1])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = contamination(make_docs(docs), bench, block_bytes=block_bytes).collect()
    want = brute.contamination([t for _, t in docs], items)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items"], r["items_sha256"],
                    r["contaminated"]) for r in got), key=key) == sorted(
        ((i, w, h, len(n), n, brute.sha(",".join(n)), c) for (i, _), (w, h, n, c) in zip(docs, want, strict=True)), key=key)
    assert all(r["n_hit"] == sum(s["end"] - s["first"] for s in r["spans"]) for r in got)


def test_contaminated_documents_go(spark, make_docs, tables):
    _, items = tables
    bench = spark.createDataFrame(items, "item_id string, text string")
    df = make_docs([(1, items[0][1]), (2, "clean words only"), (None, items[0][1]), (3, None)])
    out = drop_contaminated(df, bench)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "3", "None"]
    assert drop_contaminated(df, bench.limit(0)).count() == 4
    assert contamination(df.limit(0), bench).collect() == []


def test_longest_matches(spark, make_docs):
    bench = spark.createDataFrame([("a", "p q r s t u"), ("b", "z")], "item_id string, text string")
    df = make_docs([(1, "x p q r y"), (2, "q r s t"), (3, None)], parts=1)
    got = {(r["item"], r["item_word"]): (r["length"], r["doc"], r["doc_word"])
           for r in longest_matches(df, bench).collect()}
    assert got == {("a", 0): (3, 1, 1), ("a", 1): (4, 2, 0), ("a", 2): (3, 2, 1), ("a", 3): (2, 2, 2), ("a", 4): (1, 2, 3)}


def test_license_places_against_brute_force(make_docs, tables, edge_texts):
    docs, _ = tables
    more = ["CC-BY cc by, all rights reserved. All rights", "general public license general public", "cc\nBY" * 5,
            "the gnu general public license", "all all rights reserved reserved"]
    docs = docs + [(10_000 + i, t) for i, t in enumerate([*edge_texts, *more])]
    got = {r["doc_id"]: r for r in scan_licenses(make_docs(docs)).collect()}
    for i, t in docs:
        w = brute.words(t, brute.LETTERS)
        places = [(j, label) for p, label in BASE_PHRASES.items() for j in range(len(w))
                  if w[j:j + len(p.split())] == p.split()]
        r, at = got[i], [j for j, _ in places]
        base = sorted({x for _, x in places})
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(w), len(at), min(at, default=None), max(at, default=None), ",".join(base))
        assert set(base) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert bool(r["labels"]) <= (r["score"] > 0)


def test_templates_are_found_whole_and_with_gaps(make_docs):
    rows = [(i, f"some words. {t.upper()}! more") for i, (_, t) in enumerate(TEMPLATES)]
    rows.append((100, "Permission is hereby granted, free of charge, to ANY lucky person obtaining a copy of this "
                      "software and its associated documentation files, to deal in the software without restriction"))
    rows.append((101, "permission is granted to nobody"))
    rows.append((None, None))
    got = {r["doc_id"]: r for r in scan_licenses(make_docs(rows), with_spans=True).collect()}
    for i, (label, t) in enumerate(TEMPLATES):
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1.0
        assert any(s["label"] == label and s["first"] == 2 for s in got[i]["spans"])
    assert got[100]["labels"] == "mit" and 0.75 <= got[100]["score"] < 1
    assert got[101]["labels"] == "" and got[None]["n_words"] == 0
    assert scan_licenses(make_docs([])).collect() == []


def test_chains_against_brute_force(make_docs):
    rng = random.Random(11)
    templates = [("x", "a b c d e f g h"), ("y", "c d e x a b c"), ("y", "a a a b"), ("z", "h g f e d c b a"),
                 ("none", " -- ")]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(1, 9)):
            w = rng.choice(templates)[1].split()
            a = rng.randrange(len(w))
            parts += [*w[a:a + rng.randrange(2, 9)], *rng.choices("abq", k=rng.randrange(3))]
        rows.append((i, " ".join(parts)))
    rows += [(1000, None), (1001, ""), (1002, "a b c d e f g h " * 3), (1002, "a b c d e f g h " * 3)]
    got = scan_licenses(make_docs(rows), templates=templates, phrases={"b c": "bc"}, min_match=2, max_gap=2,
                        min_cover=0.6, with_spans=True).collect()
    texts = [(label, t.split()) for label, t in [*templates[:4], ("bc", "b c")]]
    want = []
    for i, t in rows:
        words = brute.words(t, brute.LETTERS)
        base = [k for k in range(len(words)) if words[k:k + 2] == ["b", "c"]]
        chains = brute.license_chains(words, [w for _, w in texts], 2, 2, 0.6)
        share = [(texts[t][0], a, b, n / len(texts[t][1])) for t, n, a, b in chains]
        found = [x for x in share if x[3] >= 0.6]
        labels = sorted({x[0] for x in found} | ({"bc"} if base else set()))
        score = min(1.0, max([1.0 if base else 0.0, *(x[3] for x in share)]))
        want.append((i, len(words), len(base), ",".join(labels), score, sorted(found)))
    assert sorted((r["doc_id"], r["n_words"], r["n_base"], r["labels"], r["score"],
                   sorted((s["label"], s["first"], s["end"], s["cover"]) for s in r["spans"])) for r in got) == sorted(want)
    twice = [s for s in next(r for r in got if r["doc_id"] == 1002)["spans"] if s["label"] == "x"]
    assert [(s["first"], s["end"], s["cover"]) for s in twice] == [(0, 8, 1.0), (8, 16, 1.0), (16, 24, 1.0)]


def test_templates_from_files(spark, make_docs, tmp_path):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    whole = {"One-1.0": rng.choices(words, k=3000), "Two": rng.choices(words, k=500)}
    whole["One-2.0"] = [*whole["One-1.0"][:1500], *rng.choices(words, k=1500)]  # versions share passages
    for name, w in whole.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(w))
    table = read_templates(spark, str(tmp_path))
    rows = [(1, "See. " + " ".join(whole["One-1.0"])), (2, " ".join(whole["Two"]).upper()),
            (3, " ".join(whole["One-1.0"][:700])), (4, " ".join(whole["One-2.0"][:2900])), (5, None)]
    got = {r["doc_id"]: r for r in scan_licenses(make_docs(rows), templates=table).collect()}
    assert [got[i]["labels"] for i in (1, 2, 3, 4, 5)] == ["one-1.0", "two", "", "one-2.0", ""]
    assert got[1]["score"] == 1.0 and abs(got[3]["score"] - 700 / 3000) < 1e-3
    no_templates = scan_licenses(make_docs(rows), templates=table.limit(0)).collect()
    assert {r["labels"] for r in no_templates} == {""}
    with pytest.raises(ValueError):
        scan_licenses(make_docs(rows), templates=table, max_template_bytes=1000)
