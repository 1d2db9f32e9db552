"""Language identification against plain Python, with more languages than one block."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from starloom.llm.langid import BUCKETS, identify

ROWS = "id long, text string, markup string, host string"


def _trigrams(text):
    b = [x + 32 if 65 <= x <= 90 else x for x in (text or "").encode()]
    b = [x if 97 <= x <= 122 or x >= 128 else 32 for x in b]
    codes = [x << 16 | y << 8 | z for x, y, z in zip(b, b[1:], b[2:], strict=False)]
    return [(c * 2654435761 % (1 << 32)) >> 18 for c in codes if c != 0x202020]


def brute(rows, labelled, effective=60, strength=5.0, smoothing=0.5):
    """[(language, confidence, language of the text)] of (text, markup, host)."""
    langs = sorted({x for _, x in labelled if x is not None})
    counts = {x: Counter() for x in langs}
    for t, x in labelled:
        if x is not None:
            counts[x].update(_trigrams(t))
    size = {x: counts[x].total() + 0.5 * BUCKETS for x in langs}
    lls, posts, keys = [], [], []
    for t, markup, host in rows:
        g = _trigrams(t)
        scale = min(1.0, effective / max(len(g), 1))
        ll = [scale * sum(math.log((counts[x][k] + 0.5) / size[x]) for k in g) for x in langs]
        e = [math.exp(v - max(ll)) for v in ll]
        lls.append(ll)
        posts.append([v / sum(e) for v in e])
        suffix = re.search(r"\.([^.]+)$", host or "")
        domain = re.search(r"([^.]+\.[^.]+)$", host or "")
        keys.append({"markup": markup, "suffix": suffix and suffix[1], "domain": domain[1] if domain else host,
                     "host": host})
    sums = {k: defaultdict(lambda: [0.0] * len(langs)) for k in ("markup", "suffix", "domain", "host")}
    total = [sum(p[i] for p in posts) for i in range(len(langs))]
    for post, key in zip(posts, keys, strict=True):
        for k, v in key.items():
            if v is not None:
                sums[k][v] = [a + b for a, b in zip(sums[k][v], post, strict=True)]
    kinds = {k: len(sums[k]) + 1 for k in ("markup", "suffix")}
    out = []
    for ll, post, key in zip(lls, posts, keys, strict=True):
        others = {k: [max(a - b, 0.0) for a, b in zip(sums[k][v], post, strict=True)]
                  for k, v in key.items() if v is not None}
        score = []
        for i in range(len(langs)):
            prior = (total[i] + 1) / (sum(total) + len(langs))
            for k in ("domain", "host"):
                if k in others:
                    prior = (others[k][i] + strength * prior) / (sum(others[k]) + strength)
            s = ll[i] + math.log(prior)
            for k, n in kinds.items():
                if k in others:
                    s += math.log((others[k][i] + smoothing) / (total[i] + smoothing * n))
            score.append(s)
        best = max(score)
        out.append((langs[score.index(best)], 1 / sum(math.exp(s - best) for s in score), langs[ll.index(max(ll))]))
    return out


def _corpus(n_lang):
    rng = random.Random(n_lang)
    words = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)]
             for _ in range(n_lang)]
    say = lambda i, n: " ".join(rng.choice(words[i]) for _ in range(n))
    labelled = [(say(i, 20), f"l{i:03}") for i in range(n_lang) for _ in range(1 if i % 2 else 3)]
    labelled += [("no label", None), (None, "l000")]
    rows = [(say(i, 3), rng.choice([None, f"l{i:03}"]), rng.choice([None, f"w.s{i % 7}.c{i % 5}", f"s{i % 7}.c{i % 5}"]))
            for i in range(n_lang) for _ in range(2)]
    return labelled, [*rows, (None, "l001", None), ("", None, "w.s1.c1"), (None, None, None), ("zz", "xx", "nodots")]


@pytest.mark.parametrize(("n_lang", "options"), [(4, {}), (90, {}), (9, {"block_languages": 4})])
def test_every_row_against_plain_python(spark, n_lang, options):
    labelled, rows = _corpus(n_lang)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ROWS).repartition(3, "id")
    train = spark.createDataFrame(labelled, "text string, lang string")
    got = {r["id"]: r for r in identify(df, train, **options).collect()}
    want = brute(rows, labelled)
    assert len(got) == len(rows)
    for i, (lang, confidence, text_lang) in enumerate(want):
        assert got[i]["confidence"] == pytest.approx(confidence, rel=1e-9)
        assert (got[i]["lang_id"], got[i]["text_lang"]) == (lang, text_lang)
    assert sum(got[2 * i]["lang_id"] == f"l{i:03}" for i in range(n_lang)) >= 0.95 * n_lang


def test_edges_with_several_blocks(spark):
    labelled, rows = _corpus(9)
    train = spark.createDataFrame(labelled, "text string, lang string")
    df = spark.createDataFrame([(None, *rows[0])] * 3, ROWS)
    got = identify(df, train, block_languages=2)
    assert got.columns == ["id", "host", "lang_id", "confidence", "text_lang"]
    assert [r["lang_id"] for r in got.collect()] == ["l000"] * 3
    assert identify(df.limit(0), train, block_languages=2).collect() == []
    assert {r["lang_id"] for r in identify(df, train.limit(0), block_languages=2).collect()} == {None}


@pytest.mark.parametrize("block", [2, 64])
def test_names_that_clash(spark, block):
    texts = {"aa": "lorem ipsum dolor sit amet", "bb": "the quick brown fox jumps", "cc": "zwölf boxkämpfer jagen"}
    rows = [(i, t, x, "old", 0.5, "old", "kept", 7, "k0") for i, (x, t) in enumerate(sorted(texts.items()) * 4)]
    df = spark.createDataFrame(rows, "id long, body string, lang string, lang_id string, Confidence double, "
                                     "text_lang string, text string, m int, __kept0 string").selectExpr(
        "*", "CAST(NULL AS string) AS markup", "CAST(NULL AS string) AS host", "1 AS share", "2 AS z")
    got = identify(df, df, text_col="body", train_text_col="body", block_languages=block)
    assert got.columns == ["id", "lang", "text", "m", "__kept0", "host", "share", "z", "lang_id", "confidence",
                           "text_lang"]
    for r in got.collect():
        assert (r["text"], r["m"], r["__kept0"], r["share"], r["z"]) == ("kept", 7, "k0", 1, 2)
        assert r["lang_id"] == r["text_lang"] == r["lang"] and 0.3 < r["confidence"] <= 1
