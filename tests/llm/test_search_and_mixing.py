"""Ranked search and source mixing against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from brute import LOWER, words, SPACED
from starloom.llm.lexical import rank_documents
from starloom.llm.mixing import emit_copies, mix_sources
from texts import prose

TERMS = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, top):
    """Sorted (item, rank, score) of [(id, text)], and the ids allowed at each place."""
    bags = [Counter(TERMS.findall((t or "").translate(LOWER))) for _, t in docs]
    lens = [sum(b.values()) for b in bags]
    n, total = sum(x > 0 for x in lens), sum(lens)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        asked = set(TERMS.findall((text or "").translate(LOWER)))
        scores = []
        for (i, _), bag, length in zip(docs, bags, lens, strict=True):
            m = 50 + (50 * length * n) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
                        for t in asked if t in bag)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"shard_bytes": 500, "block_items": 2, "map_bits": 1 << 15, "owners": 3},
                                    {"shard_bytes": 1, "block_items": 1, "owners": 1}])
def test_rank_documents(spark, make_docs, edge_texts, limits):
    rng = random.Random(3)
    docs = list(enumerate(edge_texts)) + [(100 + k, prose(rng, rng.randrange(1, 60), 40)) for k in range(60)]
    docs += [(7, edge_texts[7]), (None, docs[-1][1]), (None, None), (200, docs[-1][1]), (201, docs[-1][1])]
    items = [(k, prose(rng, 8, 60)) for k in range(7)] + [(7, None), (7, "w1 w2 w2 w3"), (None, "W1"), (9, "never seen"),
                                                          (10, "  "), (11, "straße\x00naïve, CAFÉ")]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, shard string")
    got = rank_documents(make_docs(docs), asked, top=5, **limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == ranked(docs, items, 5)


def test_rank_documents_empty(spark, make_docs):
    docs, none = make_docs([(1, "a b"), (2, None)]), make_docs([])
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rank_documents(none, items).collect() == []
    assert rank_documents(docs, items.limit(0)).collect() == []
    assert rank_documents(make_docs([(1, None), (2, "")]), items).collect() == []
    # The only document holds the term: its weight is floor(1000 ln(4 / 3)).
    assert [tuple(r) for r in rank_documents(docs, items).collect()] == [(1, 1, 1, 287 * (10**9 // (1000 + 20 * 100)))]


def mixed(rows, cycle=(1, 2, 3), cap=3, seeds=16):
    """[(id, size, source size, target, copies, taken)] of [(id, text, source)]."""
    sizes = [len(words(t, SPACED)) for _, t, _ in rows]
    per = defaultdict(int)
    for (_, _, s), n in zip(rows, sizes, strict=True):
        per[s] += n
    order = sorted((s for s in per if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in per)
    weight = {s: cycle[k % len(cycle)] for k, s in enumerate(order)}
    left, open_, target = Fraction(sum(sizes)), set(order), {}
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > cap * per[s]} if open_ else set()
        if not over:
            break
        target |= {s: float(cap * per[s]) for s in over}
        open_ -= over
        left -= sum(cap * per[s] for s in over)
    target |= {s: float(left) * weight[s] / float(sum(weight[x] for x in open_)) for s in open_}

    def copies(seed, i, rate):
        u = int(hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / 2**52
        return math.floor(rate) + (u < rate - math.floor(rate))
    rate = {s: target[s] / per[s] if per[s] else 0.0 for s in order}
    mine = defaultdict(list)
    for (i, _, s), n in zip(rows, sizes, strict=True):
        mine[s].append((i, n))
    seed = {s: min(range(seeds), key=lambda k: (abs(sum(n * copies(k, i, rate[s]) for i, n in mine[s]) - target[s]), k))
            for s in order}
    return [(i, n, per[s], target[s], copies(seed[s], i, rate[s]), n * copies(seed[s], i, rate[s]))
            for (i, _, s), n in zip(rows, sizes, strict=True)]


def _mix_rows():
    rng = random.Random(8)
    rows = [(k, prose(rng, rng.randrange(1, 40)), rng.choice(["big"] * 9 + ["a", "B", "ä", "", None, "𝔘"])) for k in range(400)]
    return rows + [(None, "one two", "a"), (None, None, "a"), (5, rows[5][1], rows[5][2]), (900, None, "silent"),
                   (901, " \t\n", "silent"), (902, "one", "�")]


def test_mix_sources(spark):
    rows = _mix_rows()
    docs = spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows],
                                 "doc_id long, text string, source string, size int, target double, copies string")
    got = mix_sources(docs.repartition(5))
    assert got.columns == ["doc_id", "size", "source_size", "target", "copies", "taken"]
    want = mixed(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, mix_sources(docs.repartition(2)).collect()), key=str) == sorted(want, key=str)  # reruns agree
    taken, target = defaultdict(int), {}
    for (_, _, s), w in zip(rows, want, strict=True):
        taken[s] += w[5]
        target[s] = w[3]
    assert abs(sum(target.values()) - sum(w[1] for w in want)) < 1e-6
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] + 40 for s in target)
    copies = emit_copies(docs)
    assert copies.columns == docs.columns
    number = Counter(r["text"] for r in copies.collect())
    wanted = Counter()
    for (_, t, _), w in zip(rows, want, strict=True):
        wanted[t] += w[4]
    assert number == +wanted


def test_mix_sources_edges(spark):
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema)).collect() == []
    silent = spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)
    assert sorted(map(tuple, mix_sources(silent).collect())) == [(1, 0, 0, 0.0, 0, 0), (2, 0, 0, 0.0, 0, 0)]
    one = spark.createDataFrame([(1, "a b", "s")], schema)
    assert list(map(tuple, mix_sources(one).collect())) == [(1, 2, 2, 2.0, 1, 2)]
