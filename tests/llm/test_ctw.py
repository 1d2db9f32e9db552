import math
import zlib
from collections import Counter

import numpy as np
import brute

from starloom.llm.ctw import deep_nodes, descend, gram_codes, log_gamma, log_kt, score_texts


def _held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def _kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


def _tree_score(train, text, depth):
    """A recursive context tree on dictionaries."""
    def grams(t):
        s = b"\xff" * depth + t.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                          b"abcdefghijklmnopqrstuvwxyz")) + b"\xff"
        return [(s[i - depth:i][::-1], s[i]) for i in range(depth, len(s))]
    count, kids = Counter(), {}
    for t in train:
        for ctx, x in grams(t):
            for level in range(8):
                for d in range(depth + 1):
                    node = (ctx[:d], level, x >> (8 - level))
                    count[node, x >> (7 - level) & 1] += 1
                    if d:
                        kids.setdefault((ctx[:d - 1], *node[1:]), set()).add(node)
    memo = {}

    def weighted(node):
        if node not in memo:
            kt = _kt(count[node, 0], count[node, 1])
            memo[node] = kt if len(node[0]) == depth else math.log(0.5) + np.logaddexp(
                kt, sum(weighted(k) for k in kids.get(node, ())))
        return memo[node]

    def predict(ctx, d, level, prefix, bit):
        node = (ctx[:d], level, prefix)
        n0, n1 = count[node, 0], count[node, 1]
        p = ((n1, n0)[bit == 0] + 0.5) / (n0 + n1 + 1)
        if d == depth:
            return p
        share = math.exp(math.log(0.5) + _kt(n0, n1) - weighted(node))
        return share * p + (1 - share) * predict(ctx, d + 1, level, prefix, bit)
    return sum(math.log10(predict(ctx, 0, level, x >> (8 - level), x >> (7 - level) & 1))
               for ctx, x in grams(text) for level in range(8))


def test_against_a_recursive_tree_and_word_counts(make_docs, edge_texts):
    texts = dict(enumerate([t if t is None else t[:700] for t in edge_texts] + ["the cat sat", "The Cat sat on"]))
    got = {r["doc_id"]: r for r in score_texts(make_docs(list(texts.items())), depth=4, buckets=16).collect()}
    tokens = {i: [*brute.words(t, brute.SPACED), None] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if not _held(i) for w in ws)
    total = sum(c.values())
    train = [(t or "").encode() for i, t in texts.items() if not _held(i)]
    assert any(map(_held, texts))
    for i, t in texts.items():
        r, ws = got[i], tokens[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            _held(i), len(ws), sum(c[w] > 0 for w in ws), total)
        assert abs(r["base_score"] - sum(math.log10((c[w] + 1) / (total + len(c) + 1)) for w in ws)) < 1e-6
        want = _tree_score(train, (t or "").encode(), 4)
        assert abs(r["score"] - want) < 1e-4 * max(1, abs(want))


def test_probabilities_sum_to_one_and_learning_helps():
    data = np.frombuffer(b"abracadabra" * 30, np.uint8)
    code, _ = gram_codes(data, np.array([0, len(data)]), 3)
    every = np.unique(np.concatenate([(code >> np.uint64(8) << np.uint64(8)) | np.uint64(x) for x in range(256)]))
    n = np.array([int((code == c).sum()) for c in every])
    nodes, p = deep_nodes(every, n, 3, 0), np.ones(len(every))
    for level in range(8):
        p *= descend(nodes, every, 3, range(4), level, np.zeros(len(every)), np.ones(len(every)))[0]
    context = every >> np.uint64(8)
    for c in np.unique(context):
        assert abs(p[context == c].sum() - 1) < 1e-9
    assert np.log2(p[np.searchsorted(every, code)]).mean() > -1.0


def test_log_gamma():
    x = np.array([0.5, 1.0, 2.5, 7.0, 100.0, 1e6])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-12)
    assert abs(log_kt(np.array([3]), np.array([5]))[0] - _kt(3, 5)) < 1e-12


def test_null_ids_and_no_documents(make_docs):
    got = score_texts(make_docs([(None, "a b"), (7, "a b"), (7, "a b")])).collect()
    assert len(got) == 3 and not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert score_texts(make_docs([])).collect() == []
