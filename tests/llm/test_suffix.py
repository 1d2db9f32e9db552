import random
import tempfile

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm.suffix import BucketQueue, Repeats, cut_repeats, repeat_digest, sorted_buckets


def _texts(edge_texts):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ñé") for _ in range(500))
    out = [*edge_texts, passage, passage[:199], passage[:200], "ab" * 400]
    for i in range(80):  # a passage that many documents share, in different surroundings
        left, right = ("".join(rng.choice("stuvwxyz ") for _ in range(rng.randrange(300))) for _ in "ab")
        a = rng.randrange(200)
        out.append(left + passage[a:a + rng.randrange(150, 300)] + right)
    return out


@pytest.mark.parametrize("params", [Repeats(), Repeats(split=2, shard_bytes=20_000, queue_bytes=2_000)])
def test_against_brute_force(make_docs, edge_texts, params):
    texts = dict(enumerate(_texts(edge_texts)))
    raws = [(t or "").encode() for t in texts.values()]
    want = {i: (len(r), sum(b - a for a, b in s), len(s), brute.sha(brute.cut(r, s)))
            for i, r, s in zip(texts, raws, brute.repeated_spans(raws, 200), strict=True)}
    got = repeat_digest(make_docs(list(texts.items())), params=params).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want


def test_cut_keeps_columns_and_whole_characters(make_docs, edge_texts):
    texts = dict(enumerate(_texts(edge_texts)))
    df = make_docs(list(texts.items()))
    out = cut_repeats(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    raws = [(t or "").encode() for t in texts.values()]
    for (i, t), raw, runs in zip(texts.items(), raws, brute.repeated_spans(raws, 200), strict=True):
        if not runs:
            assert got[i] == t
        else:
            left = brute.cut(raw, runs).decode(errors="ignore")
            assert len(left) <= len(got[i]) <= len(left) + 2 * len(runs)


def test_repeated_null_ids_and_no_documents(make_docs):
    text = "".join(chr(97 + i * i % 26) for i in range(300)) + "-end"
    got = repeat_digest(make_docs([(None, text), (None, text), (4, None)])).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got) == [(0, 0, 0), (304, 304, 1), (304, 304, 1)]
    assert repeat_digest(make_docs([])).collect() == []
    assert cut_repeats(make_docs([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=200), st.integers(8, 4000))
def test_induced_order_is_the_suffix_order(symbols, budget):
    t = np.array([*symbols, 0], np.uint16)
    with tempfile.TemporaryDirectory() as folder:
        buckets = list(sorted_buckets(t, 4, 400, folder, budget))
    order = [int(i) for b in reversed(buckets) for i in b]
    assert order == sorted(range(len(t)), key=lambda i: tuple(t[i:]))


def test_queued_arrays_are_dealt_together(tmp_path, monkeypatch):
    q = BucketQueue(str(tmp_path), 2, 40)
    for a in range(0, 12, 2):  # two arrays fit beside each other, the others go to files
        q.push(0, np.array([a, a + 1]))
    q.push(1, np.array([99]))
    assert q.pop(0).tolist() == [0, 1, 2, 3]
    q.push(0, np.array([12]))
    q.push(0, np.array([13]))
    got = []
    while (x := q.pop(0)) is not None:
        got.append(x.tolist())
    assert got == [[4, 5], [6, 7], [8, 9], [10, 11], [12, 13]]
    assert q.pop(1).tolist() == [99] and q.pop(1) is None and q.held == 0
    assert not list(tmp_path.iterdir())

    # The steps of a bucket are its generations, not the arrays that other buckets sent.
    deals, deal = [], BucketQueue.push_by
    monkeypatch.setattr(BucketQueue, "push_by", lambda self, s, x: (deals.append(len(x)), deal(self, s, x)))
    rng = np.random.default_rng(3)
    t = np.append(rng.integers(1, 41, 20_000), 0).astype(np.uint16)
    assert sum(map(len, sorted_buckets(t, 41, 200, str(tmp_path), 1 << 20))) == len(t)
    assert len(deals) < 41 * 16


def test_a_task_sorts_whole_shards_a_few_bytes_at_a_time(spark):
    import pyarrow as pa
    from starloom.llm.suffix import Repeats, repeated_runs, whole_shards
    shard = [1, 1, 1, 2, 3, 3, 3, 3, 4, 5, 6, 6]
    rows = pa.table({"shard": pa.array(shard, pa.int64()), "bytes": [b"x" * 10] * len(shard), "n": range(len(shard))})
    for size in (1, 5, 100):
        batches = rows.to_batches(max_chunksize=size)
        for limit in (1, 25, 10_000):
            groups = [[x for b in g for x in b.to_pydict()["n"]] for g in whole_shards(batches, limit)]
            assert [n for g in groups for n in g] == list(range(len(shard)))
            of = [{shard[n] for n in g} for g in groups]
            assert sum(map(len, of)) == 6  # none is cut
            assert all(10 * len(g) < limit + 10 * 4 for g in groups)  # the limit and a shard at most
    assert list(whole_shards([], 5)) == []
    text = "".join(chr(97 + i * i % 23) for i in range(300))
    docs = spark.createDataFrame([(k, text[:120 + k] + str(k) + text[100:]) for k in range(40)], "row long, text string")

    def spans(**kw):
        found = repeated_runs(docs, Repeats(length=50, gram=8, **kw)).collect()
        return {r["row"]: sorted({i for a, b in r["spans"] for i in range(a, b)}) for r in found}
    want = spans(sort_bytes=1 << 30)
    assert want and spans(sort_bytes=1) == want and spans(sort_bytes=1, split=2) == want


def test_equal_runs_of_a_chunk_are_counted_as_one(spark, monkeypatch):
    from starloom.llm import suffix
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choice("stuvwxyz ") for _ in range(n))
    passage = "".join(rng.choice("abcdefgh") for _ in range(600))
    texts = [noise(rng.randrange(260)) + "Is onhe. " * 100 + noise(rng.randrange(260)) for _ in range(60)]
    texts += [noise(90) + passage + noise(90) for _ in range(60)]
    texts += [noise(400), passage[:350], "x" * 500, "", None]
    rng.shuffle(texts)
    raws = [(t or "").encode() for t in texts]
    want = {i: (len(r), sum(b - a for a, b in s), len(s), brute.sha(brute.cut(r, s)))
            for i, r, s in zip(range(len(raws)), raws, brute.repeated_spans(raws, 200), strict=True)}
    stored, store = {}, suffix.materialize
    monkeypatch.setattr(suffix, "materialize", lambda df, name: stored.setdefault(name, store(df, name)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (1, 4, 40):
        stored.clear()
        got = repeat_digest(docs.repartition(parts, "doc_id").sortWithinPartitions("doc_id")).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in got} == want
        # A run of each period of each text would be over 4,000 rows.
        assert stored["suffix-candidates"].count() < 400 + 40 * parts
