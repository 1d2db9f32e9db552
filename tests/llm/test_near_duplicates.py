import random

import brute
from texts import prose

from starloom.llm.superminhash import NearDup, drop_near_duplicates, near_duplicates, superminhash


def _check(df, texts, k, num):
    want = brute.near_duplicates(texts, k, num)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in want.items()}


def test_against_brute_force_with_a_large_group_of_near_copies(spark, make_docs, edge_texts):
    """Chains of edits whose ends are not similar, in buckets beyond the small bound."""
    rng = random.Random(1)
    texts = dict(enumerate(edge_texts))
    base = prose(rng, 120, 5000).split()
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = f"edit{i}"
        texts[1000 + i] = " ".join(copy)
    params = NearDup(3, 85, 100, small=8, block=32)
    df = make_docs(list(texts.items()))
    _check(near_duplicates(df, params=params), texts, 3, 85)
    kept = drop_near_duplicates(df, params=params)
    assert kept.columns == df.columns
    want = brute.near_duplicates(texts, 3, 85)
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in sorted(texts) if want[i][1] == i]


def test_null_and_repeated_ids_and_empty_tables(make_docs):
    rows = near_duplicates(make_docs([(None, "a b c d"), (None, None), (3, "a b c d"), (3, "a b c d"), (1, "a b c d")]))
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in rows.collect())
    assert got == [("1", 2, 1, True), ("3", 2, 1, False), ("3", 2, 1, False), ("None", 0, None, True),
                   ("None", 2, None, True)]
    assert near_duplicates(make_docs([])).collect() == []


def test_signatures_are_permutation_ranks():
    """One element fills every slot, each with a different step."""
    import numpy as np

    sig = superminhash(np.array([12345], np.uint64), np.array([0, 1]), 16)
    assert sorted((sig[0] >> np.uint64(32)).tolist()) == list(range(16))
