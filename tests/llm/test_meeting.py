"""Windows of split anchors meet by a Spark aggregate on their fingerprint."""

import random

import brute
from texts import prose

from starloom.llm.suffix import Repeats, meeting_windows, repeat_digest


def test_windows_meet_in_as_many_partitions_as_the_session_has(spark):
    rows = [(1, 5, 6, 10, 1), (2, 7, 8, 10, 1), (3, 0, 1, 11, 1), (-1, 0, 1, 12, 2), (4, 9, 10, 12, 1), (-1, 2, 3, 13, 2)]
    met = meeting_windows(spark.createDataFrame(rows, "row long, first long, end long, mark long, weight long"))
    assert sorted(tuple(r) for r in met.collect()) == [(1, 5, 6), (2, 7, 8), (4, 9, 10)]
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(mark" in plan and "ArrowPython" not in plan and "GroupsInArrow" not in plan
    assert not hasattr(Repeats(), "buckets")


def test_split_anchors_with_many_variants_against_brute_force(make_docs):
    rng = random.Random(9)
    base = prose(rng, 60, 5000).split()
    texts = []
    for i in range(80):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(30)}"
        texts.append(" ".join(copy))
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"])
           for r in repeat_digest(make_docs(list(enumerate(texts))), params=Repeats(split=2, shard_bytes=8 << 10)).collect()}
    raws = [t.encode() for t in texts]
    want = {i: (sum(b - a for a, b in runs), len(runs)) for i, runs in enumerate(brute.repeated_spans(raws, 200))}
    assert got == want
