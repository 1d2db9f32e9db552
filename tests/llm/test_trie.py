"""The conversation trie against plain Python."""

import random
import zlib
from collections import defaultdict

import pytest

from brute import SPACED, sha
from starloom.llm.trie import SpillingQueue, conversation_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha(f"{len(role)}:{role}{text}"), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seq = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append((c, d == len(seq)))
    out = []
    for seq, members in nodes.items():
        below = [s for s in nodes if s[:len(seq)] == seq]
        inner = {s[:-1] for s in nodes if s}
        saved = sum((len(nodes[s]) - 1) * len(SPACED.findall(s[-1][1])) for s in below if s)
        ends = sorted(c for c, e in members if e)
        out.append((min(c for c, _ in members), len(seq), min(c for c, _ in nodes[seq[:-1]]) if seq else None, len(members),
                    sum(len(s) == len(seq) + 1 for s in below), sum(s not in inner for s in below), saved,
                    sha(",".join(map(str, ends)))))
    return sorted(out, key=str)


def _rows(rng, n_conv, n_text):
    rows = []
    for c in [*range(n_conv), 1000, 1013, -7, -20, -27]:
        if rng.random() < 0.05:
            continue
        same = rng.random() < 0.5  # half of the conversations begin alike, some are equal
        rows += [(c, t, "user" if t % 2 == 0 else rng.choice(["assistant", None]),
                  f"turn {t} of  all" if same else rng.choice([f"text {rng.randrange(n_text)}", "", None]))
                 for t in range(rng.choice([0, 1, 2, 3, 5, 9]))]
    rows += [(41, None, "user", "first"), (41, None, "user", "also first"), (41, 2, "user", "again"), (41, 2, "user", "again"),
             (None, 0, "user", "nobody's"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None) for r in rows], "conv_id long, turn long, role string, text string, "
                                 "conv string, depth int, words string")


@pytest.mark.parametrize("limits", [{}, {"fan": 2, "queue": 2, "piece": 2}, {"fan": 5, "queue": 1, "piece": 1}])
def test_conversation_trie(spark, limits):
    rows = _rows(random.Random(6), 60, 3)
    got = conversation_trie(_frame(spark, rows).repartition(4), **limits)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == trie(rows)


def test_a_conversation_of_a_third_of_all_rows(spark):
    rng = random.Random(2)
    rows = _rows(rng, 20, 3) + [(23, t, "user", f"long {t % 5}") for t in range(300)] + [(24, None, "user", "same")] * 200
    got = conversation_trie(_frame(spark, rows).repartition(4), fan=3)
    assert sorted(map(tuple, got.collect()), key=str) == trie(rows)


def test_no_conversations_and_no_turns(spark):
    assert conversation_trie(_frame(spark, [])).collect() == []
    assert conversation_trie(_frame(spark, [(None, 1, "user", "x")])).collect() == []
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)  # its only turn is replaced by none
    got = conversation_trie(_frame(spark, [(lone, 0, "user", "gone")]))
    assert list(map(tuple, got.collect())) == [(lone, 0, None, 1, 0, 1, 0, sha(str(lone)))]


def test_spilling_queue_pops_in_order():
    rng = random.Random(1)
    items = [(rng.randrange(20), rng.randrange(3), k) for k in range(500)]
    queue = SpillingQueue(7)
    for x in items:
        queue.push(x)
    assert len(queue.runs) > 10 and len(queue.heap) <= 7
    got = [x for key in sorted({x[:2] for x in items}) for x in sorted(queue.pop_key(key))]
    assert got == sorted(items)
    assert not queue.heap and not queue.runs
