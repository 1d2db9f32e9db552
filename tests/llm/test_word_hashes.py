"""Words that a polynomial hash modulo a power of two cannot tell apart."""

import numpy as np
import pytest

from starloom.llm.common import NOT_SPACE, prefix_hash, span_hash, word_hashes
from starloom.llm.ctw import score_texts
from starloom.llm.decontam import contamination
from starloom.llm.superminhash import NearDup, near_duplicates


def _pair(n):
    """A Thue-Morse word of ``n`` letters and the same with its letters exchanged."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_hashes_differ(n):
    raws = [w.encode() for w in _pair(n)]
    data = np.frombuffer(b" ".join(raws), np.uint8)
    h, at = word_hashes(data, np.array([0, len(data)]), NOT_SPACE)
    assert len(h) == 2 and h[0] != h[1] and at.tolist() == [0, 2]


def test_hashes_do_not_depend_on_place_or_block():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 100, int(n))) for n in rng.integers(1, 200, 3000)] + [b"x" * 200_000]
    data = np.frombuffer(b" ".join(words), np.uint8)
    h, _ = word_hashes(data, np.array([0, len(data)]), NOT_SPACE)
    alone = {w: int(word_hashes(np.frombuffer(w, np.uint8), np.array([0, len(w)]), NOT_SPACE)[0][0]) for w in set(words)}
    assert [int(x) for x in h] == [alone[w] for w in words] and len(set(alone.values())) == len(alone)
    at = rng.integers(0, len(data) - 60, 500)
    spans = span_hash(prefix_hash(data), at, at + 50)
    raws = [data[i:i + 50].tobytes() for i in at]
    assert len(set(zip(raws, spans.tolist(), strict=True))) == len(set(raws)) == len(set(spans.tolist()))


def test_operators_tell_them_apart(spark, make_docs):
    one, other = _pair(1024)
    got = near_duplicates(make_docs([(1, one), (2, other)]), params=NearDup(3, 85, 100)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (2, 2)]
    bench = spark.createDataFrame([(1, one)], "item_id long, text string")
    hits = {r["doc_id"]: r["n_hit"] for r in contamination(make_docs([(1, one), (2, other)]), bench).collect()}
    assert hits == {1: 1, 2: 0}
    import zlib
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    learn = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 != 2][0]
    known = {r["doc_id"]: r["n_known"] for r in score_texts(make_docs([(learn, one), (held, other)])).collect()}
    assert known[learn] == 2 and known[held] == 1  # the word and the end; only the end
