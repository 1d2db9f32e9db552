import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm.packing import cut_plan, pack_documents
from starloom.llm.tokens import TokenEncoder, read_token_files, write_token_files

BYTES, WORDS = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def _ids(path, texts, end):
    tok = Tokenizer.from_file(path)
    return {i: [*tok.encode(t or "", add_special_tokens=False).ids, end] for i, t in texts.items()}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_round_trip(make_docs, edge_texts):
    texts = dict(enumerate(edge_texts))
    index = write_token_files(make_docs(list(texts.items())), WORDS, 2)
    got = {r["doc_id"]: r for r in read_token_files(index, with_ids=True).collect()}
    at = 0
    for i, ids in sorted(_ids(WORDS, texts, 2).items()):
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"], r["ids"]) == (at, len(ids), _crc(ids), ids)
        at += len(ids)
    assert len(got) == len(texts)


def test_files_of_null_and_repeated_ids_and_of_nothing(make_docs):
    rows = read_token_files(write_token_files(make_docs([(2, "b"), (None, "n"), (2, "a b"), (1, None)]), WORDS, 2))
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in rows.collect())
    assert got == [(0, None, 2), (2, 1, 1), (3, 2, 3), (6, 2, 2)]
    assert read_token_files(write_token_files(make_docs([]), WORDS, 2)).collect() == []


def test_every_id_lies_in_one_piece(make_docs, edge_texts):
    texts = dict(enumerate(edge_texts * 4))
    ids, pieces, sequences = _ids(BYTES, texts, 0), defaultdict(list), defaultdict(list)
    for r in pack_documents(make_docs(list(texts.items())), BYTES, with_ids=True).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, want in ids.items():
        mine = sorted(pieces[i], key=lambda r: r["start"])
        assert [x for r in mine for x in r["ids"]] == want
        assert all(r["doc_tokens"] == len(want) and r["ids_crc32"] == _crc(r["ids"]) for r in mine)
    used = padded = 0
    for mine in sequences.values():
        at = 0
        for r in sorted(mine, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        used, padded = used + at, padded + (1024 - at if at & (at - 1) else 0)
    assert padded < 0.02 * used
    assert pack_documents(make_docs([]), BYTES).collect() == []


def test_cut_plan_fills_slots():
    plan = cut_plan(1024, 64, 4.0)
    for r, pieces in enumerate(plan):
        assert sum(n for n, _ in pieces) == r
        assert all(0 < n <= 1024 // k for n, k in pieces)


def _mine(path, texts):
    """Ids by ``TokenEncoder``, all texts as one chunk."""
    raws = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(r) for r in raws])))
    ids, n = TokenEncoder.of(path).encode(np.frombuffer(b"".join(raws), np.uint8), offs)
    return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_every_character_at_every_kind_of_cut(path):
    """Beside a full stop, a comma, a line break and a space, first and last: the library's ids."""
    tok = Tokenizer.from_file(path)
    chars = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 8192):
        texts = []
        for c in chars[at:at + 8192]:
            texts.append(f"a{c}. B{c}, {c}. x{c}\n{c}y {c} z{c}")
        want = tok.encode_batch_fast(texts, add_special_tokens=False)
        bad = [t for t, e, m in zip(texts, want, _mine(path, texts), strict=True) if e.ids != m]
        assert not bad, bad[:5]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_odd_texts_and_a_small_cache(path, monkeypatch):
    import starloom.llm.tokens as tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    rng = random.Random(7)
    bits = ["a", "PARTİSİ,", "TARİHİ.", "\u09dc.", "it's", " ", "  ", "\n", "\n\n", "\t", "x.y", "1,000", "...", "<|endoftext|>",
            "<|", "ΟΔΟΣ.", "e\u0301.", "\u1100\u1161\u11a8.", "w" * 250, "\u00a0", "é,", "don't.", "\x1f", "\x85"]
    texts = ["", " ", "\n"] + ["".join(rng.choice(bits) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(1, 12)))
                              for _ in range(3000)]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 500):
        assert _mine(path, texts[at:at + 500]) == want[at:at + 500]
