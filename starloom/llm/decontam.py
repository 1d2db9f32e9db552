"""Benchmark decontamination by training suffix arrays.

Every task cuts its documents into shards of a few megabytes and sorts all word
suffixes of a shard (prefix doubling on word ranks). Each suffix of the test
set is then binary-searched in each shard, one word at a time: the range of
equal prefixes narrows until it is empty, which gives the suffix's longest
verbatim match and all its places. A window of the test set (13 words, or a
whole shorter item) that is reached marks the words it covers.

The test set is taken in blocks of bounded size, each searched in all shards,
so nothing of unknown size is sent to the executors. Documents are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_CHARS, bound_batches, numbered, ranges, text_chunks, without_rows, word_hashes

#: Test-set text that one pass over the shards takes.
BLOCK_BYTES = 8 << 20


@dataclass
class TestBlock:
    """Word hashes of some test items; a window is (first word, length, item)."""

    words: np.ndarray
    item_offs: np.ndarray
    names: list[str | None]
    window: int

    @classmethod
    def of(cls, items: list[tuple[str | None, str]], window: int) -> "TestBlock":
        raw = [t.encode() for _, t in items]
        offs = np.cumsum([0, *map(len, raw)])
        h, wofs = word_hashes(np.frombuffer(b"".join(raw), np.uint8), offs, WORD_CHARS)
        return cls(h, wofs, [i for i, _ in items], window)

    def __post_init__(self):
        n = np.diff(self.item_offs)
        item = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(self.words)) - self.item_offs[:-1][item]
        self.item, self.left = item, n[item] - at  # words from here to the item's end
        need = np.minimum(n[item], self.window)
        self.need = np.where((self.left >= self.window) | (at == 0), need, 0)  # 0: no window starts


class Shard:
    """Suffix array over the words of some documents, 0 after each document."""

    def __init__(self, h: np.ndarray, wofs: np.ndarray, depth: int):
        n_docs = len(wofs) - 1
        self.n = np.diff(wofs)
        order = np.argsort(h)
        s = h[order]
        new = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.zeros(0, bool)
        self.vocab = s[new]
        rank = np.empty(len(h), np.int64)
        rank[order] = np.cumsum(new)
        self.offs = wofs + np.arange(n_docs + 1)  # in the sequence with separators
        self.seq = np.zeros(len(h) + n_docs, np.int64)
        self.seq[np.arange(len(h)) + np.repeat(np.arange(n_docs), self.n)] = rank
        r, size, k = self.seq, len(self.seq), 1
        self.sa = np.argsort(r, kind="stable")
        while k < depth and size:
            nxt = np.zeros(size, np.int64)
            nxt[:-k or None] = r[k:] + 1 if k < size else 0
            key = r * (size + 2) + nxt
            self.sa = np.argsort(key)
            key = key[self.sa]
            step = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
            r = np.empty(size, np.int64)
            r[self.sa] = step
            if step[-1] == size - 1:
                break
            k *= 2

    def _bound(self, lo, hi, depth, word, side):
        """First place in sa[lo:hi] whose word at ``depth`` is >= (or >) ``word``."""
        lo, hi = lo.copy(), hi.copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            w = self.seq[self.sa[mid] + depth]
            right = w < word[open_] if side == "left" else w <= word[open_]
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
            open_ = open_[lo[open_] < hi[open_]]
        return lo

    def search(self, block: TestBlock):
        """Narrow every test suffix word by word. Yields (depth, suffixes, lo, hi):
        the suffixes whose first ``depth`` words occur, and their ranges in sa."""
        at = np.searchsorted(self.vocab, block.words)
        known = np.zeros(len(at), np.int64)
        ok = at < len(self.vocab)
        ok[ok] = self.vocab[at[ok]] == block.words[ok]
        known[ok] = at[ok] + 1
        live = np.flatnonzero(known)
        lo, hi = np.zeros(len(live), np.int64), np.full(len(live), len(self.sa), np.int64)
        depth = 0
        while len(live):
            word = known[live + depth]
            lo, hi = self._bound(lo, hi, depth, word, "left"), self._bound(lo, hi, depth, word, "right")
            keep = lo < hi
            live, lo, hi = live[keep], lo[keep], hi[keep]
            depth += 1
            yield depth, live, lo, hi
            more = block.left[live] > depth
            more[more] = known[live[more] + depth] > 0
            live, lo, hi = live[more], lo[more], hi[more]


def _hits(block: TestBlock):
    longest = int(block.left.max(initial=1))

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                shard = Shard(*word_hashes(data, offs, WORD_CHARS), min(longest, block.window))
                found = []
                for depth, suffix, a, b in shard.search(block):
                    if depth > block.window:
                        break
                    here = block.need[suffix] == depth
                    n = (b - a)[here]
                    at = shard.sa[ranges(a[here], n)]
                    found.append(np.stack((at, np.full(len(at), depth), np.repeat(block.item[suffix[here]], n))))
                at, depth, item = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
                cover = np.zeros(len(shard.seq) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + depth, -1)
                hit = np.concatenate(([False], np.cumsum(cover) > 0))
                edge = np.flatnonzero(hit[1:] != hit[:-1])
                first, end = edge[::2], edge[1::2]
                doc = np.searchsorted(shard.offs, first, "right") - 1
                spans = [[] for _ in range(hi - lo)]
                for d, s, e in zip(doc.tolist(), (first - shard.offs[doc]).tolist(),
                                   (end - shard.offs[doc]).tolist(), strict=True):
                    spans[d].append({"first": s, "end": e})
                names = [set() for _ in range(hi - lo)]
                pairs = np.searchsorted(shard.offs, at, "right") - 1
                for p in set((pairs * len(block.names) + item).tolist()):
                    d, i = divmod(p, len(block.names))
                    names[d].add(block.names[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array(shard.n), pa.array(spans, _SPANS),
                     pa.array([sorted(x for x in s if x is not None) for s in names], pa.list_(pa.string()))],
                    names=["row", "doc", "n_words", "spans", "items"])
    return run


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_HITS = "row long, doc long, n_words long, spans array<struct<first:long,end:long>>, items array<string>"


def _blocks(bench: DataFrame, id_col: str, text_col: str, window: int, limit: int) -> Iterator[TestBlock]:
    """The test set in blocks of at most ``limit`` bytes (or one item)."""
    rows, size = [], 0
    for r in bench.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        if r.t:
            if rows and size + len(r.t) > limit:
                yield TestBlock.of(rows, window)
                rows, size = [], 0
            rows.append((r.i, r.t))
            size += len(r.t)
    yield TestBlock.of(rows, window)


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
                  share: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``id_col, n_words, n_hit`` (words inside occurring
    windows), ``n_items, items`` (sorted ids of items with occurring windows),
    ``items_sha256, contaminated`` (any hit, and share * n_hit >= n_words), and
    ``spans``, the hit runs of words as [first, end).

    Null and empty texts have no words. Test items without words have no window;
    items with a null id mark words but are not listed; items that repeat an id
    count once. An empty test set hits nothing. Repeated or null document ids
    are judged row by row.
    """
    src = docs.select(F.monotonically_increasing_id().alias("row"),
                      F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    out = _judged(src, bench, item_col, item_text_col, window, share, block_bytes)
    return out.withColumnRenamed("doc", id_col).drop("row")


def _judged(src: DataFrame, bench: DataFrame, item_col: str = "item_id", item_text_col: str = "text",
            window: int = 13, share: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``contamination`` of (row, doc, text), with the row."""
    bound_batches(src)
    parts = [src.mapInArrow(_hits(block), _HITS)
             for block in _blocks(bench, item_col, item_text_col, window, block_bytes)]
    out = parts[0]
    if len(parts) > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        out = out.groupBy("row", "doc").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        out = out.mapInArrow(_merge_spans, _HITS)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    return out.select(
        "row", "doc", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"), "items", "spans")


def _merge_spans(batches):
    for batch in batches:
        rows = batch.select(["row", "doc", "n_words", "spans", "items"]).to_pylist()
        for r in rows:
            merged = []
            for s in sorted(r["spans"], key=lambda s: s["first"]):
                if merged and s["first"] <= merged[-1]["end"]:
                    merged[-1]["end"] = max(merged[-1]["end"], s["end"])
                else:
                    merged.append(dict(s))
            r["spans"] = merged
        yield pa.RecordBatch.from_pylist(rows, pa.schema(
            [("row", pa.int64()), ("doc", pa.int64()), ("n_words", pa.int64()), ("spans", _SPANS),
             ("items", pa.list_(pa.string()))]))


def _longest(block: TestBlock):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                shard = Shard(*word_hashes(data, offs, WORD_CHARS), int(block.left.max(initial=1)))
                best, place = np.zeros((2, len(block.words)), np.int64)
                for depth, suffix, a, _ in shard.search(block):
                    best[suffix], place[suffix] = depth, shard.sa[a]
                hit = np.flatnonzero(best)
                doc = np.searchsorted(shard.offs, place[hit], "right") - 1
                ids = batch.column(0).slice(lo, hi - lo).take(pa.array(doc))
                item = block.item[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.names[i] for i in item], pa.string()),
                     pa.array(hit - block.item_offs[:-1][item]), pa.array(best[hit]), ids,
                     pa.array(place[hit] - shard.offs[doc])],
                    names=["item", "item_word", "length", "doc", "doc_word"])
    return run


def longest_matches(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every test suffix with any match: ``item, item_word`` (where the suffix
    starts), ``length`` in words of its longest verbatim match, and one place of
    it, ``doc, doc_word``. Shards give one row each, reduced by a grouped maximum."""
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    schema = "item string, item_word long, length long, doc long, doc_word long"
    out = None
    for block in _blocks(bench, item_col, item_text_col, window, block_bytes):
        part = src.mapInArrow(_longest(block), schema)
        out = part if out is None else out.unionByName(part)
    best = F.max(F.struct("length", (-F.col("doc")).alias("d"), (-F.col("doc_word")).alias("w")))
    return (out.groupBy("item", "item_word").agg(best.alias("m"))
            .select("item", "item_word", "m.length", (-F.col("m.d")).alias("doc"),
                    (-F.col("m.w")).alias("doc_word")))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      null_ids_stay: bool = True, **options) -> DataFrame:
    """``docs``, all columns as they were, without the contaminated documents.
    Repeated ids are judged row by row, and so are null ids unless
    ``null_ids_stay``: then their rows stay whatever they hold."""
    rows = numbered(docs, "decontam-rows")
    found = _judged(rows.select(F.col("__row").alias("row"), F.col(id_col).cast("long").alias("doc"),
                                F.col(text_col).alias("text")), bench, **options).filter("contaminated")
    if null_ids_stay:
        found = found.filter("doc is not null")
    return without_rows(rows, found.select(F.col("row").alias("__row")), "gone")
