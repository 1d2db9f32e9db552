"""Exact removal of repeated byte strings by externally sorted suffixes.

A byte goes when a ``length``-byte string that covers it also starts anywhere
else. Strings are judged on the input.

1. Sieve. Every window of ``length`` bytes picks one anchor, the smallest hash
   of its ``gram``-byte grams (leftmost of equals); neighbouring windows mostly
   pick the same one, so a document becomes a short list of (anchor, run of
   windows). Equal windows have equal anchors: runs whose anchor occurs once in
   the corpus hold no repeated window. A run whose bytes equal another run's
   with this anchor is repeated as a whole, and counting settles that: first
   among the runs of a chunk of documents, which sends on one of several equal
   runs, then among chunks. A text of short periods has a run for each of them.
2. Sort. Where runs of one anchor differ, their bytes are sorted: a shard's
   suffixes by induced sorting. The types of all suffixes are found, the
   leftmost S suffixes are ranked, and the order of all others is induced from
   them bucket by bucket through first-in-first-out queues. A task sorts its
   shards in memory, whole shards of about ``sort_bytes`` at a time: their text,
   types and fingerprints are held whole, and their queues of positions go to
   disk only beyond ``queue_bytes``, which shards of that size do not reach.
   Windows that share their first ``length`` bytes stand side by side in the
   sorted order.
3. Shards hold whole anchors. An anchor with very many different runs is split
   over shards, and its windows meet again by a fingerprint count.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (CHUNK_BYTES, bound_batches, give_back, materialize, mix64, prefix_hash, ranges, span_hash,
                     text_chunks)

_POS = np.uint64((1 << 31) - 1)  # a Spark string is shorter than this


@dataclass(frozen=True)
class Repeats:
    """``length``: shortest repeated string. ``gram``: bytes of an anchor.
    ``split``: different runs of an anchor that stay in one shard.
    ``shard_bytes``: bytes of runs a task is meant to hold. ``sort_bytes``: bytes
    of whole shards that are sorted at a time.
    ``queue_bytes``: memory of a shard's queues before they go to disk."""

    length: int = 200
    gram: int = 32
    split: int = 64
    shard_bytes: int = 2 << 20
    sort_bytes: int = 1 << 18
    queue_bytes: int = 64 << 20


# --- sieve -------------------------------------------------------------------

def window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    m, k = x, 1
    while 2 * k <= width:
        m, k = np.minimum(m[:-k], m[k:]), 2 * k
    return np.minimum(m[:len(x) - width + 1], m[width - k:width - k + len(x) - width + 1])


def anchor_runs(data: np.ndarray, offs: np.ndarray, p: Repeats):
    """(document, first window, end window, anchor hash, run hash) of every run."""
    z = np.zeros(0, np.int64)
    if len(data) < p.length:
        return z, z, z, z.view(np.uint64), z.view(np.uint64)
    pre = prefix_hash(data)
    at = np.arange(len(data) - p.gram + 1)
    gram = mix64(span_hash(pre, at, at + p.gram))
    key = (gram & ~_POS) | at.astype(np.uint64)
    pick = (window_min(key, p.length - p.gram + 1) & _POS).astype(np.int64)
    ok = np.zeros(len(pick) + 1, bool)  # windows inside one document
    long = np.diff(offs) >= p.length
    edge = np.zeros(len(pick) + 2, np.int64)
    np.add.at(edge, offs[:-1][long], 1)
    np.add.at(edge, offs[1:][long] - p.length + 1, -1)
    ok[:-1] = np.cumsum(edge)[:len(pick)] > 0
    new = np.ones(len(pick), bool)
    new[1:] = (pick[1:] != pick[:-1]) | ~ok[:-2]
    new[offs[:-1][long]] = True
    first = np.flatnonzero(new & ok[:-1])
    stop = np.flatnonzero(np.append(new | ~ok[:-1], True))
    end = stop[np.searchsorted(stop, first, "right")]
    doc = np.searchsorted(offs, first, "right") - 1
    run = mix64(span_hash(pre, first, end + p.length - 1) + (end - first).astype(np.uint64))
    return doc, first - offs[doc], end - offs[doc], gram[pick[first]], run


def settle(doc: np.ndarray, first: np.ndarray, end: np.ndarray, anchor: np.ndarray, run: np.ndarray):
    """What the runs of a chunk tell each other: the first of each set of equal
    runs, how many it stands for (1, or 2 for more), and (document, first, end) of
    the windows of all runs that have an equal one, runs side by side as one span."""
    order = np.lexsort((run, anchor))
    a, r = anchor[order], run[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    n = np.diff(np.append(np.flatnonzero(new), len(order)))
    at = np.sort(order[np.repeat(n > 1, n)])
    opens = np.ones(len(at), bool)
    opens[1:] = (doc[at[1:]] != doc[at[:-1]]) | (first[at[1:]] != end[at[:-1]])
    closes = np.append(opens[1:], True)[:len(at)]
    return order[new], np.minimum(n, 2), (doc[at[opens]], first[at[opens]], end[at[closes]])


def _runs(p: Repeats):
    """Runs to be counted, one of equal ones of a chunk; and, without an anchor,
    the spans of windows that the chunk has found repeated."""
    def go(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                doc, first, end, anchor, run = anchor_runs(data, offs, p)
                some, n, settled = settle(doc, first, end, anchor, run)
                rows = batch.column(0).slice(lo, hi - lo)
                blank = pa.nulls(len(settled[0]), pa.int64())
                for (d, a, b), rest in (
                        ((doc[some], first[some], end[some]),
                         [pa.array(anchor[some].view(np.int64)), pa.array(run[some].view(np.int64)), pa.array(n, pa.int32())]),
                        (settled, [blank, blank, blank.cast(pa.int32())])):
                    yield pa.RecordBatch.from_arrays(
                        [rows.take(pa.array(d)), pa.array(a, pa.int32()), pa.array(b, pa.int32()), *rest],
                        names=["row", "first", "end", "anchor", "run", "n"])
    return go


# --- induced sorting ---------------------------------------------------------

class BucketQueue:
    """First-in-first-out queues of suffix positions, one per first symbol.
    Arrays stay in memory up to ``budget`` bytes in all, then go to files."""

    def __init__(self, folder: str, buckets: int, budget: int, kind: type = np.int64):
        self.folder, self.budget, self.held, self.kind = folder, budget, 0, kind
        self.parts: list[list] = [[] for _ in range(buckets)]
        self.files = 0

    def push(self, bucket: int, x: np.ndarray) -> None:
        if self.held + x.nbytes > self.budget:
            path = os.path.join(self.folder, f"{id(self)}-{self.files}")
            self.files += 1
            x.tofile(path)
            self.parts[bucket].append(path)
        else:
            self.held += x.nbytes
            self.parts[bucket].append(x)

    def pop(self, bucket: int) -> np.ndarray | None:
        """The oldest file of a queue, or all arrays before its first file."""
        parts = self.parts[bucket]
        if not parts:
            return None
        if isinstance(path := parts[0], str):
            del parts[0]
            x = np.fromfile(path, self.kind)
            os.unlink(path)
            return x
        n = next((k for k, x in enumerate(parts) if isinstance(x, str)), len(parts))
        x = np.concatenate(parts[:n]) if n > 1 else parts[0]
        del parts[:n]
        self.held -= x.nbytes
        return x

    def push_by(self, symbol: np.ndarray, x: np.ndarray) -> None:
        """Deal positions to the queues of their symbols, order kept."""
        if not len(x):
            return
        order = np.argsort(symbol, kind="stable")
        s, x = symbol[order], x[order]
        cut = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        for a, b in zip(cut, np.append(cut[1:], len(s)), strict=True):
            self.push(int(s[a]), x[a:b])


def s_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the end is smallest."""
    n = len(t)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int32) - t[:-1])
    step[-1] = -1
    last = np.arange(n, dtype=_places(n))
    last[step == 0] = n
    np.minimum.accumulate(last[::-1], out=last[::-1])
    return step[last] > 0


def _places(n: int) -> type:
    """What holds a place of a text of ``n`` symbols."""
    return np.int32 if n < 1 << 30 else np.int64


def rank_leftmost(t: np.ndarray, s: np.ndarray, lms: np.ndarray, depth: int) -> np.ndarray:
    """Leftmost S positions sorted by their suffixes, up to ``depth`` symbols.

    The pieces between them get names in their order, and the sequence of names
    is sorted by prefix doubling."""
    lms = lms.astype(np.int64)
    end = np.append(lms[1:] + 1, len(t))
    sym = (t.astype(np.uint16) << 1) | s  # a piece is never a prefix of another
    as_bytes = sym.astype(">u2").view(np.uint8)
    key = span_hash(prefix_hash(as_bytes), 2 * lms, 2 * end) + (end - lms).astype(np.uint64)
    order = np.argsort(key)
    k = key[order]
    new = np.concatenate(([True], k[1:] != k[:-1]))
    raw = as_bytes.tobytes()
    some = order[new]
    texts = [raw[2 * a:2 * b] for a, b in zip(lms[some].tolist(), end[some].tolist(), strict=True)]
    rank_of = np.empty(len(texts), np.int64)
    rank_of[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(1, len(texts) + 1)
    name = np.empty(len(lms), np.int64)
    name[order] = rank_of[np.cumsum(new) - 1]
    n, step = len(lms), 1
    order = np.argsort(name, kind="stable")
    while step < n and 2 * step < depth:  # a piece adds two symbols at least
        nxt = np.zeros(n, np.int64)
        nxt[:-step] = name[step:]
        key = name * (n + 1) + nxt
        order = np.argsort(key)
        k = key[order]
        name = np.empty(n, np.int64)
        name[order] = np.cumsum(np.concatenate(([True], k[1:] != k[:-1])))
        if name[order[-1]] == n:
            break
        step *= 2
    return lms[order].astype(_places(len(t)))


def sorted_buckets(t: np.ndarray, symbols: int, depth: int, folder: str, budget: int) -> Iterator[np.ndarray]:
    """All suffixes of ``t`` in ascending order of their first ``depth`` symbols
    within a bucket; buckets (by first symbol) come last to first."""
    s, kind = s_types(t), _places(len(t))
    lms = (np.flatnonzero(s[1:] & ~s[:-1]) + 1).astype(kind)
    stars = rank_leftmost(t, s, lms, depth) if len(lms) else lms
    at = np.searchsorted(t[stars], np.arange(symbols + 1))
    todo = BucketQueue(folder, symbols, budget, kind)
    done = BucketQueue(folder, symbols, budget, kind)
    todo.push(int(t[-1]), np.array([len(t) - 1], kind))  # the end induces the last suffix
    for c in range(symbols):
        while (x := todo.pop(c)) is not None:
            done.push(c, x)
            before = x[x > 0] - 1
            before = before[~s[before]]
            todo.push_by(t[before], before)
        star = stars[at[c]:at[c + 1]]
        before = star - 1
        todo.push_by(t[before], before)
    for c in range(symbols - 1, -1, -1):
        small = []
        while (x := todo.pop(c)) is not None:  # descending
            small.append(x)
            before = x[x > 0] - 1
            before = before[s[before]]
            todo.push_by(t[before], before)
        large = []
        while (x := done.pop(c)) is not None:
            large.append(x)
        for x in reversed(large):
            before = x[::-1]
            before = before[before > 0] - 1
            before = before[s[before]]
            todo.push_by(t[before], before)
        if large or small:
            yield np.concatenate([*large, *(x[::-1] for x in reversed(small))])


def whole_shards(batches, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Rows that come by shard, in groups of whole shards: a group ends with the
    shard that brings it to ``limit`` bytes or more."""
    held, size, last = [], 0, None
    for batch in batches:
        shard = batch.column(batch.schema.get_field_index("shard")).to_numpy()
        n_bytes = pc.binary_length(batch.column(batch.schema.get_field_index("bytes"))).to_numpy()
        cum = np.concatenate(([0], np.cumsum(n_bytes, dtype=np.int64)))
        new = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else []
        lo = 0
        for a, b in zip(new, [*new[1:], len(shard)], strict=True):
            if size >= limit and shard[a] != last:
                yield [*held, batch.slice(lo, a - lo)]
                held, size, lo = [], 0, a
            size, last = size + cum[b] - cum[a], shard[a]
        held.append(batch.slice(lo))
    if size:
        yield held


def _sort_shard(p: Repeats):
    """Per shard: the repeated windows of its runs, as spans. Where several shards
    share an anchor, every class of equal windows is also named by its fingerprint:
    a lone window with its place and 1, a larger class without and with 2. Rows come
    by shard."""
    def go(batches):
        with tempfile.TemporaryDirectory() as folder:
            for group in whole_shards(batches, p.sort_bytes):
                yield from _sort_group(p, group, folder)
                give_back()
    return go


def _sort_group(p: Repeats, group: list[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    names = ["row", "first", "end", "mark", "weight"]
    path, meta = os.path.join(folder, "text"), []
    with open(path, "wb") as f:
        for batch in group:
            raw = batch.column(batch.schema.get_field_index("bytes"))
            for x in raw:
                f.write(x.as_buffer())
                f.write(b"\0")
            size = np.array([len(x.as_buffer()) for x in raw], np.int64)
            cols = batch.select(["row", "first", "weight", "shared"]).to_pandas()
            meta.append(np.column_stack((cols.to_numpy(np.int64), size)))
    row, first, weight, shared, size = np.concatenate(meta).T
    data = np.fromfile(path, np.uint8)
    start = np.cumsum(size + 1) - size - 1
    t = data.astype(np.uint16) + 1
    t[start + size] = 0  # a run's end, smaller than any byte
    n_windows = size - p.length + 1
    at = ranges(start, n_windows).astype(_places(len(t)))
    run_of = np.full(len(t), -1, np.int32)
    run_of[at] = np.repeat(np.arange(len(row), dtype=np.int32), n_windows)
    fp, pre = np.zeros(len(t), np.uint64), prefix_hash(data)
    for lo in range(0, len(at), _SEND):
        x = at[lo:lo + _SEND]
        fp[x] = mix64(span_hash(pre, x, x + p.length))
    del at, pre, data
    dup = np.zeros(len(t) + 1, bool)
    classes = []
    for bucket in sorted_buckets(t, 257, p.length, folder, p.queue_bytes):
        x = bucket[run_of[bucket] >= 0]
        if not len(x):
            continue
        f = fp[x]
        edge = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
        total = np.add.reduceat(weight[run_of[x]], edge)
        dup[x[np.repeat(total >= 2, np.diff(np.append(edge, len(x))))]] = True
        split = np.maximum.reduceat(shared[run_of[x]], edge) > 0
        classes.append((x[edge[split]], np.minimum(total[split], 2)))
    dup[start + n_windows] = False  # a span ends with its run
    flips = np.flatnonzero(dup != np.concatenate(([False], dup[:-1])))
    a, b = flips[::2], flips[1::2]
    r = run_of[a]
    yield pa.RecordBatch.from_arrays(
        [pa.array(row[r]), pa.array(a - start[r] + first[r]), pa.array(b - start[r] + first[r]),
         pa.nulls(len(r), pa.int64()), pa.nulls(len(r), pa.int64())], names=names)
    x = np.concatenate([c for c, _ in classes]) if classes else np.zeros(0, np.int64)
    if len(x):
        w, r = np.concatenate([c for _, c in classes]), run_of[x]
        lone, place = np.where(w > 1, -1, row[r]), x - start[r] + first[r]
        for i in range(0, len(x), _SEND):
            k = slice(i, i + _SEND)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lone[k]), pa.array(place[k]), pa.array(place[k] + 1),
                 pa.array(fp[x[k]].view(np.int64)), pa.array(w[k])], names=names)


#: Classes of a batch that a shard sends.
_SEND = 50_000


def meeting_windows(classes: DataFrame) -> DataFrame:
    """(row, first, end) of the lone windows whose fingerprint another shard has
    too. A shard names a fingerprint once, so a group has at most one row a shard."""
    # collect_list skips the nulls of larger classes.
    at = F.when(F.col("row") >= 0, F.struct("row", "first", "end"))
    met = classes.groupBy("mark").agg(F.sum("weight").alias("n"), F.collect_list(at).alias("at"))
    return met.filter("n > 1").select(F.inline("at"))


# --- operator ----------------------------------------------------------------

def _cut(p: Repeats):
    """The bytes of the wanted runs of each document."""
    def go(batches):
        for batch in batches:
            at, out, size = batch.schema.get_field_index, [], 0
            for row, text, runs in zip(batch.column(at("row")).to_pylist(), batch.column(at("text")),
                                       batch.column(at("runs")).to_pylist(), strict=True):
                raw = text.as_buffer()
                for r in runs:
                    piece = raw[r["first"]:r["end"] + p.length - 1].to_pybytes()
                    out.append((row, r["first"], r["weight"], r["shared"], r["shard"], piece))
                    size += len(piece)
                    if size >= CHUNK_BYTES:
                        yield _pieces(out)
                        out, size = [], 0
            if out:
                yield _pieces(out)
    return go


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CUT, strict=True)],
                                      schema=_CUT)


_CUT = pa.schema([("row", pa.int64()), ("first", pa.int64()), ("weight", pa.int64()),
                  ("shared", pa.int64()), ("shard", pa.int64()), ("bytes", pa.binary())])


def repeated_runs(src: DataFrame, p: Repeats) -> DataFrame:
    """(row, spans) of the rows of ``src`` (row, text) with repeated windows;
    a span [first, end) of window starts covers bytes first .. end + length - 2."""
    runs = materialize(bound_batches(src).filter(F.octet_length("text") >= p.length).mapInArrow(
        _runs(p), "row long, first int, end int, anchor long, run long, n int"), "suffix-runs")
    settled = runs.filter("anchor is null").select("row", "first", "end")
    counted = runs.filter("anchor is not null")
    # Equal runs of an anchor are done with where every chunk that has them has settled them.
    seen = materialize(counted.groupBy("anchor").agg(
        F.sum("n").alias("n"), F.min("n").alias("least"), F.min("run").alias("u"), F.max("run").alias("v"))
        .filter("u <> v or n > 1 and least = 1")
        .select("anchor", (F.col("u") == F.col("v")).alias("same")), "suffix-anchors")
    again = materialize(counted.join(seen, "anchor"), "suffix-candidates")
    mixed = again.filter("not same")
    kinds = materialize(mixed.groupBy("anchor", "run").agg(
        F.sum("n").alias("n"), F.min(F.struct("row", "first", "end")).alias("at")), "suffix-kinds")
    repeated = kinds.filter("n > 1").select("anchor", "run")
    whole = settled.unionByName(again.filter("same and n = 1").select("row", "first", "end")).unionByName(
        mixed.filter("n = 1").join(repeated, ["anchor", "run"]).select("row", "first", "end"))
    # Anchors with a run that no other run equals: its windows need the sort.
    open_ = materialize(kinds.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.min("n").alias("least")).filter("least = 1")
        .select("anchor", F.ceil(F.col("kinds") / p.split).alias("splits")), "suffix-open")
    wanted = kinds.join(open_, "anchor").select(
        "at.row", F.struct(
            "at.first", "at.end", F.least("n", F.lit(2)).alias("weight"),
            (F.col("splits") > 1).cast("long").alias("shared"),
            F.xxhash64("anchor", F.pmod("run", "splits")).alias("shard")).alias("r"))
    by_row = materialize(wanted.groupBy("row").agg(F.collect_list("r").alias("runs")), "suffix-wanted")
    size = by_row.agg(F.sum(F.aggregate(
        "runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["first"] + p.length))).first()[0] or 0
    pieces = src.join(by_row, "row").mapInArrow(
        _cut(p), "row long, first long, weight long, shared long, shard long, bytes binary")
    shards = pieces.repartition(max(1, -(-size // p.shard_bytes)), "shard").sortWithinPartitions("shard")
    found = materialize(shards.mapInArrow(_sort_shard(p), "row long, first long, end long, mark long, weight long"),
                        "suffix-found")
    met = meeting_windows(found.filter("mark is not null"))
    spans = whole.unionByName(found.filter("mark is null").select("row", "first", "end")).unionByName(met)
    return materialize(spans.groupBy("row").agg(F.collect_list(F.struct("first", "end")).alias("spans")),
                       "suffix-spans")


def _covered(spans, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed byte runs of window spans."""
    x = np.array(sorted((s["first"], s["end"] + length - 1) for s in spans), np.int64).reshape(-1, 2)
    top = np.maximum.accumulate(x[:, 1])
    new = np.ones(len(x), bool)
    new[1:] = x[1:, 0] > top[:-1]
    return x[new, 0], top[np.append(np.flatnonzero(new)[1:] - 1, len(x) - 1)]


def _keep(raw: bytes, first, end) -> bytes:
    at = [0, *(v for ab in zip(first.tolist(), end.tolist(), strict=True) for v in ab), len(raw)]
    return b"".join(raw[at[i]:at[i + 1]] for i in range(0, len(at), 2))


def _digest(length: int):
    def go(batches):
        for batch in batches:
            at = batch.schema.get_field_index
            out = []
            for text, spans in zip(batch.column(at("text")), batch.column(at("spans")), strict=True):
                raw = bytes(text.as_buffer()) if text.is_valid else b""
                kept, n = raw, 0
                if spans.is_valid:
                    first, end = _covered(spans.as_py(), length)
                    kept, n = _keep(raw, first, end), len(first)
                out.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(at("doc")), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return go


def repeat_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  params: Repeats = Repeats()) -> DataFrame:
    """One row per document: ``id_col, n_bytes, n_removed, n_spans`` (maximal
    removed runs), ``kept_sha256`` (of the remaining bytes).

    Null text counts as empty; texts shorter than ``length`` lose nothing. Rows
    are told apart by their place in ``docs``, so repeated and null ids are rows
    of their own; ``docs`` has to read the same each time, as files do.
    """
    src = docs.select(F.monotonically_increasing_id().alias("row"),
                      F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    spans = repeated_runs(src.select("row", "text"), params)
    out = src.join(spans, "row", "left").select("doc", "text", "spans").mapInArrow(
        _digest(params.length), "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("doc", id_col)


def _shorten(length: int):
    def go(batches):
        for batch in batches:
            i = batch.schema.get_field_index("__text")
            j = batch.schema.get_field_index("__spans")
            out = []
            for text, spans in zip(batch.column(i), batch.column(j), strict=True):
                raw = bytes(text.as_buffer())
                first, end = _covered(spans.as_py(), length)
                b = np.frombuffer(raw + b" ", np.uint8) & 0xC0
                # A run starts after and ends before a character that it cuts.
                while (cut := b[first] == 0x80).any():
                    first = first + cut
                while (cut := b[end] == 0x80).any():
                    end = end - cut
                out.append(_keep(raw, first, np.maximum(first, end)).decode())
            yield pa.RecordBatch.from_arrays(
                [*(c for k, c in enumerate(batch.columns) if k not in (i, j)), pa.array(out, pa.string())],
                names=[n for k, n in enumerate(batch.schema.names) if k not in (i, j)] + ["__text"])
    return go


def cut_repeats(docs: DataFrame, text_col: str = "text", chars_col: str | None = None,
                params: Repeats = Repeats()) -> DataFrame:
    """``docs`` with its columns, the repeated bytes cut from ``text_col`` (only
    whole characters go) and ``chars_col``, if given, set to the new length.
    Documents without repeats, null texts among them, come back unchanged."""
    keyed = docs.withColumn("__row", F.monotonically_increasing_id())
    spans = repeated_runs(keyed.select(F.col("__row").alias("row"), F.col(text_col).alias("text")), params)
    both = keyed.join(spans.select(F.col("row").alias("__row"), F.col("spans").alias("__spans")), "__row", "left")
    same = both.filter("__spans is null").select(*docs.columns)
    changed = both.filter("__spans is not null")
    others = [c for c in docs.columns if c != text_col]
    new = changed.select(*others, F.col(text_col).alias("__text"), "__spans")
    schema = new.drop("__text", "__spans").schema.add("__text", "string")
    new = new.mapInArrow(_shorten(params.length), schema).withColumnRenamed("__text", text_col)
    if chars_col:
        new = new.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return same.unionByName(new.select(*docs.columns))
