"""Near-duplicate documents by SuperMinHash signatures.

Every shingle draws a random permutation of the signature slots and a fraction
per step; step j writes j + fraction at the slot it reaches (correlated ranks:
each slot gets one rank per shingle). A document stops as soon as all slots
hold a value, because later steps only bring larger ones. Signatures are cut
into bands; documents that share a band are verified on their full shingle
sets, and verified links are grouped by distributed union-find.

Only one document of each distinct shingle set is signed, linked and verified.
Verification runs in star rounds: a bucket's pivot against the others, so a
bucket of any size gives a linear number of pairs. What the rounds leave apart
is settled exactly: documents that share a band but not a component are all
compared, pair by pair in small buckets, and in large ones in blocks of sets
whose intersections one task counts at once, so no link between components is
lost and no pairs of a large group are written out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NOT_SPACE, bound_batches, connected_components, materialize, mix64, numbered, text_chunks,
                     without_rows, word_hashes)

_STEP = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass(frozen=True)
class NearDup:
    """Link when ``den * |A & B| >= num * |A | B|``.

    ``bands`` bands of ``rows`` slots: at similarity s a pair shares no band
    with probability (1 - s**rows) ** bands, 4e-7 at 0.85 and 5e-5 at 0.8.
    """

    shingle: int = 3
    num: int = 85
    den: int = 100
    bands: int = 25
    rows: int = 5
    star_rounds: int = 2
    #: Members of a bucket that are compared pair by pair; sets of a block beyond.
    small: int = 32
    block: int = 256


def shingle_hashes(h: np.ndarray, wofs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each document (all words as one shingle
    when there are fewer) and their offsets."""
    nw = np.diff(wofs)
    counts = np.where(nw >= k, nw - k + 1, (nw > 0).astype(np.int64))
    offs = np.zeros(len(nw) + 1, np.int64)
    np.cumsum(counts, out=offs[1:])
    first = np.repeat(wofs[:-1] - offs[:-1], counts) + np.arange(offs[-1])
    size = np.repeat(np.minimum(nw, k), counts)
    out = size.astype(np.uint64)
    for j in range(k):
        here = np.flatnonzero(size > j) if j else slice(None)
        out[here] = mix64(out[here] * _STEP + h[first[here] + j])
    return out, offs


def distinct_sets(s: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each document's shingles, and their offsets."""
    parts, n = [], np.zeros(len(offs), np.int64)
    for i in range(len(offs) - 1):
        v = np.sort(s[offs[i]:offs[i + 1]])
        if len(v) > 1:
            v = v[np.concatenate(([True], v[1:] != v[:-1]))]
        parts.append(v)
        n[i + 1] = len(v)
    return (np.concatenate(parts) if parts else s[:0]), np.cumsum(n)


def superminhash(elems: np.ndarray, offs: np.ndarray, m: int) -> np.ndarray:
    """(documents, m) signatures; a slot holds step << 32 | 32-bit fraction.

    A Fisher-Yates permutation per element, never stored: the position reached
    at step j is found by undoing the swaps drawn at steps j-1 .. 0.
    """
    nd = len(offs) - 1
    sig = np.full(nd * m, _EMPTY, np.uint64)
    doc = np.repeat(np.arange(nd), np.diff(offs))
    e, swaps, open_docs = elems, [], np.unique(doc)
    for j in range(m):
        x = mix64(e + np.uint64((j + 1) * int(_STEP) & int(_EMPTY)))
        k = j + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(m - j)) >> np.uint64(32)).astype(np.int64)
        at = k
        for i in range(j - 1, -1, -1):
            at = np.where(at == swaps[i], i, at)
        slot, low = doc * m + at, np.uint64(j << 32)
        free = sig[slot] >= low  # filled by an earlier step: smaller already
        np.minimum.at(sig, slot[free], low | (x[free] >> np.uint64(32)))
        still = (sig.reshape(nd, m)[open_docs] == _EMPTY).any(axis=1)
        if not still.any():
            break
        swaps.append(k)
        if not still.all():
            is_open = np.zeros(nd, bool)
            open_docs = open_docs[still]
            is_open[open_docs] = True
            keep = is_open[doc]
            e, doc, swaps = e[keep], doc[keep], [s[keep] for s in swaps]
    return sig.reshape(nd, m)


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(documents, bands) 64-bit hashes; the band number is part of the hash."""
    out = np.empty((len(sig), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            h = mix64(h * _STEP + sig[:, b * rows + r])
        out[:, b] = h
    return out


def _sets_of(data, offs, k):
    h, wofs = word_hashes(data, offs, NOT_SPACE)
    return distinct_sets(*shingle_hashes(h, wofs, k))


def _sign(p: NearDup):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                s, so = _sets_of(data, offs, p.shingle)
                bands = band_hashes(superminhash(s, so, p.bands * p.rows), p.bands, p.rows)
                n = np.diff(so)
                bands = bands[n > 0]
                total = np.zeros((2, len(s) + 1), np.uint64)
                np.cumsum(mix64(s ^ _STEP), out=total[0, 1:])
                np.cumsum(mix64(s + _STEP), out=total[1, 1:])
                fp = (total[:, so[1:]] - total[:, so[:-1]]).view(np.int64)
                lens = np.zeros(len(n) + 1, np.int32)
                np.cumsum((n > 0) * p.bands, out=lens[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n),
                     pa.array(fp[0]), pa.array(fp[1]),
                     pa.ListArray.from_arrays(pa.array(lens), pa.array(bands.ravel().view(np.int64)))],
                    names=["doc", "n", "fp1", "fp2", "bands"])
    return run


def _write_sets(p: NearDup):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                s, so = _sets_of(data, offs, p.shingle)
                raw = pa.Array.from_buffers(
                    pa.large_binary(), len(so) - 1,
                    [None, pa.py_buffer((so * 8).tobytes()), pa.py_buffer(s.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), raw.cast(pa.binary())], names=["doc", "elems"])
    return run


def _verify(p: NearDup):
    def run(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                u, v = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                both = np.sort(np.concatenate((u, v)))
                inter = int(np.count_nonzero(both[1:] == both[:-1]))
                keep[i] = p.den * inter >= p.num * (len(u) + len(v) - inter)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    params: NearDup = NearDup()) -> DataFrame:
    """One row per input document: ``id_col``, ``n_shingles``, ``component_id``
    (the smallest id reachable over links), ``kept`` (it is its own component id).

    Null and blank texts have an empty set and link with nothing. Rows with a
    null id, which nothing can name, keep a null component and are kept. Ids
    that repeat are one document with several texts. Other columns of ``docs``
    are not looked at, whatever their names.
    """
    p = params
    src = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    signed = materialize(src.mapInArrow(
        _sign(p), "doc long, n long, fp1 long, fp2 long, bands array<long>"), "smh-signed")
    reps = materialize(
        signed.filter("n > 0 and doc is not null").groupBy("fp1", "fp2", "n")
        .agg(F.min("doc").alias("rep"), F.min_by("bands", "doc").alias("bands")), "smh-reps")
    slots = reps.select("rep", "n", F.explode("bands").alias("band"))
    shared = materialize(slots.groupBy("band").agg(F.count("*").alias("size"))
                         .filter("size > 1").select("band"), "smh-shared")
    members = materialize(slots.join(shared, "band"), "smh-members")
    sets = _candidate_sets(src, members, p)
    links, labels = None, None
    for turn in range(p.star_rounds):
        todo = _undecided(members, labels)
        pick = (F.min_by(F.struct("rep", "n", "label"), F.col("rep")) if turn == 0 else
                F.max_by(F.struct("rep", "n", "label"), F.xxhash64("rep", F.lit(turn))))
        pivots = materialize(todo.groupBy("band").agg(pick.alias("q")), "smh-pivots")
        pairs = (todo.join(pivots, "band")
                 .filter("label <> q.label").filter(_close(p, F.col("n"), F.col("q.n")))
                 .select(F.col("rep").alias("a"), F.col("q.rep").alias("b")).groupBy("a")
                 .agg(F.min("b").alias("b")))
        links, labels = _link(pairs, sets, links, p)
    rest = materialize(_undecided(members, labels), "smh-rest")
    if not rest.isEmpty():
        sizes = materialize(rest.groupBy("band").agg(F.count("*").alias("size")), "smh-sizes")
        few = rest.join(sizes.filter(F.col("size") <= p.small), "band")
        x = few.select("band", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"))
        y = few.select("band", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"))
        pairs = (x.join(y, "band").filter("la < lb").filter(_close(p, F.col("na"), F.col("nb")))
                 .select("a", "b").distinct())
        many = rest.join(sizes.filter(F.col("size") > p.small).select("band"), "band")
        links, labels = _link(pairs, sets, links, p, _block_links(many, sets, p))
    of_set = reps.select("fp1", "fp2", F.col("n").alias("n2"), "rep").join(
        labels.select(F.col("node").alias("rep"), "root"), "rep", "left").select(
        "fp1", "fp2", "n2", F.coalesce("root", "rep").alias("component"))
    of_set = materialize(of_set, "smh-classes")
    named = signed.select("doc", "n", "fp1", "fp2")
    out = (named.join(of_set.withColumnRenamed("n2", "n"), ["fp1", "fp2", "n"], "left")
           .select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
                   F.when((F.col("n") == 0) | F.col("doc").isNull(), F.col("doc"))
                   .otherwise(F.col("component")).alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _close(p: NearDup, m, n):
    """Set sizes that can reach the threshold at all."""
    return F.least(m, n) * p.den >= F.greatest(m, n) * p.num


def _undecided(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(band, rep, n, label) of the bands whose members are in several components."""
    if labels is None:
        return members.withColumn("label", F.col("rep"))
    named = materialize(
        members.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("band", "rep", "n", F.coalesce("root", "rep").alias("label")), "smh-labelled")
    mixed = materialize(named.groupBy("band").agg(F.min("label").alias("u"), F.max("label").alias("v"))
                        .filter("u <> v").select("band"), "smh-mixed")
    return named.join(mixed, "band")


def _candidate_sets(src: DataFrame, members: DataFrame, p: NearDup) -> DataFrame:
    """Full shingle sets of the documents that share a band with another."""
    wanted = materialize(members.select(F.col("rep").alias("doc")).distinct(), "smh-wanted")
    texts = src.join(wanted, "doc")
    return materialize(texts.mapInArrow(_write_sets(p), "doc long, elems binary"), "smh-sets")


def _block_links(many: DataFrame, sets: DataFrame, p: NearDup) -> DataFrame:
    """Links (a, b) between the members of large buckets. Buckets that share
    members form a cluster, so each pair is compared once, not once a bucket;
    a cluster's sets are dealt to blocks, and each pair of blocks is one group."""
    many = materialize(many, "smh-many")
    firsts = materialize(many.groupBy("band").agg(F.min("rep").alias("b")), "smh-firsts")
    cluster = connected_components(many.join(firsts, "band").select(F.col("rep").alias("a"), "b"))
    named = many.select("rep", "label").distinct().join(
        cluster.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", "label", F.coalesce("root", "rep").alias("cluster"))
    named = materialize(named, "smh-cluster")
    blocks = materialize(named.groupBy("cluster").agg(F.ceil(F.count("*") / p.block).alias("blocks")), "smh-blocks")
    dealt = (named.join(blocks, "cluster").withColumn("own", F.pmod(F.xxhash64("rep"), "blocks"))
             .join(sets.withColumnRenamed("doc", "rep"), "rep")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    keyed = dealt.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         "own", "rep", "label", "elems")
    return keyed.groupBy("cluster", "i", "j").applyInArrow(_compare_blocks(p), "a long, b long")


def intersections(elems: np.ndarray, owner: np.ndarray, n: int, width: int = 4096) -> np.ndarray:
    """(n, n) sizes of the intersections of n sets given as flat (element, set)."""
    order = np.argsort(elems)
    e, o = elems[order], owner[order]
    new = np.concatenate(([True], e[1:] != e[:-1])) if len(e) else np.zeros(0, bool)
    shared = ~(new & np.concatenate((new[1:], [True]))) if len(e) else new
    column = np.cumsum(new[shared]) - 1
    o = o[shared]
    out = np.zeros((n, n), np.float32)  # exact: counts stay below 2**24
    cuts = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + width + 1, width))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        m = np.zeros((n, width), np.float32)
        m[o[a:b], column[a:b] % width] = 1
        out += m @ m.T
    return out


def _compare_blocks(p: NearDup):
    def run(table: pa.Table) -> pa.Table:
        rep, label = table.column("rep").to_numpy(), table.column("label").to_numpy()
        own, i, j = table.column("own").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("elems")]
        size = np.array([len(x) for x in sets], np.int64)
        both = intersections(np.concatenate(sets), np.repeat(np.arange(len(sets)), size), len(sets)).astype(np.int64)
        link = p.den * both >= p.num * (size[:, None] + size[None, :] - both)
        link &= label[:, None] != label[None, :]
        if i != j:  # pairs inside a block belong to (i, i)
            link &= own[:, None] != own[None, :]
        low = np.arange(len(sets))  # smallest row reachable: a few edges stand for all
        order = np.argsort(rep)
        link, rep = link[order][:, order], rep[order]
        while True:
            new = np.minimum(low, np.where(link, low[None, :], len(sets)).min(axis=1, initial=len(sets)))
            new = new[new]
            if (new == low).all():
                break
            low = new
        far = np.flatnonzero(low < np.arange(len(sets)))
        return pa.table({"a": rep[far], "b": rep[low[far]]})
    return run


def _link(pairs: DataFrame, sets: DataFrame, links: DataFrame | None, p: NearDup,
          more: DataFrame | None = None):
    """Verify pairs, add them (and ``more`` links) to the links, and group all."""
    pairs = materialize(pairs, "smh-pairs")
    half = pairs.join(sets.select(F.col("doc").alias("a"), F.col("elems").alias("x")), "a")
    full = half.join(sets.select(F.col("doc").alias("b"), F.col("elems").alias("y")), "b")
    new = materialize(full.select("a", "b", "x", "y").mapInArrow(_verify(p), "a long, b long"), "smh-links")
    links = new if links is None else links.unionByName(new)
    if more is not None:
        links = links.unionByName(materialize(more, "smh-block-links"))
    return links, connected_components(links)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         params: NearDup = NearDup(shingle=5, num=80)) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id,
    null ids last, and the first of those. Rows are linked by their own text,
    so repeated and null ids are rows of their own; blank texts link with
    nothing and stay. All columns come back as they were."""
    rows = numbered(docs, "smh-rows")
    found = near_duplicates(rows, "__row", text_col, params).select("__row", "component_id")
    order = F.struct(F.col(id_col).cast("long").isNull(), F.col(id_col).cast("long"), F.col("__row").alias("row"))
    first = (rows.select("__row", id_col).join(found, "__row").groupBy("component_id")
             .agg(F.min(order).alias("first")).select(F.col("first.row").alias("__row")))
    gone = rows.select("__row").join(materialize(first, "smh-first"), "__row", "left_anti")
    return without_rows(rows, gone, "smh-gone")
