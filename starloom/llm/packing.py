"""Harmonic packing of token sequences.

Class k holds pieces of more than C/(k+1) and at most C/k tokens (C: capacity),
and a bin of class k takes k pieces, whatever their exact lengths. So every
worker fills its own bins with a counter per class, without seeing the others;
only what is left of its last bin of each class meets the other workers' rest,
again by count: a prefix sum over workers numbers the rest of a class.

Documents may be cut. Whole multiples of C become bins of their own, and the
remainder is cut into the slots with the least padding (``cut_plan``), where
every further piece counts as ``cut_cost`` tokens.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, materialize
from .tokens import TokenEncoder, encode_chunks

_LOCAL = 40  # bits of a worker's own bin counter
_REST = 1 << 61  # ids of bins that several workers fill


@lru_cache
def cut_plan(capacity: int, classes: int, cut_cost: float) -> tuple[tuple[tuple[int, int], ...], ...]:
    """For each remainder r < capacity its pieces as (length, class): a slot of
    class k is capacity // k long and costs its share of a bin."""
    best: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
    for r in range(1, capacity):
        options = []
        for k in range(1, classes + 1):
            slot = capacity // k
            take = min(r, slot)
            cost, rest = best[r - take]
            options.append((cost + capacity / k + cut_cost, len(rest), k, take))
        cost, _, k, take = min(options)
        best.append((cost, ((take, k), *best[r - take][1])))
    return tuple(p for _, p in best)


_PIECES = ("doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, worker long, class long, rank long")


def _pack(tokenizer: str, end_id: int, capacity: int, classes: int, cut_cost: float, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext

        enc, plan = TokenEncoder.of(tokenizer), cut_plan(capacity, classes, cut_cost)
        worker = TaskContext.get().partitionId()
        bins, filled = [[] for _ in range(classes + 1)], worker << _LOCAL
        names = [x.split()[0] for x in _PIECES.split(", ")] + ["ids"] * with_ids
        rows: list[tuple] = []

        def flush():
            cols = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [pa.int64()] * 10 + [pa.list_(pa.int64())] * with_ids
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for docs, ids, offs in encode_chunks(batch, enc, end_id):
                raw = ids.astype("<u4").tobytes()
                for i, doc in enumerate(docs.to_pylist()):
                    base, n = int(offs[i]), int(offs[i + 1] - offs[i])
                    pieces = [(capacity, 1)] * (n // capacity) + [*plan[n % capacity]]
                    at = 0
                    for length, k in pieces:
                        own = raw[4 * (base + at):4 * (base + at + length)]
                        more = (ids[base + at:base + at + length].tolist(),) if with_ids else ()
                        bins[k].append((doc, at, length, zlib.crc32(own), n, more))
                        at += length
                        if len(bins[k]) == k:
                            offset = 0
                            for *piece, more in bins[k]:
                                rows.append((*piece, filled, offset, worker, k, None, *more))
                                offset += piece[2]
                            bins[k], filled = [], filled + 1
                if rows:
                    yield flush()
        for k, left in enumerate(bins):
            for rank, (*piece, more) in enumerate(left):
                rows.append((*piece, None, None, worker, k, rank, *more))
        yield flush()
    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text", classes: int = 64,
                   cut_cost: float = 4.0, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and ``ids`` on request).

    A document is its ids followed by ``end_id``; null text counts as empty and
    gives that one id. Every id lies in one piece; pieces of a sequence follow
    each other without gaps. Equal or null document ids are packed row by row.
    """
    schema = _PIECES + ", ids array<long>" * with_ids
    src = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    pieces = materialize(
        src.mapInArrow(_pack(tokenizer, end_id, capacity, classes, cut_cost, with_ids), schema), "pieces")
    rest = pieces.filter("sequence_id is null")
    counts = rest.groupBy("worker", "class").agg(F.count("*").alias("n"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(
        counts.select("worker", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    number = F.col("base") + F.col("rank")
    binned = rest.join(bases, ["worker", "class"]).withColumns({
        "bin": F.floor(number / F.col("class")), "slot": number % F.col("class")})
    inside = Window.partitionBy("class", "bin").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    binned = materialize(
        binned.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")), "rest")
    # The last bin of a class may be short: at most one a class, joined first-fit.
    last = binned.groupBy("class", "bin").agg(F.count("*").alias("n"), F.sum("length").alias("used"))
    short = last.filter("n < class").orderBy("class").limit(classes).collect()
    moved = docs.sparkSession.createDataFrame(
        _first_fit([(r["class"], r["bin"], r["used"]) for r in short], capacity),
        "class long, bin long, to long, shift long")
    placed = (binned.drop("sequence_id").join(F.broadcast(moved), ["class", "bin"], "left")
              .withColumn("sequence_id", F.coalesce(
                  "to", F.lit(_REST) + F.shiftleft("class", _LOCAL) + F.col("bin")))
              .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0))))
    cols = ["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    out = pieces.filter("sequence_id is not null").select(cols).unionByName(placed.select(cols))
    return out.withColumnRenamed("doc", id_col)


def _first_fit(short: list[tuple[int, int, int]], capacity: int) -> list[tuple[int, int, int, int]]:
    """Put at most one short bin a class, longest first, into shared sequences:
    (class, bin, sequence id, offset there)."""
    used: list[int] = []
    out = []
    for k, b, n in sorted(short, key=lambda x: (-x[2], x[0])):
        at = next((i for i, u in enumerate(used) if u + n <= capacity), len(used))
        if at == len(used):
            used.append(0)
        out.append((k, b, 2 * _REST - 1 - at, used[at]))
        used[at] += n
    return out
