"""Ranked lexical search by pipelined term partitioning.

Every document shard (the texts that one task takes at a time) becomes postings:
for each asked term, the shard's documents that hold it and how often. The terms are
dealt to owners, rare ones first. A bundle, for one shard and one block of items,
carries sparse accumulators (item, document, integer score) through the owners'
stages: in each, a cogroup brings it together with that owner's postings of its
shard, and their contributions are added. After the last stage each bundle hands
on its best documents of every item, and the best of those are the result.

Between stages an accumulator goes once it cannot reach the shard's ``top`` best any
more, whatever the later owners add; that loses no result. A group of a cogroup is one
shard and one block of items, so it is bounded however common a term is. Which terms
are asked reaches the tasks as a bitmap of fixed size; it lets through all asked terms
(and by chance others, which meet no item in the join on the term itself).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_CHARS, bound_batches, lower_ascii, materialize, numbered, scratch_path, text_chunks, words

#: Documents returned for an item.
TOP = 50
#: Term owners, and so stages that a bundle passes.
OWNERS = 4
#: Bytes of text of a shard (or one document); items of a block (a power of two).
SHARD_BYTES, BLOCK_ITEMS = 4 << 20, 256
#: Bits of the map of asked terms: 2 MB.
MAP_BITS = 1 << 24
#: Bits of one row of Spark's bitmap functions.
_ROW_BITS = 1 << 15

_POSTINGS = "shard long, term binary, df long, max_tf long, at array<int>, tf array<int>, ids array<long>, lens array<long>"
_BUNDLE = ("shard long, block long, ids array<long>, lens array<long>, items array<long>, rest array<long>, "
           "acc_item array<int>, acc_doc array<int>, acc array<long>")


# --- terms -----------------------------------------------------------------

def _terms(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each term occurrence, the distinct terms, first occurrence of each document + end)."""
    b = lower_ascii(data)
    starts, ends, first = words(b, offs, WORD_CHARS)
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=at[1:])
    spelled = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(b[WORD_CHARS[b]])])
    coded = spelled.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, first


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("__row")
        for lo, hi, data, offs in text_chunks(batch, "text"):
            codes, terms, first = _terms(data, offs)
            who = np.repeat(np.arange(hi - lo), np.diff(first))
            pairs = np.unique(who * max(1, len(terms)) + codes)
            yield pa.RecordBatch.from_arrays([rows.slice(lo, hi - lo).take(pa.array(pairs // max(1, len(terms)))),
                                              terms.take(pa.array(pairs % max(1, len(terms))))], ["item", "term"])


def _postings(asked: bytes, shard_bytes: int):
    """Shards of documents as rows: one per asked term, one (term null) with all ids and lengths."""
    known = np.unpackbits(np.frombuffer(asked, np.uint8), bitorder="little").view(bool)

    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        spelled: dict[bytes, int] = {}
        got, ids, lens, size = [], [], [], 0

        def flush():
            shard = (part << 32) + count
            doc, term, tf = (np.concatenate(x) if got else np.zeros(0, np.int64) for x in (zip(*got) if got else ((), (), ())))
            order = np.lexsort((doc, term))
            doc, term, tf = doc[order], term[order], tf[order]
            cut = np.flatnonzero(np.diff(term)) + 1
            names, n_terms = list(spelled), len(cut) + (len(term) > 0)
            starts = np.concatenate(([0], cut))[:n_terms]
            df = np.diff(np.append(starts, len(term)))
            list_at = pa.array(np.append(np.append(starts, len(term)), len(term))[:n_terms + 2].astype(np.int32))
            empty = pa.array([None] * n_terms, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n_terms + 1, shard)),
                pa.array([names[t] for t in term[starts]] + [None], pa.binary()),
                pa.array(np.append(df, 0)),
                pa.array(np.append(np.maximum.reduceat(tf, starts) if n_terms else [], 0).astype(np.int64)),
                pa.ListArray.from_arrays(list_at, pa.array(doc.astype(np.int32))),
                pa.ListArray.from_arrays(list_at, pa.array(tf.astype(np.int32))),
                pa.concat_arrays([empty, pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()),
                                                                  pa.concat_arrays(ids))]),
                pa.concat_arrays([empty, pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()),
                                                                  pa.array(np.concatenate(lens)))]),
            ], ["shard", "term", "df", "max_tf", "at", "tf", "ids", "lens"])

        for batch in batches:
            who = batch.column("doc")
            for lo, hi, data, offs in text_chunks(batch, "text"):
                codes, terms, first = _terms(data, offs)
                names = terms.to_pylist()
                # Codes of this chunk as codes of the shard; -1 for terms that no item asks for.
                of = np.array([spelled.setdefault(t, len(spelled)) if known[zlib.crc32(t) % len(known)] else -1
                               for t in names] + [-1], np.int64)
                doc, term = np.repeat(np.arange(hi - lo), np.diff(first)), of[codes]
                doc, term = doc[term >= 0], term[term >= 0]
                pairs, tf = np.unique(doc * max(1, len(spelled)) + term, return_counts=True)
                base = sum(map(len, ids))
                got.append((pairs // max(1, len(spelled)) + base, pairs % max(1, len(spelled)), tf))
                ids.append(who.slice(lo, hi - lo))
                lens.append(np.diff(first).astype(np.int64))
                size += int(offs[-1])
                if size >= shard_bytes:
                    yield from flush()
                    spelled.clear()
                    got, ids, lens, size, count = [], [], [], 0, count + 1
        if ids:
            yield from flush()
    return run


def _asked_map(terms: DataFrame, bits: int) -> bytes:
    """A bitmap of the terms' CRC-32, built by grouped aggregation: ``bits / 8`` bytes on the driver."""
    place = F.crc32("term") % bits
    rows = terms.groupBy((place / _ROW_BITS).cast("long").alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place + 1)).alias("map")).collect()
    out = bytearray(bits // 8)
    for r in rows:
        out[r["row"] * _ROW_BITS // 8:(r["row"] + 1) * _ROW_BITS // 8] = r["map"]
    return bytes(out)


# --- owners ----------------------------------------------------------------

def _with_owner(weights: DataFrame, owners: int) -> DataFrame:
    """``owner`` of each term: rare terms first, so that each owner has about the
    same number of postings. The driver sees one row per power of two of ``df``."""
    level = F.floor(F.log2("df")).cast("int")
    sums = sorted((r["level"], r["n"]) for r in weights.groupBy(level.alias("level")).agg(F.sum("df").alias("n")).collect())
    total, before, owner = sum(n for _, n in sums), 0, F.lit(0)
    for k, n in sums:
        owner = F.when(level == k, min(owners - 1, before * owners // total)).otherwise(owner)
        before += n
    return weights.withColumn("owner", owner)


def _flat(col: pa.ChunkedArray, kind) -> np.ndarray:
    return col.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind)


def _stage(owner: int, owners: int, docs: int, total: int, top: int):
    """Adds one owner's contributions to a bundle; the last owner hands on the best documents."""
    last = owner == owners - 1

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        item_ids, lens = _flat(bundle["items"], np.int64), _flat(bundle["lens"], np.int64)
        rest = _flat(bundle["rest"], np.int64).reshape(len(item_ids), owners)
        n = len(lens)
        keys = [_flat(bundle["acc_item"], np.int64) * n + _flat(bundle["acc_doc"], np.int64)]
        adds = [_flat(bundle["acc"], np.int64)]
        norm = 20 * (50 + 50 * lens * docs // max(1, total))
        for w, items, at, tf in zip(*(postings[c] for c in ("w", "items", "at", "tf")), strict=True):
            at = at.values.to_numpy().astype(np.int64)
            tf = tf.values.to_numpy().astype(np.int64)
            add = w.as_py() * (1_000_000_000 * tf // (1000 * tf + norm[at]))
            for i in np.searchsorted(item_ids, items.values.to_numpy()):
                keys.append(i * n + at)
                adds.append(add)
        key, add = np.concatenate(keys), np.concatenate(adds)
        order = np.argsort(key, kind="stable")
        key, add = key[order], add[order]
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        score = np.add.reduceat(add, new) if len(new) else np.zeros(0, np.int64)
        item, doc = key[new] // max(1, n), key[new] % max(1, n)
        # An item's accumulators lie side by side; those that cannot be among its best go.
        later = rest[:, owner + 1:].sum(axis=1)
        keep = score > 0 if last else np.ones(len(score), bool)
        cuts = np.searchsorted(item, np.arange(len(item_ids) + 1))
        for i in np.flatnonzero(np.diff(cuts) > top):
            s = score[cuts[i]:cuts[i + 1]]
            keep[cuts[i]:cuts[i + 1]] &= s + later[i] >= np.partition(s, len(s) - top)[len(s) - top]
        item, doc, score = item[keep], doc[keep], score[keep]
        if last:
            ids = bundle["ids"].combine_chunks().flatten()
            return pa.table({"__row": item_ids[item], "doc": ids.take(pa.array(doc)), "score": score})
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x.astype(kind)))
        out = bundle.select(["shard", "block", "ids", "lens", "items", "rest"])
        return out.append_column("acc_item", one(item, np.int32)).append_column(
            "acc_doc", one(doc, np.int32)).append_column("acc", one(score, np.int64))
    return run


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   shard_bytes: int = SHARD_BYTES, block_items: int = BLOCK_ITEMS, map_bits: int = MAP_BITS) -> DataFrame:
    """The ``top`` best documents of every item: ``item_col, rank`` (from 1), ``id_col,
    score``; fewer where fewer have a score above 0.

    Terms are runs of ASCII letters (lower-cased), digits and non-ASCII characters;
    null and empty texts have none, so such items have no rows and such documents are
    not counted. Ids are integers. Every row is a document or an item of its own, also
    where ids repeat; equal scores go by ascending id, null ids last. Other columns,
    whatever their names, are not looked at.
    """
    spark: SparkSession = docs.sparkSession
    own = numbered(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")), "lexical-items")
    asked = materialize(bound_batches(own.select("__row", "text")).mapInArrow(_item_terms, "item long, term binary"),
                        "lexical-asked")
    src = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    shards = materialize(src.mapInArrow(_postings(_asked_map(asked, map_bits), shard_bytes), _POSTINGS), "lexical-postings")
    found, per_shard = shards.filter("term IS NOT NULL"), shards.filter("term IS NULL").select("shard", "ids", "lens")
    some = F.filter("lens", lambda n: n > 0)
    n_docs, n_words = per_shard.agg(F.coalesce(F.sum(F.size(some)), F.lit(0)), F.coalesce(
        F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, n: a + n)), F.lit(0))).first()

    weights = found.groupBy("term").agg(F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    most = F.expr("w * ((1000000000 * max_tf) div (1000 * max_tf + 1000))")  # lengths add at least 20 * 50
    weights = materialize(_with_owner(materialize(weights, "lexical-df"), owners)
                          .withColumn("w", weight).withColumn("most", most), "lexical-weights")
    block = F.shiftright("item", int(block_items).bit_length() - 1).alias("block")
    wanted = materialize(asked.join(weights.drop("df", "max_tf"), "term")
                         .select("term", "owner", "w", "most", "item", block), "lexical-wanted")
    # What each owner may still add to an item: owners in order, items of a block in order.
    rest = wanted.groupBy("block", "item").agg(
        F.array(*(F.coalesce(F.sum(F.when(F.col("owner") == t, F.col("most"))), F.lit(0).cast("long"))
                  for t in range(owners))).alias("rest"))
    blocks = materialize(rest.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("item", "rest"))).alias("all"))
                         .select("block", F.col("all.item").alias("items"), F.flatten("all.rest").alias("rest")),
                         "lexical-blocks")  # at most block_items of each
    of_block = wanted.groupBy("term", "owner", "w", "block").agg(F.collect_list("item").alias("items"))
    path = scratch_path(spark, "lexical-matched")
    matched = found.join(of_block, "term").select("shard", "block", "owner", "w", "items", "at", "tf")
    matched.write.partitionBy("owner").parquet(path)
    matched = spark.read.schema(matched.schema).parquet(path)

    none = [F.array().cast(f"array<{kind}>").alias(c) for c, kind in (("acc_item", "int"), ("acc_doc", "int"), ("acc", "long"))]
    bundles = (matched.select("shard", "block").distinct().join(per_shard, "shard").join(blocks, "block")
               .select("shard", "block", "ids", "lens", "items", "rest", *none))
    for t in range(owners):
        schema = "__row long, doc long, score long" if t == owners - 1 else _BUNDLE
        mine = matched.filter(F.col("owner") == t).select(F.col("shard").alias("of_shard"), F.col("block").alias("of_block"),
                                                          "w", "items", "at", "tf")
        bundles = bundles.groupBy("shard", "block").cogroup(mine.groupBy("of_shard", "of_block")).applyInArrow(
            _stage(t, owners, n_docs, n_words, top), schema)
    order = (F.col("score").desc(), F.col("doc").asc_nulls_last())
    best = bundles.withColumn("rank", F.row_number().over(Window.partitionBy("__row").orderBy(*order)))
    best = best.filter(F.col("rank") <= top).join(own.select("__row", "item_id"), "__row")
    return best.select(F.col("item_id").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
