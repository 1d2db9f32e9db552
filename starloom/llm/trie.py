"""Prefix trie of conversations by time-forward processing.

Conversations are rebuilt as turn sequences; a node is a distinct prefix. Its name is
its smallest member conversation and its depth, which is unique, because a conversation
has one prefix of each depth.

* Turns are numbered in a range-partitioned sort, so a conversation with a third of all
  rows lies in many partitions; places and prefix names are running sums inside a
  partition's piece of a conversation plus what its earlier pieces hand on.
* A prefix is named by sums of SHA-256 words of (place, turn): equal names mean equal
  prefixes but for a chance of about 2**-192 a pair.
* Totals go up in time-forward order: inside a shard, nodes come deepest first from
  Spark's external sort, and each sends its totals to its parent through a priority
  queue that spills. Shards are hashed subtrees of at most ``fan`` members; nodes with
  more are shared by shards, and are treated the same way a level up (at most ``fan``
  squared, and so on), with the totals of the shard roots below as input.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .mixing import WORD

#: Members of a shard's subtree at the first level, and the factor from level to level.
FAN = 256
#: Messages that a shard's queue holds in memory before it writes a sorted run.
QUEUE = 100_000
#: Decimal ids that are joined into one piece before they are hashed.
PIECE_IDS = 20_000
#: 32-bit words of SHA-256 that name a prefix: sums stay in 64 bits up to 2**31 turns.
_NAME = [f"s{k}" for k in range(6)]


# --- rebuilt conversations -------------------------------------------------

def _running(sums: list[str], window) -> list[Column]:
    return [F.sum(c).over(window).alias(c) for c in sums]


def rebuilt_turns(turns: DataFrame, modulus: int, choices: int) -> tuple[DataFrame, DataFrame]:
    """(paths, conversations). ``paths``: one row per conversation and depth from 1 on, with
    the prefix's name and the words of its last text. ``conversations``: ``conv, depth``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"))
    # ``row`` lets the range partitioning cut a run of equal rows as well.
    order = (F.col("conv"), F.col("turn").asc_nulls_first(), F.col("said"), F.col("row"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), "trie-turns")
    rows = rows.withColumn("part", F.shiftright("at", 33))

    # Pieces: a conversation's rows in one partition. Few conversations have more than one.
    pieces = rows.groupBy("conv", "part").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = materialize(pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "trie-pieces")
    crc = F.crc32(F.col("conv").cast("string"))
    convs = pieces.groupBy("conv").agg(F.sum("n").alias("n_own")).select(
        "conv", "n_own", (crc % choices).alias("h"), (F.col("conv") - F.col("conv") % modulus).alias("base"))
    length = convs.select(F.col("conv").alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.join(length, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("n_base", F.lit(0)))).drop("n_base")
    convs = materialize(convs.withColumn("depth", F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))),
                        "trie-conversations")

    def hashed(place: Column) -> list[Column]:
        digest = F.sha2(F.concat_ws(":", place.cast("string"), F.col("said")), 256)
        return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(s) for k, s in enumerate(_NAME)]

    # The turns that others take over: at most choices - 1 of each conversation.
    at = pieces.select("conv", "part", "start", "before")
    placed = rows.join(at, ["conv", "part"]).withColumn("p", F.col("at") - F.col("start") + F.col("before") + 1)
    first = placed.filter((F.col("p") < choices) & (F.col("conv") % modulus == 0))
    upto = Window.partitionBy("base").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    first = first.select(F.col("conv").alias("base"), F.col("p").alias("d"), "words", *hashed(F.col("p")))
    first = materialize(first.select("base", "d", "words", *_running(_NAME, upto)), "trie-first")
    head = convs.select("conv", "base", "taken").join(first, "base").filter(F.col("d") <= F.col("taken"))
    lead = head.filter(F.col("d") == F.col("taken")).select("conv", *(F.col(s).alias(f"lead_{s}") for s in _NAME))

    # A conversation's own turns after its first h, moved to their new places.
    shift = convs.select("conv", "h", (F.col("taken") - F.col("h")).alias("shift"))
    moved = rows.join(at.join(shift, "conv"), ["conv", "part"]).withColumn(
        "p", F.col("at") - F.col("start") + F.col("before") + 1).filter(F.col("p") > F.col("h"))
    place = F.col("p") + F.col("shift")
    moved = materialize(moved.select("conv", "part", place.alias("d"), "words", *hashed(place)), "trie-moved")
    carry = moved.groupBy("conv", "part").agg(*(F.sum(s).alias(s) for s in _NAME))
    carry = carry.select("conv", "part", *(F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"carry_{s}") for s in _NAME))
    carry = carry.join(lead, "conv", "left").select("conv", "part", *(
        (F.col(f"carry_{s}") + F.coalesce(F.col(f"lead_{s}"), F.lit(0))).alias(f"carry_{s}") for s in _NAME))
    inside = Window.partitionBy("conv", "part").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    own = moved.select("conv", "part", "d", "words", *_running(_NAME, inside)).join(carry, ["conv", "part"])
    own = own.select("conv", "d", "words", *((F.col(s) + F.col(f"carry_{s}")).alias(s) for s in _NAME))
    return head.select("conv", "d", "words", *_NAME).unionByName(own), convs.select("conv", "depth")


# --- time-forward processing -----------------------------------------------

class SpillingQueue:
    """A priority queue of tuples that keeps at most ``limit`` in memory: beyond it, all
    are written as a sorted run to an unnamed scratch file of the task, which goes with it."""

    def __init__(self, limit: int) -> None:
        self.limit, self.written, self.heap, self.runs = limit, 0, [], []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            run = tempfile.TemporaryFile(dir=folder)
            for x in sorted(self.heap):
                pickle.dump(x, run)
            run.seek(0)
            self.heap, self.written = [], self.written + 1
            heapq.heappush(self.runs, (pickle.load(run), self.written, run))  # the number tells equal items' runs apart

    def pop_key(self, key: tuple) -> Iterator[tuple]:
        """Remove and yield the items that begin with ``key``, the smallest there are."""
        n = len(key)
        while self.heap and self.heap[0][:n] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][:n] == key:
            item, k, run = self.runs[0]
            try:
                heapq.heapreplace(self.runs, (pickle.load(run), k, run))
            except EOFError:
                heapq.heappop(self.runs)[2].close()
            yield item


def _forward(queue_limit: int):
    """Nodes of whole subtrees, deepest first, by conversation: adds what their children send."""
    def run(batches):
        queue = SpillingQueue(queue_limit)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                children, leaves, saved = r["n_children"], r["n_leaves"], r["saved_tokens"] + r["own"]
                for _, _, n, more in queue.pop_key((-r["depth"], r["conv"])):
                    children, leaves, saved = children + 1, leaves + n, saved + more
                leaves = leaves if children else 1
                if (r["conv"], r["depth"]) != (r["root_conv"], r["root_depth"]):
                    queue.push((1 - r["depth"], r["parent"], leaves, saved))
                out.append((children, leaves, saved))
            cols = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv", "depth", "parent", "n_convs", "root_conv", "root_depth")]
                + [pa.array(x, pa.int64()) for x in cols],
                ["conv", "depth", "parent", "n_convs", "root_conv", "root_depth", "n_children", "n_leaves", "saved_tokens"])
    return run


_DONE = ("conv long, depth long, parent long, n_convs long, root_conv long, root_depth long, "
         "n_children long, n_leaves long, saved_tokens long")


def _sent(done: DataFrame) -> DataFrame:
    """What shard roots hand to their parents, summed by parent."""
    roots = done.filter((F.col("conv") == F.col("root_conv")) & (F.col("depth") == F.col("root_depth")))
    return roots.groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def subtree_totals(nodes: DataFrame, paths: DataFrame, total: int, fan: int, queue: int) -> tuple[DataFrame, DataFrame]:
    """(nodes with ``n_children, n_leaves, saved_tokens``, what depth 1 sends to the root).

    ``nodes``: ``conv, depth, parent, n_convs, own``; ``paths``: for every conversation and
    depth, ``node_conv`` and ``n_convs`` of its prefix. Members of a prefix only grow towards
    the root, so nodes of at most ``fan`` ** k members are whole subtrees below the others.
    """
    below, limit, done, messages = 0, fan, [], None
    while True:
        here = nodes.filter((F.col("n_convs") > below) & (F.col("n_convs") <= limit))
        # The root of a node's shard is the first prefix of its conversation inside the band.
        top = paths.filter((F.col("n_convs") > below) & (F.col("n_convs") <= limit)).groupBy("conv").agg(
            F.min_by("node_conv", "d").alias("root_conv"), F.min("d").alias("root_depth"))
        here = here.join(top, "conv")
        got = ("n_children", "n_leaves", "saved_tokens")
        if messages is None:
            here = here.select("*", *(F.lit(0).cast("long").alias(c) for c in got))
        else:
            here = here.join(messages, ["conv", "depth"], "left").fillna(0, list(got))
        order = (F.col("depth").desc(), "conv")
        shards = here.repartition("root_conv", "root_depth").sortWithinPartitions(*order)
        out = materialize(shards.mapInArrow(_forward(queue), _DONE), "trie-level")
        done.append(out)
        new = _sent(out)
        if messages is not None:  # to nodes above this band, from bands below it
            new = messages.unionByName(new).groupBy("conv", "depth").agg(*(F.sum(c).alias(c) for c in got))
        messages = materialize(new, "trie-messages")
        if limit >= total:
            break
        below, limit = limit, limit * fan
    all_done = done[0]
    for d in done[1:]:
        all_done = all_done.unionByName(d)
    return all_done, messages.filter("depth = 0")


# --- who ends where --------------------------------------------------------

def _pieces(limit: int):
    """Sorted (node, member) rows as comma-joined runs of decimal ids."""
    def run(batches):
        node, first, ids = None, None, []
        names = ["conv", "depth", "first", "ids"]
        for batch in batches:
            out = []
            for c, d, m in zip(*(batch.column(x).to_pylist() for x in ("conv", "depth", "member")), strict=True):
                if (c, d) != node or len(ids) >= limit:
                    if ids:
                        out.append((*node, first, ",".join(ids)))
                    node, first, ids = (c, d), m, []
                ids.append(str(m))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names) if out else pa.RecordBatch.from_pylist(
                [], pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, first, ",".join(ids))], names)
    return run


def _digests(batches):
    """Sorted pieces, one digest a node."""
    node, digest = None, None
    for batch in batches:
        out = []
        for c, d, ids in zip(*(batch.column(x).to_pylist() for x in ("conv", "depth", "ids")), strict=True):
            if (c, d) != node:
                if node:
                    out.append((*node, digest.hexdigest()))
                node, digest = (c, d), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["conv", "depth", "sha"])
    if node:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], ["conv", "depth", "sha"])


def member_digests(ends: DataFrame, piece: int) -> DataFrame:
    """SHA-256 of each node's comma-joined members, ascending, of ``conv, depth, member``.
    Sorting and joining ids is spread by ranges; only a node's pieces meet in one task,
    as a stream, because SHA-256 reads its input in order."""
    by = ("conv", "depth", "member")
    pieces = ends.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(
        _pieces(piece), "conv long, depth long, first long, ids string")
    pieces = pieces.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "first")
    return pieces.mapInArrow(_digests, "conv long, depth long, sha string")


# --- the trie --------------------------------------------------------------

def conversation_trie(turns: DataFrame, modulus: int = 20, choices: int = 4, fan: int = FAN, queue: int = QUEUE,
                      piece: int = PIECE_IDS) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations of ``turns``
    (``conv_id, turn, role, text``): ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    Conversation c takes the first h turns of c - c % ``modulus``, h being the CRC-32 of
    its decimal number modulo ``choices``, then its own after its first h. Turns go by
    ``turn``, null first; rows of one turn by the SHA-256 of role and text; repeated rows are
    turns of their own. Null role or text counts as empty. Rows without ``conv_id`` belong
    to no conversation and are not looked at, nor are other columns. No conversations: no
    nodes, not even a root.
    """
    paths, convs = rebuilt_turns(turns, modulus, choices)
    paths = materialize(paths, "trie-paths")
    total, least = convs.agg(F.count(F.lit(1)), F.min("conv")).first()
    nodes = paths.groupBy("d", *_NAME).agg(F.min("conv").alias("node_conv"), F.count(F.lit(1)).alias("n_convs"),
                                           F.min("words").alias("words"))
    nodes = materialize(nodes, "trie-prefixes")
    # Each conversation's nodes; one with a third of all conversations is split by adaptive execution.
    paths = materialize(paths.drop("words").join(nodes.drop("words"), ["d", *_NAME]).select("conv", "d", "node_conv", "n_convs"),
                        "trie-node-of")
    up = paths.select("conv", (F.col("d") + 1).alias("depth"), F.col("node_conv").alias("parent"))
    nodes = nodes.select(F.col("node_conv").alias("conv"), F.col("d").alias("depth"), "n_convs",
                         ((F.col("n_convs") - 1) * F.col("words")).alias("own"))
    nodes = nodes.join(up, ["conv", "depth"], "left")
    nodes = materialize(nodes.withColumn("parent", F.coalesce("parent", F.lit(least).cast("long"))), "trie-nodes")
    done, to_root = subtree_totals(nodes, paths, total, fan, queue)

    ends = convs.filter("depth > 0").withColumnRenamed("depth", "d").join(paths, ["conv", "d"])
    ends = ends.select(F.col("node_conv").alias("conv"), F.col("d").alias("depth"), F.col("conv").alias("member"))
    at_root = convs.filter("depth = 0").select(F.lit(least).cast("long").alias("conv"), "depth", F.col("conv").alias("member"))
    digests = member_digests(ends.unionByName(at_root), piece)

    root = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    sums = to_root.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    n_children, n_leaves, saved = sums.first()
    root = root.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), "n_convs",
                       *(F.lit(x).cast("long").alias(c) for c, x in (("n_children", n_children),
                                                                    ("n_leaves", n_leaves if n_children else 1),
                                                                    ("saved_tokens", saved))))
    out = done.drop("root_conv", "root_depth").unionByName(root).join(digests, ["conv", "depth"], "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                      "n_leaves", "saved_tokens",
                      F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
