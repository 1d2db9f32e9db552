"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions (a path of nodes in a tree of 255), and each
node has its own context tree over the bytes before it, most recent first, up
to ``depth``. A context's Krichevsky-Trofimov estimate and the product of its
deeper contexts' weighted probabilities are mixed half and half, at every
depth; the learned weights of that mixture then predict any text. A text is
followed by an end byte, so probabilities are those of whole texts.

The model is a table of grams (context and byte), never broadcast. A chunk of
documents lists its distinct grams; the grams meet their tree nodes by key, and
each chunk gets back just its own grams with their probabilities, then reads its
texts beside them, one chunk a partition. A chunk is one input split, so its size
is bounded by ``spark.sql.files.maxPartitionBytes``. The deep part of the tree is computed in
groups that share their most recent ``TOP`` context bytes (with a depth of 5, at
most 2**24 grams a prefix), the top part by grouped sums of the nodes below.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, bound_batches, lower_ascii, materialize, text_chunks, word_hashes

END = 0xFF  # in no UTF-8 text; also stands before a text's first byte
DEPTH = 5
TOP = 3  # most recent bytes that the grams of a tree group share


# --- numpy: grams and trees ----------------------------------------------------

def gram_codes(data: np.ndarray, offs: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of every byte and end of the documents (lower-cased), and offsets:
    context bytes, most recent highest, and the byte itself lowest."""
    nd, width = len(offs) - 1, depth + 1
    out_offs = offs + np.arange(nd + 1)
    if not nd:
        return np.zeros(0, np.uint64), out_offs
    padded = offs + width * np.arange(nd + 1)  # each document after ``depth`` ends, before one
    here = np.ones(padded[-1], bool)
    here[(padded[:-1, None] + np.arange(depth)).ravel()] = False
    body = here.copy()
    body[padded[1:] - 1] = False
    s = np.full(len(here), END, np.uint64)
    s[body] = lower_ascii(data)
    code = s[depth:].copy()
    for k in range(1, width):
        code |= s[depth - k:-k] << np.uint64(8 * (width - k))
    return code[here[depth:]], out_offs


def counted(codes: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with their number (or summed weight)."""
    if weight is None:
        s = np.sort(codes)
    else:
        order = np.argsort(codes)
        s, weight = codes[order], weight[order]
    if not len(s):
        return s, np.zeros(0, np.int64)
    edge = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    n = np.diff(np.append(edge, len(s))) if weight is None else np.add.reduceat(weight, edge)
    return s[edge], n


class Lookup:
    """Values of sorted distinct keys, found in one step by a hash of the key; the
    keys that lost their slot to another by binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(len(keys), 2).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)
        self.slots[self._slot(keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys):
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Values of ``wanted``, which are all among the keys."""
        at = self.slots[self._slot(wanted)]
        other = np.flatnonzero(self.keys[at] != wanted)
        at[other] = np.searchsorted(self.keys, wanted[other])
        return self.values[at]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, after lifting small arguments."""
    x = np.asarray(x, float)
    lift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 8
        lift = np.where(small, lift + np.log(np.where(small, y, 1.0)), lift)
        y = np.where(small, y + 1, y)
    i = 1 / (y * y)
    series = (1 / 12 - i * (1 / 360 - i * (1 / 1260 - i * (1 / 1680 - i / 1188)))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - lift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of n0 zeros and n1 ones, as a logarithm."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def parent(key: np.ndarray) -> np.ndarray:
    """Node keys are context << 8 | bit prefix; the parent forgets the oldest byte."""
    return ((key >> np.uint64(16)) << np.uint64(8)) | (key & np.uint64(0xFF))


def bit_nodes(code: np.ndarray, n: np.ndarray, level: int):
    """(node key, zeros, ones) of one bit level for sorted (context, byte) codes."""
    key = (code >> np.uint64(8) << np.uint64(8)) | ((code & np.uint64(0xFF)) >> np.uint64(8 - level))
    bit = (code >> np.uint64(7 - level)) & np.uint64(1)
    edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    ones = np.add.reduceat(np.where(bit == 1, n, 0), edge)
    return key[edge], np.add.reduceat(n, edge) - ones, ones


def mixed(n0, n1, key, child_key=None, child_log=None) -> tuple[np.ndarray, np.ndarray]:
    """(weighted log probability, share of the estimate in the mixture)."""
    kt = log_kt(n0, n1)
    if child_key is None:
        return kt, np.ones(len(kt))
    below = np.bincount(np.searchsorted(key, parent(child_key)), child_log, len(key))
    both = np.logaddexp(kt, below) - math.log(2)
    return both, np.exp(kt - math.log(2) - both)


def deep_nodes(code: np.ndarray, n: np.ndarray, depth: int, top: int) -> dict:
    """(d, level) -> (keys, zeros, ones, weighted log, share) for d = depth .. top,
    from sorted distinct training grams; complete when all grams of a context of
    ``top`` bytes are here."""
    out = {}
    for d in range(depth, top - 1, -1):
        if d < depth:  # forget the oldest context byte
            code, n = counted(parent(code), n)
        for level in range(8):
            key, n0, n1 = bit_nodes(code, n, level)
            child = out.get((d + 1, level))
            log_w, share = mixed(n0, n1, key, *(child and (child[0], child[3]) or ()))
            out[d, level] = (key, n0, n1, log_w, share)
    return out


def descend(nodes: dict, code: np.ndarray, depth: int, depths, level: int, done, left):
    """Follow each gram down ``depths``: add what each context contributes to the
    probability of the gram's bit (all contexts are in ``nodes``)."""
    bit = ((code >> np.uint64(7 - level)) & np.uint64(1)).astype(bool)
    for d in depths:
        key, n0, n1, _, share = nodes[d, level]
        at = np.searchsorted(key, node_key(code, depth, d, level))
        hit = (np.where(bit, n1[at], n0[at]) + 0.5) / (n0[at] + n1[at] + 1.0)
        done = done + left * share[at] * hit
        left = left * (1 - share[at])
    return done, left


def node_key(code: np.ndarray, depth: int, d: int, level: int) -> np.ndarray:
    """Key of the node that decides bit ``level`` in a context of ``d`` bytes."""
    prefix = (code & np.uint64(0xFF)) >> np.uint64(8 - level)
    return (code >> np.uint64(8 * (depth + 1 - d)) << np.uint64(8)) | prefix


# --- blobs: sorted keys and aligned values of one (chunk, bucket) -------------------

def _squeeze(x: np.ndarray) -> bytes:
    """Bytes of equal significance side by side, then zstd."""
    import zstandard

    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes(), 1)


def _expand(blob, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


def _keys_blob(k: np.ndarray) -> bytes:
    return _squeeze(np.diff(k, prepend=np.uint64(0)))


def _keys(blob) -> np.ndarray:
    return np.cumsum(_expand(blob, np.uint64), dtype=np.uint64)


_WORD_END = np.uint64(0x5851F42D4C957F2D)  # stands for the end token among word hashes


def _tokens(data, offs):
    """Word hashes with an end token after each document, and offsets."""
    h, wofs = word_hashes(data, offs, NOT_SPACE)
    out_offs = wofs + np.arange(len(wofs))
    out = np.full(len(h) + len(wofs) - 1, _WORD_END, np.uint64)
    body = np.ones(len(out), bool)
    body[out_offs[1:] - 1] = False
    out[body] = h
    return out, out_offs


class _Distinct:
    """Distinct keys with summed training counts, merged now and then."""

    def __init__(self):
        self.parts: list = []

    def add(self, keys, train):
        k, n = counted(keys[train])
        self.parts.append((k, n))
        k, n = counted(keys[~train])
        self.parts.append((k, np.zeros_like(n)))
        if len(self.parts) >= 16:
            self.parts = [self.all()]

    def all(self):
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return counted(np.concatenate([k for k, _ in self.parts]), np.concatenate([n for _, n in self.parts]))


def _gram_bucket(code: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    from .common import mix64

    return (mix64(code >> np.uint64(8 * (depth + 1 - TOP))) % np.uint64(buckets)).astype(np.int64)


def _word_bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h % np.uint64(buckets)).astype(np.int64)


def _by_bucket(keys: np.ndarray, bucket: np.ndarray, buckets: int):
    """Order of keys by (bucket, key) and the ends of the buckets."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


_PARTS = "kind int, bucket long, chunk long, keys binary, counts binary"


def _list(depth: int, buckets: int):
    def run(batches):
        chunk, found = None, (_Distinct(), _Distinct())
        for batch in batches:
            chunk = batch.column(0)[0].as_py() if batch.num_rows and chunk is None else chunk
            held = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, offs in text_chunks(batch, "text"):
                for d, (k, o) in zip(found, (gram_codes(data, offs, depth), _tokens(data, offs)), strict=True):
                    d.add(k, np.repeat(~held[lo:hi], np.diff(o)))
        if chunk is None:
            return
        for kind, (d, place) in enumerate(zip(found, (lambda k: _gram_bucket(k, depth, buckets),
                                                      lambda k: _word_bucket(k, buckets)), strict=True)):
            keys, n = d.all()
            order, ends = _by_bucket(keys, place(keys), buckets)
            rows = [(b, order[ends[b]:ends[b + 1]]) for b in range(buckets) if ends[b] < ends[b + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(rows), pa.int32()), pa.array([b for b, _ in rows], pa.int64()),
                 pa.array([chunk] * len(rows), pa.int64()), pa.array([_keys_blob(keys[x]) for _, x in rows], pa.binary()),
                 pa.array([_squeeze(n[x].astype(np.uint32)) for _, x in rows], pa.binary())],
                names=["kind", "bucket", "chunk", "keys", "counts"])
    return run


# --- passes over the tree -----------------------------------------------------------

def _gathered(table: pa.Table):
    """A bucket's parts: keys of each part, and the distinct keys with their counts."""
    keys = [_keys(x.as_py()) for x in table.column("keys")]
    n = [_expand(x.as_py(), np.uint32).astype(np.int64) for x in table.column("counts")]
    return keys, *counted(np.concatenate(keys), np.concatenate(n))


_NODES = "bucket long, level int, key long, n0 long, n1 long, log_w double"


def _deep(depth: int):
    def run(table: pa.Table) -> pa.Table:
        _, code, n = _gathered(table)
        nodes = deep_nodes(code, n, depth, TOP)
        out = [pa.table({"bucket": np.full(len(k), table.column("bucket")[0].as_py()),
                         "level": pa.array(np.full(len(k), level, np.int32)), "key": k.view(np.int64),
                         "n0": n0, "n1": n1, "log_w": log_w})
               for level in range(8) for k, n0, n1, log_w, _ in [nodes[TOP, level]]]
        return pa.concat_tables(out)
    return run


def _weigh(batches):
    """Weighted log probability and estimate's share of nodes with children."""
    for batch in batches:
        n0, n1, below = (batch.column(i).to_numpy().astype(float) for i in (2, 3, 4))
        kt = log_kt(n0, n1)
        both = np.logaddexp(kt, below) - math.log(2)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(both), pa.array(np.exp(kt - math.log(2) - both))],
            names=["level", "key", "n0", "n1", "log_w", "share"])


def _parent_key(key):
    return F.shiftleft(F.shiftright(key, 16), 8).bitwiseOR(key.bitwiseAND(F.lit(255).cast("long")))


def _top_states(nodes: DataFrame) -> DataFrame:
    """(level, key, done, left) of the contexts of TOP - 1 bytes: what all contexts
    up to there contribute to a one, and what is left for deeper ones."""
    tables = []
    for _ in range(TOP):
        up = nodes.groupBy("level", _parent_key(F.col("key")).alias("key")).agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("log_w").alias("below"))
        nodes = materialize(up.mapInArrow(
            _weigh, "level int, key long, n0 long, n1 long, log_w double, share double"), "ctw-nodes")
        tables.append(nodes)
    state = None
    for nodes in reversed(tables):
        hit = F.col("share") * (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1.0)
        if state is None:
            state = nodes.select("level", "key", hit.alias("done"), (1 - F.col("share")).alias("left"))
        else:
            above = state.withColumnsRenamed({"key": "up", "done": "done0", "left": "left0"})
            state = nodes.withColumn("up", _parent_key(F.col("key"))).join(above, ["level", "up"]).select(
                "level", "key", (F.col("done0") + F.col("left0") * hit).alias("done"),
                (F.col("left0") * (1 - F.col("share"))).alias("left"))
        state = materialize(state, "ctw-state")
    return state


def _predict(depth: int):
    def run(table: pa.Table, states: pa.Table) -> pa.Table:
        parts, code, n = _gathered(table)
        nodes = deep_nodes(code, n, depth, TOP)
        level_of, key_of = states.column("level").to_numpy(), states.column("key").to_numpy().view(np.uint64)
        done_of, left_of = states.column("done").to_numpy(), states.column("left").to_numpy()
        value = np.zeros(len(code))
        for level in range(8):
            here = np.flatnonzero(level_of == level)
            here = here[np.argsort(key_of[here])]
            at = here[np.searchsorted(key_of[here], node_key(code, depth, TOP - 1, level))]
            one = ((code >> np.uint64(7 - level)) & np.uint64(1)).astype(bool)
            done = np.where(one, done_of[at], 1 - left_of[at] - done_of[at])
            value += np.log10(descend(nodes, code, depth, range(TOP, depth + 1), level, done, left_of[at])[0])
        value = value.astype(np.float32)
        return pa.table({"kind": pa.array([0] * len(parts), pa.int32()), "bucket": table.column("bucket"),
                         "chunk": table.column("chunk"), "keys": table.column("keys"),
                         "vals": pa.array([_squeeze(value[np.searchsorted(code, k)]) for k in parts], pa.binary())})
    return run


_VALUES = "kind int, bucket long, chunk long, keys binary, vals binary"


def _count_words(table: pa.Table) -> pa.Table:
    parts, words, n = _gathered(table)
    back = [_squeeze(n[np.searchsorted(words, k)].astype(np.uint32)) for k in parts]
    return pa.table({"kind": pa.array([1] * len(parts) + [2], pa.int32()),
                     "bucket": pa.array([*table.column("bucket").to_pylist(), int((n > 0).sum())], pa.int64()),
                     "chunk": pa.array([*table.column("chunk").to_pylist(), int(n.sum())], pa.int64()),
                     "keys": pa.array([*table.column("keys").to_pylist(), None], pa.binary()),
                     "vals": pa.array([*back, None], pa.binary())})


def _joined(blobs: list, kind) -> Lookup:
    """Values of all buckets of a chunk by key."""
    keys = np.concatenate([_keys(k) for k, _ in blobs])
    order = np.argsort(keys)
    return Lookup(keys[order], np.concatenate([_expand(v, kind) for _, v in blobs])[order])


def _score(depth: int, total: int, distinct: int):
    """Rows of a chunk: the values of its grams and words first, then its texts."""
    def scored(batch, grams, words):
        for lo, hi, data, offs in text_chunks(batch, "text"):
            code, co = gram_codes(data, offs, depth)
            score = np.add.reduceat(grams(code).astype(float), co[:-1])
            tok, to = _tokens(data, offs)
            c = words(tok).astype(np.int64)
            n = np.diff(to)
            base = np.add.reduceat(np.log10(c + 1), to[:-1]) - n * math.log10(total + distinct + 1)
            known = np.add.reduceat((c > 0).astype(np.int64), to[:-1])
            rows = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc"), rows.column("held"), pa.array(n), pa.array(known),
                 pa.array(np.full(len(n), total)), pa.array(base), pa.array(score), pa.array(np.diff(co))],
                names=["doc", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"])

    def run(batches):
        chunk, blobs, tables = None, None, None
        for batch in batches:
            at, is_text = batch.column("chunk").to_numpy(), batch.column("is_text").to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((at[1:] != at[:-1]) | (is_text[1:] != is_text[:-1])) + 1
            for lo, hi in zip([0, *edge], [*edge, batch.num_rows], strict=True):
                if lo == hi:
                    continue
                rows = batch.slice(int(lo), int(hi - lo))
                if at[lo] != chunk:
                    chunk, blobs, tables = at[lo], ([], []), None
                if is_text[lo]:
                    if tables is None:
                        tables = _joined(blobs[0], np.float32), _joined(blobs[1], np.uint32)
                        blobs = None
                    yield from scored(rows, *tables)
                else:
                    for kind, k, v in zip(*(rows.column(c).to_pylist() for c in ("kind", "keys", "vals")), strict=True):
                        blobs[kind].append((k, v))
    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = 2, folds: int = 7,
                depth: int = DEPTH, buckets: int | None = None) -> DataFrame:
    """One row per document: ``id_col, held_out, n_tokens, n_known, train_tokens,
    base_score`` (word unigram with add-one smoothing), ``score`` (log10 probability
    of the lower-cased text under the context tree) and ``bits_per_byte``.

    The model learns from the documents whose crc32 of the id as text is not
    ``fold`` modulo ``folds`` (null ids: training) and scores all. Null text
    counts as empty: the end alone. Repeated ids are scored row by row. ``docs``
    has to read the same each time, as files do.
    """
    if not TOP < depth <= 7:
        raise ValueError(f"depth must be above {TOP} and at most 7")
    if buckets is None:  # as many more as the session has partitions for more data
        buckets = max(256, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    src = bound_batches(docs).select(
        F.spark_partition_id().cast("long").alias("chunk"),
        F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False)).alias("held"),
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    parts = materialize(src.select("chunk", "held", "text").mapInArrow(_list(depth, buckets), _PARTS), "ctw-parts")
    grams, words = parts.filter("kind = 0"), parts.filter("kind = 1")
    nodes = materialize(grams.groupBy("bucket").applyInArrow(_deep(depth), _NODES), "ctw-deep")
    state = _top_states(nodes.select("level", "key", "n0", "n1", "log_w"))
    above = nodes.select("bucket", "level", _parent_key(F.col("key")).alias("key")).distinct().join(
        state, ["level", "key"])
    probs = grams.groupBy("bucket").cogroup(materialize(above, "ctw-above").groupBy("bucket")).applyInArrow(
        _predict(depth), _VALUES)
    counts = words.groupBy("bucket").applyInArrow(_count_words, _VALUES)
    values = materialize(probs.unionByName(counts), "ctw-values")
    sums = values.filter("kind = 2").agg(F.sum("chunk").alias("n"), F.sum("bucket").alias("v")).first()
    schema = ("doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double, n_bytes long")
    chunks = parts.agg(F.max("chunk")).first()[0]
    rows = values.filter("kind < 2").select("chunk", F.lit(False).alias("is_text"), "kind", "keys", "vals").unionByName(
        src.withColumn("is_text", F.lit(True)), allowMissingColumns=True)
    out = rows.repartitionById((chunks or 0) + 1, F.col("chunk").cast("int")).sortWithinPartitions(
        "chunk", "is_text").mapInArrow(_score(depth, int(sums["n"] or 0), int(sums["v"] or 0)), schema)
    return out.withColumn("bits_per_byte", -F.col("score") / math.log10(2) / F.col("n_bytes")).drop(
        "n_bytes").withColumnRenamed("doc", id_col)
