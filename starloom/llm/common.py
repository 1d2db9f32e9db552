"""Helpers shared by the corpus operators: shared-folder tables, byte-level
word splitting and hashing on Arrow batches, distributed connected components.

Text is handled as UTF-8 bytes in numpy, a few megabytes at a time, so memory
per task is bounded by ``CHUNK_BYTES`` (or by one document, when that is larger).
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bytes of text that one numpy pass takes.
CHUNK_BYTES = 1 << 19

#: Word alphabets of the contracts: everything but ASCII white space, or ASCII
#: letters and digits plus all non-ASCII characters.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
WORD_CHARS = np.zeros(256, bool)
WORD_CHARS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

# glibc's malloc_trim, where there is one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Rows of an Arrow batch, so that a batch of texts stays a few megabytes.
BATCH_ROWS = 1000


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, with its session's Arrow batches bounded to ``BATCH_ROWS`` rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


# --- tables in the shared folder -------------------------------------------

def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and
    survives lost executors because the files are not theirs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number ``__row`` for each row, stored: every later reading
    sees the same numbers, also where ids repeat or are null."""
    return materialize(df.withColumn("__row", F.monotonically_increasing_id()), name)


def without_rows(rows: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """``rows`` of ``numbered`` but those whose ``__row`` is in ``gone``, unnumbered."""
    gone = materialize(gone.select(F.col("__row").alias("__gone")), name)
    return rows.join(gone, F.col("__row") == F.col("__gone"), "left_anti").drop("__row")


# --- numpy on Arrow string columns -----------------------------------------

def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0]:o[-1]], o - o[0]


#: What operators keep in a worker process from task to task.
WORKER_CACHES: list[dict] = []


def text_chunks(batch: pa.RecordBatch, text_col: str, limit: int = CHUNK_BYTES,
                keep: dict | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with at most ``limit`` bytes of text (or one row):
    yields (first row, end row, bytes, offsets). Caches other than ``keep`` that
    other operators' tasks left in this worker process are dropped."""
    for cache in WORKER_CACHES:
        if cache is not keep:
            cache.clear()
    data, offs = utf8(batch.column(batch.schema.get_field_index(text_col)))
    at, n = 0, len(offs) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield at, end, data[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
        at = end
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a reused Python worker otherwise keeps
    the arrays of earlier tasks, next to other workers of its machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift, multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd: invertible modulo 2**64
BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _STEP)
#: Bytes that are hashed at a time, and the low bits of an exponent.
_BLOCK, _LOW = 1 << 16, 12


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK_POWERS, _LOW_INVERSE = _powers(_BASE, _BLOCK), _powers(_INVERSE, 1 << _LOW)


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = hash of bytes i..j-1 times base**i."""
    out = np.zeros(len(data) + 1, np.uint64)
    for lo in range(0, len(data), _BLOCK):
        x = BYTE_CODE[data[lo:lo + _BLOCK]]
        x *= _BLOCK_POWERS[:len(x)]
        x *= np.uint64(pow(_BASE, lo, 1 << 64))
        x[:1] += out[lo]
        np.cumsum(x, out=out[lo + 1:lo + 1 + len(x)])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent hash of the byte spans starts..ends."""
    high = _powers(pow(_INVERSE, 1 << _LOW, 1 << 64), (len(prefix) >> _LOW) + 1)
    out = prefix[ends]
    out -= prefix[starts]
    out *= _LOW_INVERSE[starts & ((1 << _LOW) - 1)]
    out *= high[starts >> _LOW]
    return out


def words(data: np.ndarray, offs: np.ndarray, alphabet: np.ndarray):
    """Words (maximal runs of ``alphabet`` bytes; ``data`` already lower-cased)
    of concatenated documents: (starts, ends, first word of each document + end)."""
    n = len(data)
    is_word = np.zeros(n + 1, bool)
    is_word[:n] = alphabet[data]
    before = np.zeros(n + 1, bool)
    before[1:] = is_word[:-1]
    before[offs] = False  # a document starts here: no word runs across
    starts = np.flatnonzero(is_word & ~before)
    after = np.zeros(n, bool)
    after[:n] = is_word[1:]
    ends_at = offs[1:] - 1
    after[ends_at[ends_at >= 0]] = False
    ends = np.flatnonzero(is_word[:n] & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


#: Codes of (place in the word, byte) for the first places of a word.
_PLACES = 64
_PLACE_CODE = mix64(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _STEP)


def word_hashes(data: np.ndarray, offs: np.ndarray, alphabet: np.ndarray,
                lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the word offsets of the documents.

    A word's hash sums a code of its own for every (place, byte): there is no
    polynomial in a power of two, for which whole families of words collide."""
    b = lower_ascii(data) if lower else data
    starts, ends, wofs = words(b, offs, alphabet)
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    cum = np.concatenate(([0], np.cumsum(size)))
    lo = 0
    while lo < len(starts):  # words of about a block of bytes at a time
        hi = max(lo + 1, int(np.searchsorted(cum, cum[lo] + _BLOCK, "right")) - 1)
        n = size[lo:hi]
        code = b[ranges(starts[lo:hi], n)] + (ranges(np.zeros(hi - lo, np.int64), n) << 8)
        far = code >= len(_PLACE_CODE)
        x = _PLACE_CODE[np.where(far, 0, code)]
        if far.any():
            x[far] = mix64((code[far].astype(np.uint64) + np.uint64(1)) * _STEP)
        out[lo:hi] = np.add.reduceat(x, cum[lo:hi] - cum[lo])
        lo = hi
    return mix64(out + size.astype(np.uint64)), wofs


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of starts[i] .. starts[i] + lengths[i] - 1."""
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    if not total:
        return out
    keep = lengths > 0
    s, n = starts[keep].astype(np.int64), lengths[keep].astype(np.int64)
    out[0] = s[0]
    out[np.cumsum(n)[:-1]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(out)


# --- connected components ---------------------------------------------------

def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that is not the smallest of its component.

    Each round hooks a node to its smallest smaller neighbour, shortens the
    chains by pointer jumping, and contracts the edges to the new roots; a
    component loses at least one root a round, usually most. Groupings are
    partial aggregates and joins have plain scans below their exchanges, so a
    hub with a third of all edges is split by adaptive execution. Nothing but
    emptiness flags reaches the driver.
    """
    e = materialize(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                    .filter("hi <> lo").distinct(), "cc-edges")
    roots = None
    while not e.isEmpty():
        hook = materialize(e.groupBy("hi").agg(F.min("lo").alias("up")), "cc-hook")
        while True:
            far = hook.select(F.col("hi").alias("up"), F.col("up").alias("far"))
            jumped = hook.join(far, "up", "left").select(
                "hi", F.coalesce("far", "up").alias("up"), F.col("far").isNotNull().alias("moved"))
            jumped = materialize(jumped, "cc-jump")
            hook = jumped.select("hi", "up")
            if jumped.filter("moved").isEmpty():
                break
        step = hook.select(F.col("hi").alias("node"), F.col("up").alias("root"))
        if roots is None:
            roots = step
        else:
            nxt = hook.select(F.col("hi").alias("root"), F.col("up").alias("to"))
            moved = roots.join(nxt, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root"))
            roots = materialize(moved.unionByName(step), "cc-roots")
        m1 = hook.select("hi", F.col("up").alias("x"))
        m2 = hook.select(F.col("hi").alias("lo"), F.col("up").alias("y"))
        e = e.join(m1, "hi").join(m2, "lo", "left").select(
            "x", F.coalesce("y", "lo").alias("y")).filter("x <> y")
        e = materialize(e.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo"))
                        .distinct(), "cc-edges")
    if roots is None:
        roots = e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots
