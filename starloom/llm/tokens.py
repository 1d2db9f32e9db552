"""Token ids of whole texts, and flat binary token files.

``TokenEncoder`` gives exactly the ids of the tokenizers library, but encodes
each distinct space-separated word once per worker process: both byte-level and
word-end BPE split text at a single space between two visible characters, so a
document's ids are the concatenation of its words' ids. A chunk's words are told
apart by Arrow, only distinct ones are looked up, by their bytes, and the ids are
gathered in numpy. Texts where that does not hold (doubled spaces, spaces next to
other white space, very long words) go through the library whole.

``write_token_files`` lays the ids of all documents out in ascending id order
as flat unsigned integer files, one per partition, each with 64-bit document
offsets; a prefix sum over the partitions' sizes gives every file its base.
``read_token_files`` maps the files into memory and returns the documents.
"""

from __future__ import annotations

import os
import uuid
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORKER_CACHES, bound_batches, materialize, ranges, scratch_path, text_chunks

#: Words kept by a worker's cache; beyond it, words used once make room.
CACHE_WORDS = 400_000
#: Longer words are not cached: their text goes through the library whole.
LONGEST_WORD = 200
#: Bytes of text that are encoded at a time (or one document).
TOKEN_BYTES = 4 << 20
#: Number of the line break in every store.
LINE_BREAK = 0
#: Stands for a null id in the files, before all other ids.
NULL_ID = -(1 << 63)

_ENCODERS: dict[str, "TokenEncoder"] = {}
WORKER_CACHES.append(_ENCODERS)


def _room(x: np.ndarray, need: int) -> np.ndarray:
    """``x``, or a copy of at least twice its length that holds ``need`` values."""
    if need <= len(x):
        return x
    out = np.zeros(max(need, 2 * len(x), 1024), x.dtype)
    out[:len(x)] = x
    return out


class _Store:
    """Ids of numbered words, in one array; unseen words wait in ``plain`` (letters after
    a space) or ``new`` (any others), to be encoded, or in ``joined`` (made of other words, by
    how deep they nest)."""

    def __init__(self):
        self.start, self.size, self.uses = np.zeros((3, 1024), np.int64)
        self.ids, self.used = np.zeros(1024, np.uint32), 0
        self.depth: list[int] = []  # of every word; 0: encoded by the library
        self.plain: list[str] = []
        self.plain_at: list[int] = []
        self.new: list[str] = []
        self.new_at: list[int] = []
        self.joined: dict[int, list[tuple[int, list[int]]]] = {}

    def add(self, text: str) -> int:
        n = len(self.depth)
        self.depth.append(0)
        self.new_at.append(n)
        self.new.append(text)
        return n

    def join(self, parts: list[int]) -> int:
        n, depth = len(self.depth), 1 + max(map(self.depth.__getitem__, parts))
        self.depth.append(depth)
        self.joined.setdefault(depth, []).append((n, parts))
        return n

    def _put(self, at: list[int], size: np.ndarray, ids: np.ndarray) -> None:
        self.start[at] = self.used + np.cumsum(size) - size
        self.size[at] = size
        self.ids = _room(self.ids, self.used + len(ids))
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _encode(self, tok, at: list[int], texts: list[str]) -> None:
        """Encode each text by itself."""
        out = [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, out), np.int64, len(out))
        self._put(at, size, np.fromiter(chain.from_iterable(out), np.uint32, int(size.sum())))

    def fill(self, tok, edge: np.ndarray, at_end: bool) -> None:
        """Encode the waiting words. ``edge`` tells the ids that end (``at_end``) or begin a word:
        plain words are encoded many to a text and told apart by them."""
        self.start, self.size, self.uses = (_room(x, len(self.depth)) for x in (self.start, self.size, self.uses))
        groups = [slice(i, i + 500) for i in range(0, len(self.plain), 500)]
        texts = ["".join(self.plain[g]) for g in groups]
        for g, e in zip(groups, tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids, n = np.array(e.ids, np.uint32), len(self.plain[g])
            cut = np.flatnonzero(edge[ids])
            if len(cut) != n:  # a word has an edge at least, so each has one if there are as many
                self._encode(tok, self.plain_at[g], self.plain[g])
                continue
            size = np.diff(cut + 1, prepend=0) if at_end else np.diff(cut, append=len(ids))
            self._put(self.plain_at[g], size, ids)
        if self.new:
            self._encode(tok, self.new_at, self.new)
        self.plain, self.plain_at, self.new, self.new_at = [], [], [], []
        for depth in sorted(self.joined):
            rows = self.joined.pop(depth)
            n_parts = np.fromiter((len(p) for _, p in rows), np.int64, len(rows))
            part = np.fromiter((x for _, p in rows for x in p), np.int64, int(n_parts.sum()))
            ids = self.ids[ranges(self.start[part], self.size[part])]
            self._put([n for n, _ in rows], np.add.reduceat(self.size[part], np.cumsum(n_parts) - n_parts), ids)

    def keep(self, mask: np.ndarray) -> None:
        mask = np.flatnonzero(mask)
        self.ids = self.ids[ranges(self.start[mask], self.size[mask])]
        self.size, self.uses, self.used = self.size[mask], np.zeros(len(mask), np.int64), len(self.ids)
        self.start = np.cumsum(self.size) - self.size
        self.depth = [0] * len(self.size)


# Classes of bytes that decide on cuts: ASCII letters, visible ASCII characters, comma and full stop.
_LETTER, _VISIBLE, _STOP = np.zeros((3, 256), bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_VISIBLE[0x21:0x7F] = True
_STOP[[44, 46]] = True


def _cuts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where words begin: at a text's start and at spaces, and, as far as ASCII neighbours show
    it, around a line break between visible characters and before a comma or full stop
    between a letter and the word's end. (``_new_word`` finds the cuts beside other letters.)"""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[offs] = True
    edge = begins.copy()  # no cut looks over a text's edge
    begins[:n] |= data == 32
    line = np.zeros(n + 2, bool)
    line[1:n - 1] = (data[1:-1] == 10) & _VISIBLE[data[:-2]] & _VISIBLE[data[2:]] & ~edge[1:n - 1] & ~edge[2:n]
    begins |= line[:-1]
    begins[1:] |= line[:n]
    stop = np.zeros(n + 1, bool)
    stop[1:n] = _STOP[data[1:]] & _LETTER[data[:-1]] & ~edge[1:n] & begins[2:n + 1]
    return (begins | stop)[:n]


class TokenEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per Spark task
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.vocab_size = self.tok.get_vocab_size()
        # Vocabularies with word ends mark each word's last token, byte-level ones a space's first.
        suffix = self.tok.model.end_of_word_suffix
        self.at_end = bool(suffix)
        self.edge = np.zeros(self.vocab_size, bool)
        self.edge[[n for t, n in self.tok.get_vocab().items() if (t.endswith(suffix) if suffix else t.startswith("\u0120"))]] = True
        self.store = _Store()
        self.store.add("\n")  # takes the number LINE_BREAK
        # A word with the space before it, if there is one -> its number.
        self.known: dict[bytes, int] = {b"\n": LINE_BREAK}
        self.ends_in_letter: dict[str, bool] = {}

    @staticmethod
    def of(path: str) -> "TokenEncoder":
        """The worker process's encoder for this vocabulary file."""
        if path not in _ENCODERS:
            _ENCODERS[path] = TokenEncoder(path)
        return _ENCODERS[path]

    def _make_room(self) -> None:
        """Forget the words used once; if most were used more, the lesser half."""
        uses = self.store.uses[:len(self.store.depth)]
        keep = uses > max(1, int(np.partition(uses, -CACHE_WORDS // 2)[-CACHE_WORDS // 2]))
        keep[LINE_BREAK] = True
        self.store.keep(keep)
        number = np.cumsum(keep) - 1
        self.known = {w: int(number[n]) for w, n in self.known.items() if n >= 0 and keep[n]}

    def _letter_at_end(self, char: str) -> bool:
        """Is ``char``, and what the vocabulary's normalizer makes of it, a letter at its end? (Some
        letters become a letter and a mark.)"""
        found = self.ends_in_letter.get(char)
        if found is None:
            plain = char if self.tok.normalizer is None else self.tok.normalizer.normalize_str(char)
            found = self.ends_in_letter[char] = char.isalpha() and plain[-1:].isalpha()
        return found

    def _number(self, unit: str) -> int:
        """The number of a word (with its leading space); -1 if its text must be encoded whole."""
        key = unit.encode()
        n = self.known.get(key)
        return self._new_word(unit, key) if n is None else n

    def _new_word(self, unit: str, key: bytes) -> int:
        """Number a word that isn't known.

        Both kinds of vocabulary split text before and after a line break between
        visible characters, and between a letter and a comma or full stop that ends the
        word: such words are joined from their parts."""
        store = self.store
        if len(unit) <= LONGEST_WORD and unit[0] == " " and unit[1:].isalpha():
            self.known[key] = n = len(store.depth)
            store.depth.append(0)
            store.plain.append(unit)
            store.plain_at.append(n)
            return n
        lead = unit[:1] if unit[:1] == " " else ""
        word, parts = unit[len(lead):], None
        if not word or len(word) > LONGEST_WORD or word[0].isspace() or word[-1].isspace() or "<|" in word:
            return -1
        if "\n" in word:
            first, *lines = word.split("\n")
            if not any(x == "" or x[0].isspace() or x[-1].isspace() for x in (first, *lines)):
                parts = [self._number(lead + first)]
                for x in lines:
                    parts += [LINE_BREAK, self._number(x)]
        elif word[-1] in ".," and len(word) > 1 and self._letter_at_end(word[-2]):
            parts = [self._number(lead + word[:-1]), self._number(word[-1])]
        self.known[key] = n = store.join(parts) if parts else store.add(unit)
        return n

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each) of concatenated UTF-8 texts."""
        n_texts, raw = len(offs) - 1, data.tobytes()
        store = self.store
        if len(store.depth) > CACHE_WORDS:
            self._make_room()
        starts = np.flatnonzero(_cuts(data, offs))
        units = pa.Array.from_buffers(pa.binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(raw)]).dictionary_encode()
        codes, distinct = units.indices.to_numpy(), units.dictionary.to_pylist()
        number = np.fromiter(map(self.known.get, distinct, repeat(-2)), np.int64, len(distinct))
        for k in np.flatnonzero(number == -2).tolist():
            number[k] = self._new_word(distinct[k].decode(), distinct[k])
        store.fill(self.tok, self.edge, self.at_end)
        np.add.at(store.uses, number[number >= 0], np.bincount(codes, minlength=len(distinct))[number >= 0])
        word = number[codes]
        first = np.searchsorted(starts, offs)  # each text's first word
        bad = np.concatenate(([0], np.cumsum(word < 0)))[first]
        odd = bad[1:] > bad[:-1]
        word = word[~np.repeat(odd, np.diff(first))]
        size = store.size[word]
        flat = store.ids[ranges(store.start[word], size)]
        n_words = np.where(odd, 0, np.diff(first))
        cum = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(n_words)))]
        if not odd.any():
            return flat, np.diff(cum)
        whole = iter(self._whole([raw[offs[i]:offs[i + 1]].decode() for i in np.flatnonzero(odd)]))
        out = [next(whole) if odd[i] else flat[cum[i]:cum[i + 1]] for i in range(n_texts)]
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, n_texts)


def encode_chunks(batch: pa.RecordBatch, enc: TokenEncoder, end_id: int):
    """Encode a batch with columns (doc, text) a few megabytes at a time: yields
    (doc column, ids with ``end_id`` after each document, document offsets)."""
    for lo, hi, data, offs in text_chunks(batch, "text", TOKEN_BYTES, _ENCODERS):
        ids, n = enc.encode(data, offs)
        out_offs = np.concatenate(([0], np.cumsum(n + 1)))
        out = np.full(int(out_offs[-1]), end_id, np.uint32)
        is_end = np.zeros(len(out), bool)
        is_end[out_offs[1:] - 1] = True
        out[~is_end] = ids
        yield batch.column(0).slice(lo, hi - lo), out, out_offs


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write(path: str, folder: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        enc = TokenEncoder.of(path)
        kind = np.dtype("<u2") if max(enc.vocab_size, end_id + 1) <= 1 << 16 else np.dtype("<u4")
        part = TaskContext.get().partitionId()
        # A retried or speculative attempt writes files of its own; the index
        # names only those of the attempt that Spark took.
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        store, base = _open(name)
        files, n_docs, n_ids = [], 0, 0
        for batch in batches:
            if not files:
                files = [store.open_output_stream(f"{base}.{x}") for x in ("ids", "off", "doc")]
            for docs, ids, offs in encode_chunks(batch, enc, end_id):
                files[0].write(ids.astype(kind).tobytes())
                files[1].write((offs[1:] + n_ids).astype("<i8").tobytes())
                files[2].write(docs.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs, n_ids = n_docs + len(docs), n_ids + len(ids)
        for f in files:
            f.close()
        if files:
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "id_bytes": kind.itemsize,
                                               "n_docs": n_docs, "n_ids": n_ids}])
    return run


_INDEX = "part long, file string, id_bytes long, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents' ids and return the index: one row per file with
    ``part, file, id_bytes, n_docs, n_ids, base`` (``base``: ids before the file).

    Null texts count as empty and still get ``end_id``. Null ids come first;
    rows of one id follow the order of their texts. No documents: no files.
    Ids are 16-bit when the vocabulary allows, else 32-bit.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    _make_folder(spark, folder)
    src = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    placed = src.repartitionByRange("doc").sortWithinPartitions("doc", "text")
    index = materialize(placed.mapInArrow(_write(tokenizer, folder, end_id), _INDEX), "token-index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return index.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def _mapped(store, path: str, kind: str) -> np.ndarray:
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _read(with_ids: bool, step: int = 20_000):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, base = _open(row["file"])
                ids = _mapped(store, f"{base}.ids", f"<u{row['id_bytes']}")
                offs = _mapped(store, f"{base}.off", "<i8")
                docs = _mapped(store, f"{base}.doc", "<i8")
                for lo in range(0, row["n_docs"], step):
                    end = np.asarray(offs[lo:lo + step])
                    start = np.concatenate(([offs[lo - 1] if lo else 0], end[:-1]))
                    each = [ids[a:b].astype("<u4") for a, b in zip(start, end, strict=True)]
                    who = np.asarray(docs[lo:lo + step])
                    out = {"doc": pa.array(who, mask=who == NULL_ID), "start": start + row["base"],
                           "n_tokens": end - start, "ids_crc32": [zlib.crc32(x.tobytes()) for x in each]}
                    if with_ids:
                        out["ids"] = pa.array(each, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)
    return run


def read_token_files(index: DataFrame, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """The documents of the files of ``index``: ``id_col, start`` (ids of all
    documents before it), ``n_tokens, ids_crc32`` (of the ids as little-endian
    unsigned 32-bit integers), and ``ids`` on request. One task maps one file."""
    n = max(1, index.count())
    schema = "doc long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    out = index.repartition(n, "part").mapInArrow(_read(with_ids), schema)
    return out.withColumnRenamed("doc", id_col)
