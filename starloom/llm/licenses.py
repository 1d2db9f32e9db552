"""License scan with a generalised suffix automaton.

The automaton accepts every run of consecutive words of the license templates.
A document streams through it word by word; the state and the match length
(matching statistics) say at each word how long a piece of some template ends
there. Pieces that cannot be extended are chained, in text order and template
order, into covered spans of a template; the covered share decides the labels.

Templates are a parameter: pairs (label, text), or a table of them, such as the
whole licence texts that ``read_templates`` takes from files.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD_CHARS, bound_batches, text_chunks, word_hashes

# The phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Excerpts of public license notices, and usual one-line declarations.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "licensed under the apache license version 2.0 the license you may not use this file "
               "except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("bsd", "released under the bsd license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc", "licensed under cc by-nc 4.0"),
    ("cc-by-sa", "licensed under cc by-sa 4.0"),
    ("cc0", "released into the public domain under cc0 1.0 universal"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of "
            "the gnu general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files the software to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2.0"),
]

_WORDS = WORD_CHARS


def _hashes(text: str) -> list[int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]), _WORDS)[0].tolist()


class SuffixAutomaton:
    """Of several word sequences."""

    def __init__(self, sequences: list[list[int]]):
        self.next, self.link, self.size, self.own = [{}], [-1], [0], [[]]
        for t, seq in enumerate(sequences):
            last = 0
            for i, c in enumerate(seq):
                last = self._extend(last, c)
                self.own[last].append((t, i + 1))
        self.below = [[] for _ in self.next]
        for v in range(1, len(self.next)):
            self.below[self.link[v]].append(v)
        self._ends: dict[int, list[tuple[int, int]]] = {}

    def ends(self, state: int) -> list[tuple[int, int]]:
        """(sequence, end) of the state's occurrences, gathered when first asked for:
        whole licence texts share long passages, whose states nobody may visit."""
        if state not in self._ends:
            found, todo = [], [state]
            while todo:
                v = todo.pop()
                found += self.own[v]
                todo += self.below[v]
            self._ends[state] = sorted(found)
        return self._ends[state]

    def _state(self, size, nxt, link):
        self.next.append(nxt)
        self.link.append(link)
        self.size.append(size)
        self.own.append([])
        return len(self.next) - 1

    def _clone(self, p, q, c):
        clone = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last, c):
        if c in self.next[last]:  # another sequence has been here
            q = self.next[last][c]
            return q if self.size[q] == self.size[last] + 1 else self._clone(last, q, c)
        cur = self._state(self.size[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.size[q] == self.size[p] + 1 else self._clone(p, q, c)
        return cur

    def step(self, state: int, length: int, c: int) -> tuple[int, int]:
        """Longest suffix of (current match + c) that is in the automaton."""
        while state and c not in self.next[state]:
            state = self.link[state]
            length = self.size[state]
        if c in self.next[state]:
            return self.next[state][c], length + 1
        return 0, 0

    def holds(self, seq: list[int]) -> set[int]:
        """The states at which ``seq`` has just been read, once length >= len(seq)."""
        v = 0
        for c in seq:
            v = self.next[v][c]
        found, todo = set(), [v]
        while todo:
            v = todo.pop()
            found.add(v)
            todo += self.below[v]
        return found


class Scanner:
    def __init__(self, templates, phrases, min_match: int, max_gap: int, min_cover: float):
        self.min_match, self.max_gap, self.min_cover = min_match, max_gap, min_cover
        texts = [*templates, *((label, p) for p, label in phrases.items())]
        hashed = [_hashes(t) for _, t in texts]
        self.vocab = np.array(sorted({h for s in hashed for h in s}), np.uint64)
        number = {h: i for i, h in enumerate(self.vocab.tolist())}
        seqs = [[number[h] for h in s] for s in hashed]
        self.labels, self.lengths = [x for x, _ in texts], [len(s) for s in seqs]
        self.auto = SuffixAutomaton(seqs)
        self.phrases = defaultdict(list)  # state -> (words, label) that may end there
        for label, seq in [(x, s) for x, s in zip(self.labels, seqs, strict=True)][len(templates):]:
            for v in self.auto.holds(seq):
                self.phrases[v].append((len(seq), label))

    def numbers(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        return np.where(self.vocab[at] == h, at, -1)

    def scan(self, runs: list[tuple[int, list[int]]]):
        """``runs``: (first word, word numbers) of the stretches of template words.
        Returns base places [(word, label)] and pieces [(first, end, state)]."""
        step, places, pieces = self.auto.step, [], []
        for first, seq in runs:
            state = length = 0
            for i, c in enumerate(seq):
                was, had = state, length
                state, length = step(state, length, c)
                if length <= had and had >= self.min_match:
                    pieces.append((first + i - had, first + i, was))
                for n, label in self.phrases.get(state, ()):
                    if length >= n:
                        places.append((first + i + 1 - n, label))
            if length >= self.min_match:
                pieces.append((first + len(seq) - length, first + len(seq), state))
        return places, pieces

    def cover(self, pieces) -> list[tuple[int, int, int, int]]:
        """Chains of pieces: (template, covered words, first, end).

        A piece that ends at some place of a template extends a chain that ends
        before that place and at most ``max_gap`` words before the piece; it adds
        the words that are new in both text and template. Of all chains that end at
        a piece and place the best (most words, then latest start) is kept. Of a
        template, its best chain is returned, and all others over ``min_cover`` that
        overlap none better (more words, then earlier) in the text."""
        seen = defaultdict(list)  # template -> (end, end in the template, covered, first)
        for first, end, state in pieces:
            n, new = end - first, []
            for t, place in self.auto.ends(state):
                best = (n, first)
                for e, q, covered, start in reversed(seen[t]):
                    if first - e > self.max_gap:
                        break
                    if q < place:
                        best = max(best, (covered + min(n, place - q, end - max(first, e)), start))
                new.append((t, (end, place, *best)))
            for t, chain in new:
                seen[t].append(chain)
        out = []
        for t, chains in sorted(seen.items()):
            ranked = sorted((-covered, first, end) for end, _, covered, first in chains)
            taken: list[tuple[int, int]] = []
            for covered, first, end in ranked:
                if taken and -covered < self.min_cover * self.lengths[t]:
                    break
                k = bisect_left(taken, (first, end))
                if (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or end <= taken[k][0]):
                    insort(taken, (first, end))
                    out.append((t, -covered, first, end))
        return out


def _scan(options: tuple, with_spans: bool):
    def run(batches):
        scanner = Scanner(*options)
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                h, wofs = word_hashes(data, offs, _WORDS)
                num = scanner.numbers(h)
                inside = np.zeros(len(num) + 2, bool)
                inside[1:-1] = num >= 0
                new_doc = np.zeros(len(num) + 1, bool)
                new_doc[wofs] = True
                starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | new_doc[:-1]))
                ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | new_doc[1:])) + 1
                long = ends - starts >= 2
                starts, ends = starts[long], ends[long]
                doc = np.searchsorted(wofs, starts, "right") - 1
                runs = defaultdict(list)
                for d, s, e in zip(doc.tolist(), starts.tolist(), ends.tolist(), strict=True):
                    runs[d].append((s - int(wofs[d]), num[s:e].tolist()))
                rows = [_row(scanner, runs.get(d, ()), with_spans) for d in range(hi - lo)]
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPAN]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(wofs)),
                     *(pa.array(c, k) for c, k in zip(cols, kinds[:len(cols)], strict=True))], names=_names(with_spans))
    return run


def _row(scanner: Scanner, runs, with_spans: bool) -> tuple:
    places, pieces = scanner.scan(runs) if runs else ((), ())
    chains = scanner.cover(pieces) if pieces else ()
    base = {label for _, label in places}
    share = [(n / scanner.lengths[t], scanner.labels[t], a, b) for t, n, a, b in chains]
    found = sorted((x for x in share if x[0] >= scanner.min_cover), key=lambda x: (x[2], x[3], x[1], x[0]))
    at = [w for w, _ in places]
    out = (len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
           ",".join(sorted(base | {x[1] for x in found})),
           min(1.0, max([1.0 if at else 0.0, *(x[0] for x in share)])))
    spans = [{"label": label, "first": a, "end": b, "cover": c} for c, label, a, b in found]
    return (*out, spans) if with_spans else out


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()),
                            ("cover", pa.float64())]))


def _names(with_spans: bool) -> list[str]:
    return ["doc", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
            *["spans"] * with_spans]


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """(label, text) of a folder of whole licence texts: the label is the file's
    name in lower case, up to its extension (``.txt``, ``.md`` or ``.html``)."""
    name = F.regexp_replace(F.lower(F.element_at(F.split(F.input_file_name(), "/"), -1)), r"\.(txt|md|html)$", "")
    return spark.read.text(path, wholetext=True).select(name.alias("label"), F.col("value").alias("text"))


def _template_pairs(templates, limit: int) -> tuple:
    """Templates with words as sorted pairs, at most ``limit`` bytes: each task
    builds its automaton from them."""
    if isinstance(templates, DataFrame):
        known = templates.select("label", "text").filter("label is not null and text is not null").distinct()
        size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        if size > limit:
            raise ValueError(f"templates of {size} bytes, more than {limit}: raise max_template_bytes")
        templates = [(r["label"], r["text"]) for r in known.orderBy("label", "text").collect()]
    return tuple((label, text) for label, text in templates if _hashes(text))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates=tuple(TEMPLATES), phrases: dict | None = None, min_match: int = 3,
                  max_gap: int = 6, min_cover: float = 0.75, with_spans: bool = False,
                  max_template_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: ``id_col, n_words, n_base`` (places of the base
    phrases), ``first_word, last_word`` (their smallest and largest start, else
    null), ``base_labels, labels`` (sorted, comma-joined, '' for none) and
    ``score``, the largest covered share of a template (1 with any base place).

    A template counts when chained pieces of at least ``min_match`` words, with
    gaps of at most ``max_gap``, cover ``min_cover`` of it. ``with_spans`` adds
    all covered spans in words, by place: a notice that stands several times has
    several. Null text counts as empty: no words, no labels. Repeated or null ids
    are scanned row by row. Columns of other names aren't looked at.
    Nothing is shuffled.

    ``templates``: pairs (label, text), or a table with these columns; those
    without words or with a null match nothing. The built-in ones are excerpts; whole
    texts come from ``read_templates``. A table of more than ``max_template_bytes``
    raises ValueError.
    """
    options = (_template_pairs(templates, max_template_bytes), BASE_PHRASES if phrases is None else phrases,
               min_match, max_gap, min_cover)
    schema = ("doc long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double"
              + ", spans array<struct<label:string,first:long,end:long,cover:double>>" * with_spans)
    src = bound_batches(docs).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return src.mapInArrow(_scan(options, with_spans), schema).withColumnRenamed("doc", id_col)
