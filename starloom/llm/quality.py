"""Document quality by hierarchical empirical Bayes.

Document evidence: a logistic regression on the words and shape classes that
tell labelled documents apart (most significant by the G statistic). Site evidence: labelled outcomes per
host and per path of a host; a host's rate is shrunk toward the global rate and
a path's toward its host's, by a beta prior whose strength is estimated from
the spread of the rates (method of moments). Posterior log-odds = the
document evidence + shift of the site's rate against the global one.

Two targets, quality and toxic. A document is rejected when it is probably of
low quality or probably toxic.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (WORD_CHARS, bound_batches, lower_ascii, materialize, mix64, numbered, text_chunks,
                     without_rows, word_hashes)

TARGETS = ("quality", "toxic")
_ALNUM = WORD_CHARS.copy()
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@dataclass(frozen=True)
class QualityModel:
    """Sorted feature hashes; per target their weights (the last one: intercept)
    and the rate among the labelled rows; the targets of which these show both values."""

    hashes: np.ndarray
    weights: dict
    base: dict
    judged: list[str]


def _share_bins(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Class of part / whole on a scale that is fine near zero."""
    x = part / np.maximum(whole, 1)
    return np.digitize(x, [0.001, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5, 0.7, 0.85])


def _per_doc(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(mask)))
    return c[offs[1:]] - c[offs[:-1]]


def shapes(data: np.ndarray, offs: np.ndarray, h: np.ndarray, wofs: np.ndarray) -> np.ndarray:
    """(documents, kinds) hashes of each document's shape classes."""
    size, n = np.diff(offs), np.diff(wofs)
    space = _SPACE[data]
    symbol = ~_ALNUM[lower_ascii(data)] & ~space
    pair = np.zeros(len(data), bool)
    pair[1:] = symbol[1:] & symbol[:-1]
    pair[offs[:-1][size > 0]] = False  # a document's first byte or word has none before it
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    same[wofs[:-1][n > 0]] = False
    kinds = np.fromiter((len(np.unique(h[a:b], sorted=False)) for a, b in zip(wofs[:-1], wofs[1:], strict=True)),
                        np.int64, len(n))
    bins = [
        _share_bins(_per_doc(symbol, offs), size),
        _share_bins(_per_doc(pair, offs), size),
        _share_bins(_per_doc((data >= 65) & (data <= 90), offs), size),
        _share_bins(_per_doc((data >= 48) & (data <= 57), offs), size),
        _share_bins(_per_doc(data == 10, offs), size),
        _share_bins(_per_doc(data == 124, offs), size),
        _share_bins(_per_doc(same, wofs), n),
        _share_bins(kinds, n),
        np.minimum(size // np.maximum(n, 1), 20),
        np.minimum(np.log2(np.maximum(n, 1)).astype(np.int64), 12),
    ]
    return np.stack([mix64(b.astype(np.uint64) + np.uint64((k + 1) << 40)) for k, b in enumerate(bins)], axis=1)


def _features(data, offs):
    """Flat (document number, feature hash): words and shapes."""
    h, wofs = word_hashes(data, offs, WORD_CHARS)
    s = shapes(data, offs, h, wofs)
    return (np.concatenate((np.repeat(np.arange(len(offs) - 1), np.diff(wofs)),
                            np.repeat(np.arange(len(s)), s.shape[1]))),
            np.concatenate((h, s.ravel())))


def _distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _count(batches):
    """Per feature and label pair the number of documents that have it."""
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch, "text"):
            doc, h = _distinct(*_features(data, offs))
            label = batch.column(0).slice(lo, hi - lo).to_numpy()[doc]
            order = np.lexsort((label, h))
            h, label = h[order], label[order]
            edge = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (label[1:] != label[:-1]))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[edge].view(np.int64)), pa.array(label[edge]),
                 pa.array(np.diff(np.append(edge, len(h))))], names=["feature", "label", "n"])


def _known(hashes: np.ndarray, data, offs) -> tuple[np.ndarray, np.ndarray]:
    """(document number, feature number) of the model's features, once a document."""
    doc, h = _features(data, offs)
    if not len(hashes):
        return doc[:0], doc[:0]
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    hit = np.flatnonzero(hashes[at] == h)
    return _distinct(doc[hit], at[hit])


def _rows(hashes: np.ndarray):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                doc, f = _known(hashes, data, offs)
                ends = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends), pa.array(f))],
                    names=["label", "features"])
    return run


def _evidence(model: QualityModel):
    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                doc, f = _known(model.hashes, data, offs)
                cols = [c.slice(lo, hi - lo) for c in batch.columns[:-1]]
                for t in TARGETS:
                    w = model.weights[t]
                    cols.append(pa.array(np.bincount(doc, w[f], hi - lo) + w[-1]))
                yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], *TARGETS])
    return run


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def logistic(doc: np.ndarray, feature: np.ndarray, y: np.ndarray, size: int, l2: float) -> np.ndarray:
    """Weights of a ridge logistic regression on binary features (document,
    feature), intercept last: Newton steps solved by conjugate gradients."""
    n = len(y)
    w = np.zeros(size + 1)
    if n == 0 or y.min() == y.max():
        w[-1] = _logit((y.sum() + 1) / (n + 2))
        return w
    ridge = np.full(size + 1, l2 * n)
    ridge[-1] = 1e-6

    def times(v):
        return np.bincount(doc, v[feature], n) + v[-1]

    def back(u):
        return np.append(np.bincount(feature, u[doc], size), u.sum())

    def loss(v):
        z = times(v)
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * ridge @ (v * v))

    now = loss(w)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(times(w), -35, 35)))
        grad = back(p - y) + ridge * w
        s = p * (1 - p)
        step, r = np.zeros_like(w), -grad
        d, rr = r.copy(), float(r @ r)
        if rr == 0:
            break
        for _ in range(60):
            hd = back(s * times(d)) + ridge * d
            a = rr / max(float(d @ hd), 1e-30)
            step, r = step + a * d, r - a * hd
            new = float(r @ r)
            if new < 1e-6 * float(grad @ grad):
                break
            d, rr = r + new / rr * d, new
        size_of = 1.0
        while loss(w + size_of * step) > now and size_of > 1e-4:
            size_of /= 2
        w = w + size_of * step
        was, now = now, loss(w)
        if was - now < 1e-6 * was:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_labels: int,
        min_g: float, l2: float) -> QualityModel:
    """Fit document evidence on at most ``max_labels`` labelled rows (those with
    the smallest hash of their id; the bound makes them safe to broadcast and
    their feature numbers safe to gather on the driver). All words whose G statistic
    is over ``min_g`` take part."""
    known = labels.filter(" and ".join(f"{t} in (0, 1)" for t in TARGETS)).filter(F.col(id_col).isNotNull())
    sample = (known.groupBy(F.col(id_col).cast("long").alias("doc"))
              .agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
              .orderBy(F.xxhash64("doc"), "doc").limit(max_labels))
    sample = materialize(sample.select("doc", (F.col("q") + 2 * F.col("t")).cast("long").alias("label")), "labelled")
    src = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    mine = materialize(src.join(F.broadcast(sample), "doc").select("label", "text"), "labelled-texts")
    counts = (mine.mapInArrow(_count, "feature long, label long, n long").groupBy("feature")
              .agg(*(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4))))
    counts = materialize(counts, "features")
    size = {r["label"]: r["n"] for r in mine.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen, base, judged = [], {}, []
    for bit, t in enumerate(TARGETS):
        yes = [k for k in range(4) if k >> bit & 1]
        n1 = sum(size.get(k, 0) for k in yes)
        n0 = sum(size.values()) - n1
        base[t] = (n1 + 1) / (n1 + n0 + 2)
        judged += [t] if n1 and n0 else []
        a = sum(F.col(f"n{k}") for k in yes).cast("double")
        b = sum(F.col(f"n{k}") for k in range(4) if k not in yes).cast("double")
        p1, p0 = (a + 0.5) / (n1 + 1.0), (b + 0.5) / (n0 + 1.0)
        share = (a + b + 1.0) / (n1 + n0 + 2.0)
        g = 2 * (a * F.log(p1 / share) + b * F.log(p0 / share))
        chosen.append(counts.filter(g > min_g).select("feature").toArrow().column(0).to_numpy())
    hashes = np.unique(np.concatenate(chosen).view(np.uint64))
    rows = mine.mapInArrow(_rows(hashes), "label long, features array<long>").toArrow()
    features = rows.column("features").combine_chunks()
    n_of = np.diff(features.offsets.to_numpy()) if len(features) else np.zeros(0, np.int64)
    doc, f = np.repeat(np.arange(len(n_of)), n_of), features.flatten().to_numpy()
    label = rows.column("label").to_numpy()
    weights = {t: logistic(doc, f, (label >> bit & 1).astype(float), len(hashes), l2)
               for bit, t in enumerate(TARGETS)}
    return QualityModel(hashes, weights, base, judged)


def site_rates(sites: DataFrame, target: str) -> DataFrame:
    """(host, path, rate, global): rates of labelled rows (host, path, target),
    a path's shrunk toward its host's, a host's toward the global one."""
    paths = materialize(sites.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.sum(target).cast("double").alias("s")), "site-counts")
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")), "host-counts")
    total = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    mean = ((total["s"] or 0.0) + 1.0) / ((total["n"] or 0) + 2.0)
    k_host = _strength(hosts, F.col("hs"), F.col("hn"), F.lit(mean), mean)
    hosts = hosts.select(F.col("host").alias("host2"), ((F.col("hs") + k_host * mean) / (F.col("hn") + k_host)).alias("host_rate"))
    both = paths.join(hosts, F.col("host").eqNullSafe(F.col("host2"))).drop("host2")
    k_path = _strength(both, F.col("s"), F.col("n"), F.col("host_rate"), mean)
    return both.select("host", "path", "host_rate",
                       ((F.col("s") + k_path * F.col("host_rate")) / (F.col("n") + k_path)).alias("rate"),
                       F.lit(mean).alias("global"))


def _strength(df: DataFrame, s, n, centre, mean: float) -> float:
    """Beta prior strength by moments: how far the groups' rates spread beyond
    what chance explains. No spread: shrink fully (strength 1e6)."""
    var = mean * (1 - mean)
    r = df.select(s.alias("s"), n.cast("double").alias("n"), centre.alias("c")).agg(
        F.sum(F.pow(F.col("s") / F.col("n") - F.col("c"), 2) * F.col("n")).alias("q"),
        F.count("*").alias("m"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not r["m"] or r["m"] < 2 or var <= 0:
        return 1e6
    between = (r["q"] - (r["m"] - 1) * var) / max(r["n"] - r["nn"] / r["n"], 1.0)
    return min(1e6, max(1.0, var / between - 1)) if between > 0 else 1e6


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source", path_col: str = "lang", max_labels: int = 20_000,
             min_g: float = 12.0, l2: float = 1e-5, threshold: float = 0.5) -> DataFrame:
    """One row per document: ``id_col, quality, toxic`` (posterior probabilities),
    ``site_quality, site_toxic`` (the site's shrunk rates) and ``kept``.

    Labels other than 0 and 1, or without an id, teach nothing; an id labelled
    several times takes the larger labels. Null text counts as empty. Null hosts
    and paths are sites of their own; a path without labels takes its host's
    rate, an unseen host the global rate. ``kept`` follows the posteriors (quality at
    least, toxic under ``threshold``) however few labels there are; a target whose
    labelled documents are all alike, or none, tells nothing apart and rejects
    nothing. All words whose counts
    in the bounded sample tell a target apart significantly (G over ``min_g``) take part. Other columns, whatever their
    names, are not looked at.
    """
    return _judged(docs, labels, F.lit(0).cast("long"), id_col, text_col, host_col, path_col, max_labels,
                   min_g, l2, threshold).drop("row")


def _judged(docs: DataFrame, labels: DataFrame, row: Column, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source", path_col: str = "lang", max_labels: int = 20_000,
            min_g: float = 12.0, l2: float = 1e-5, threshold: float = 0.5) -> DataFrame:
    """``classify``, with ``row`` of each document."""
    model = fit(bound_batches(docs), labels, id_col, text_col, max_labels, min_g, l2)
    site = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("doc"), F.col(host_col).cast("string").alias("host"),
                       F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text"))
    schema = "row long, doc long, host string, path string, " + ", ".join(f"{t} double" for t in TARGETS)
    out = materialize(site.mapInArrow(_evidence(model), schema), "evidence")
    outcomes = materialize(
        out.select("doc", "host", "path").join(
            labels.filter(" and ".join(f"{t} in (0, 1)" for t in TARGETS)).groupBy(
                F.col(id_col).cast("long").alias("doc")).agg(*(F.max(t).alias(t) for t in TARGETS)), "doc")
        .select("host", "path", *TARGETS), "outcomes")
    for t in TARGETS:
        rates = materialize(site_rates(outcomes, t), "rates").withColumnsRenamed({"host": "h", "path": "p"})
        hosts = materialize(rates.groupBy(F.col("h").alias("hh")).agg(F.first("host_rate").alias("of_host")),
                            "host-rates")
        out = (out.join(rates.select("h", "p", "rate"),
                        F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left")
               .join(hosts, F.col("host").eqNullSafe(F.col("hh")), "left"))
        base = model.base[t]
        rate = F.coalesce("rate", "of_host", F.lit(base))
        shift = F.log(rate / (1 - rate)) - F.lit(_logit(base))
        odds = F.col(t) + shift
        out = out.withColumns({t: 1 / (1 + F.exp(-odds)), f"site_{t}": rate}).drop("h", "p", "hh", "rate", "of_host")
    passes = {"quality": F.col("quality") >= threshold, "toxic": F.col("toxic") < threshold}
    kept = F.lit(True)
    for t in model.judged:
        kept = kept & passes[t]
    return out.select("row", F.col("doc").alias(id_col), *TARGETS, "site_quality", "site_toxic",
                      kept.alias("kept"))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs``, all columns as they were, without the rejected documents.
    Repeated and null ids are judged row by row; a null id has no label."""
    rows = numbered(docs, "quality-rows")
    verdict = _judged(rows, labels, F.col("__row"), id_col, **options)
    return without_rows(rows, verdict.filter("not kept").select(F.col("row").alias("__row")), "rejected")
