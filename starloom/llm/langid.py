"""Language identification by Bayesian evidence fusion.

Per language: the likelihood of the text (hashed byte trigrams, counted over all
labelled texts), of the declared markup language, of the address suffix, and a
prior of the site. Site priors are smoothed along global -> domain -> host, each
level counting as ``strength`` documents of its parent. Counts of declared
languages, suffixes and sites are grouped sums of the text posteriors over all
rows, and a row's own posterior is taken out of the counts that it meets.

Any number of languages: texts are scored in blocks of languages, one pass for
each, and a row's blocks are put together by grouped sums. With more than one
block a row is one row per block until then.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, lower_ascii, materialize, numbered, text_chunks

#: Hash buckets of trigrams; with a block's languages they bound a model's size.
BUCKETS = 1 << 14


def _trigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every byte trigram inside one document; every other
    ASCII character than letters counts as a space."""
    b = lower_ascii(data).astype(np.uint32)
    b[(b < 97) | ((b > 122) & (b < 128))] = 32
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:] if len(b) > 2 else b[:0]
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    inside = doc[:-2] == doc[2:] if len(b) > 2 else np.zeros(0, bool)
    keep = inside & (code != 0x202020)
    return ((code[keep] * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64), doc[:len(code)][keep]


def _count(languages: list[str]):
    number = {x: i for i, x in enumerate(languages)}

    def run(batches):
        total = np.zeros(len(languages) * BUCKETS, np.int64)
        for batch in batches:
            lang = np.array([number.get(x, -1) for x in batch.column(0).to_pylist()], np.int64)
            for lo, hi, data, offs in text_chunks(batch, "text"):
                bucket, doc = _trigrams(data, offs)
                of = lang[lo:hi][doc]
                total += np.bincount((of * BUCKETS + bucket)[of >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])
    return run


def _likelihood(log_p: np.ndarray, effective: int):
    n_lang = log_p.shape[1]

    def run(batches):
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch, "text"):
                bucket, doc = _trigrams(data, offs)
                n = np.bincount(doc, minlength=hi - lo)
                ll = np.stack([np.bincount(doc, log_p[bucket, k], hi - lo) for k in range(n_lang)], axis=1)
                # Neighbouring trigrams repeat each other: a long text counts as
                # no more than ``effective`` independent ones.
                ll *= np.minimum(1.0, effective / np.maximum(n, 1))[:, None]
                top = ll.max(axis=1)
                post = np.exp(ll - top[:, None])
                mass = post.sum(axis=1)
                post /= mass[:, None]
                flat = np.arange(hi - lo + 1, dtype=np.int32) * n_lang
                cols = [c.slice(lo, hi - lo) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*cols, *(pa.ListArray.from_arrays(pa.array(flat), pa.array(x.ravel())) for x in (ll, post)),
                     pa.array(top), pa.array(mass)],
                    names=[*batch.schema.names[:-1], "__ll", "__post", "__top", "__mass"])
    return run


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """The first ``width`` numbers of each row's list; zeros for a null list."""
    out = np.zeros((len(col), width))
    here = col.is_valid().to_numpy(zero_copy_only=False)
    if here.any():
        out[here] = col.flatten().to_numpy().reshape(here.sum(), -1)[:, :width]
    return out


def _fuse(blocks: list[list[str]], total: list[np.ndarray], kinds: dict, n_keep: int, strength: float,
          smoothing: float):
    """Per row and block: the best score, its language, the sum of all scores
    relative to it, and the same best of the text alone."""
    everyone, n_lang = sum(float(t.sum()) for t in total), sum(map(len, blocks))

    def run(batches):
        for batch in batches:
            of = batch.column("__block").to_numpy()
            for b in np.unique(of).tolist():
                part = batch.filter(pa.array(of == b))
                names, t = np.array(blocks[b], object), total[b]
                ll, post = _matrix(part.column("__ll"), len(names)), _matrix(part.column("__post"), len(names))

                def others(key):
                    """Is there a value; counts at it without the row itself; rows of it without this one."""
                    s = _matrix(part.column(f"{key}_s"), len(names))  # noqa: B023
                    n = part.column(f"{key}_n").fill_null(1).to_numpy()  # noqa: B023
                    has = part.column(key).is_valid().to_numpy(zero_copy_only=False)  # noqa: B023
                    return has[:, None], np.maximum(s - post, 0.0), (n - 1.0)[:, None]  # noqa: B023

                prior = np.broadcast_to((t + 1.0) / (everyone + n_lang), ll.shape)
                for key in ("__domain", "__host"):
                    has, o, n = others(key)
                    prior = np.where(has, (o + strength * prior) / (n + strength), prior)
                score = ll + np.log(prior)
                for key, values in kinds.items():
                    has, o, _ = others(key)
                    score += np.where(has, np.log((o + smoothing) / (t + smoothing * values)), 0.0)
                best, text = score.argmax(axis=1), ll.argmax(axis=1)
                top = score.max(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_keep], part.column("__row"), part.column("__block"),
                     pa.array(top), pa.array(names[best], pa.string()),
                     pa.array(np.exp(score - top[:, None]).sum(axis=1)),
                     pa.array(ll.max(axis=1)), pa.array(names[text], pa.string())],
                    names=[*part.schema.names[:n_keep], "__row", "__block", *_FUSED])
    return run


_FUSED = ("__best", "__lang", "__norm", "__text_best", "__text_lang")


def label_names(labelled: DataFrame, lang_col: str) -> list[str]:
    """All labelled languages, sorted."""
    return sorted(r[0] for r in labelled.select(lang_col).filter(F.col(lang_col).isNotNull()).distinct().collect())


def train(labelled: DataFrame, text_col: str, lang_col: str, languages: list[str]) -> np.ndarray:
    """Log probabilities of trigram buckets in each of a block of languages, from
    all their labelled texts."""
    counts = np.zeros((len(languages), BUCKETS))
    rows = (labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .filter(F.col("lang").isin(languages))
            .mapInArrow(_count(languages), "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))).toArrow()
    counts.ravel()[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    p = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    return np.log(p).T.copy()


def page_text(html):
    """Column: the visible text of a web page."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&[a-zA-Z#0-9]+;", " ")


def declared_language(html):
    """Column: the primary subtag of the html element's lang attribute, or null."""
    tag = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]+)", 1)
    return F.nullif(F.lower(tag), F.lit(""))


def url_host(url):
    """Column: the host of an address without www. and m., or null."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^(www|m)\.", ""), F.lit(""))


def identify(rows: DataFrame, labelled: DataFrame, text_col: str = "text", markup_col: str = "markup",
             host_col: str = "host", train_text_col: str = "text", train_lang_col: str = "lang",
             block_languages: int = 64, effective: int = 60, strength: float = 5.0,
             smoothing: float = 0.5) -> DataFrame:
    """``rows`` with all columns but ``text_col`` and ``markup_col`` (and but those
    named like the three that follow, which are replaced), plus ``lang_id`` (most probable language), ``confidence`` (its posterior) and
    ``text_lang`` (by the text alone). Evidence columns are null where absent.

    Null or short texts have no text evidence: the other evidence decides, and
    without any the commonest language. Ties take the alphabetically first
    language. Rows that repeat are judged one by one. Without labelled texts
    the language is null and the confidence zero. ``block_languages`` bounds the
    languages of one pass, not those known.
    """
    made = {c.lower() for c in (text_col, markup_col, "lang_id", "confidence", "text_lang")}
    names_kept = [c for c in rows.columns if c.lower() not in made]
    keep = [f"__kept{i}" for i in range(len(names_kept))]  # no name of ours meets one of theirs
    bound_batches(rows)
    languages = label_names(labelled, train_lang_col)
    if not languages:
        return rows.select(*(F.col(f"`{c}`") for c in names_kept), F.lit(None).cast("string").alias("lang_id"), F.lit(0.0).alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"))
    host = F.col(host_col)
    src = rows.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(names_kept, keep, strict=True)),
                      F.col(markup_col).alias("__markup"), host.alias("__host"),
                      F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit("")).alias("__suffix"),
                      F.coalesce(F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)
                      .alias("__domain"), F.col(text_col).alias("text"))
    blocks = [languages[i:i + block_languages] for i in range(0, len(languages), block_languages)]
    src = (numbered(src, "lang-rows") if len(blocks) > 1 else src.withColumn("__row", F.lit(0).cast("long")))
    src = src.select(*keep, "__row", "__markup", "__host", "__suffix", "__domain", "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.drop("text").schema)
    out = None
    for b, names in enumerate(blocks):
        scored = src.mapInArrow(
            _likelihood(train(labelled, train_text_col, train_lang_col, names), effective),
            schema + ", __ll array<double>, __post array<double>, __top double, __mass double")
        part = materialize(scored.withColumn("__block", F.lit(b)), "lang-text")
        out = part if out is None else out.unionByName(part)
    if len(blocks) > 1:  # a block's posteriors are of its own languages: scale them by its share
        lists = out.groupBy(F.col("__row").alias("__of")).agg(F.collect_list(F.struct("__top", "__mass")).alias("of"))
        z = lists.withColumn("m", F.array_max(F.transform("of", lambda x: x["__top"]))).select(
            "__of", "m", F.aggregate("of", F.lit(0.0), lambda a, x: a + x["__mass"] * F.exp(x["__top"] - F.col("m")))
            .alias("z"))
        out = out.join(materialize(z, "lang-shares"), F.col("__row") == F.col("__of")).withColumn(
            "share", F.col("__mass") * F.exp(F.col("__top") - F.col("m")) / F.col("z"))
        out = materialize(out.withColumn("__post", F.transform("__post", lambda x: x * F.col("share")))
                          .drop("__of", "m", "z", "share"), "lang-posts")
    out = out.drop("__top", "__mass")
    width = range(len(blocks[0]))
    summed = [F.coalesce(F.sum(F.get("__post", F.lit(i))), F.lit(0.0)).alias(f"s{i}") for i in width]

    def sums(key: str) -> DataFrame:
        """Summed posteriors of each value of a column and block, as an array, and its rows."""
        s = out.filter(F.col(key).isNotNull()).groupBy(
            F.col(key).alias(f"{key}_k"), F.col("__block").alias(f"{key}_b")).agg(
            F.count("*").alias(f"{key}_n"), *summed)
        return materialize(s.select(f"{key}_k", f"{key}_b", f"{key}_n", F.array(*(f"s{i}" for i in width))
                                    .alias(f"{key}_s")), "lang-counts")

    total = [np.zeros(len(names)) for names in blocks]
    for r in out.groupBy("__block").agg(*summed).collect():
        total[r["__block"]][:] = [r[f"s{i}"] for i in range(len(blocks[r["__block"]]))]
    met, kinds = out, {}
    for key in ("__markup", "__suffix", "__domain", "__host"):
        of = sums(key)
        if key in ("__markup", "__suffix"):
            kinds[key] = of.filter(F.col(f"{key}_b") == 0).count() + 1
        met = met.join(of, (F.col(key) == F.col(f"{key}_k")) & (F.col("__block") == F.col(f"{key}_b")),
                       "left").drop(f"{key}_k", f"{key}_b")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.select(*keep, "__row", "__block").schema)
    # The columns that are kept come first and in order.
    met = met.select(*keep, *(c for c in met.columns if c not in keep))
    found = met.mapInArrow(
        _fuse(blocks, total, kinds, len(keep), strength, smoothing),
        types + ", __best double, __lang string, __norm double, __text_best double, __text_lang string")
    if len(blocks) > 1:
        first = -F.col("__block")
        found = found.groupBy("__row").agg(
            *(F.any_value(c).alias(c) for c in keep), F.max("__best").alias("m"),
            F.collect_list(F.struct("__best", "__norm")).alias("of"),
            F.max_by("__lang", F.struct("__best", first)).alias("__lang"),
            F.max_by("__text_lang", F.struct("__text_best", first)).alias("__text_lang")).withColumn(
            "__norm", F.aggregate("of", F.lit(0.0), lambda a, x: a + x["__norm"] * F.exp(x["__best"] - F.col("m"))))
    return found.select(*(F.col(k).alias(c) for c, k in zip(names_kept, keep, strict=True)), F.col("__lang").alias("lang_id"), (1 / F.col("__norm")).alias("confidence"),
                        F.col("__text_lang").alias("text_lang"))
