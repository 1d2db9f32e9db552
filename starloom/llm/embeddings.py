"""Embedding near-duplicates by PCA-ordered, tiled comparison.

Unit vectors are rotated so that the leading dimensions hold most of the
variance; a rotation keeps every inner product, so it only decides how early a
pair can be given up. Two vectors whose cosine reaches t differ by at most
sqrt(2 - 2t) along any dimension: a grid of that width over the leading two
sends each vector to its own and the neighbouring cells only. A cell is dealt
to tiles of bounded size, and pairs of tiles are compared as matrices: leading
dimensions are accumulated first, the rest of the product is bounded by the
product of the suffix norms, and a pair stops when the bound cannot reach t.
Survivors are confirmed on the original vectors in double precision.

Equal vectors of a label are one class; links are found between classes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import connected_components, materialize, numbered, without_rows


@dataclass(frozen=True)
class Similar:
    """``sample`` rows, those with the smallest hash of their id, fit the
    rotation; all rows are compared. ``tile``: vectors of a tile. ``steps``:
    dimensions after which pairs are given up."""

    threshold: float = 0.93
    sample: int = 4096
    tile: int = 512
    steps: tuple[int, ...] = (4, 8, 16, 32)


_SLACK = 1e-9


def fit_rotations(vectors: list[list[float]]) -> dict[int, np.ndarray]:
    """Per vector length the principal directions of the unit vectors, by variance."""
    out = {}
    for d in sorted({len(v) for v in vectors}):
        x = np.array([v for v in vectors if len(v) == d], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        _, q = np.linalg.eigh(x.T @ x)
        out[d] = q[:, ::-1]
    return out


def _matrix(col: pa.Array) -> np.ndarray:
    """A column of equally long lists as double-precision rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(col), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # squares must not overflow
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(rotations: dict, width: float):
    def run(batches):
        for batch in batches:
            size = batch.column(batch.schema.get_field_index("size")).to_numpy()
            c = np.zeros((2, len(size)), np.int64)
            for d in np.unique(size):
                here = np.flatnonzero(size == d)
                y = _unit(_matrix(batch.column(batch.schema.get_field_index("vec")).take(pa.array(here))))
                lead = y @ rotations[d][:, :2] if d in rotations else y[:, :2]
                c[:lead.shape[1], here] = np.floor(lead / width).T
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c[0]), pa.array(c[1])],
                                             names=[*batch.schema.names, "c1", "c2"])
    return run


def close_pairs(x: np.ndarray, y: np.ndarray, rotation: np.ndarray | None, p: Similar):
    """(row of x, row of y) whose cosine reaches the threshold."""
    u, v = _unit(x), _unit(y)
    a, b = (u @ rotation, v @ rotation) if rotation is not None else (u, v)
    d = a.shape[1]
    cuts = [0, *(s for s in p.steps if s < d), d]
    tail = [np.sqrt(np.maximum((z * z)[:, ::-1].cumsum(axis=1)[:, ::-1], 0)) for z in (a, b)]
    so_far, i, j = None, None, None
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if so_far is None:  # first step: the whole tile
            part = a[:, lo:hi] @ b[:, lo:hi].T
            rest = tail[0][:, hi, None] * tail[1][None, :, hi] if hi < d else 0.0
            i, j = np.nonzero(part + rest >= p.threshold - _SLACK)
            so_far = part[i, j]
        else:
            so_far = so_far + np.einsum("nd,nd->n", a[i, lo:hi], b[j, lo:hi])
            rest = tail[0][i, hi] * tail[1][j, hi] if hi < d else 0.0
            keep = so_far + rest >= p.threshold - _SLACK
            i, j, so_far = i[keep], j[keep], so_far[keep]
    exact = np.einsum("nd,nd->n", u[i], v[j]) >= p.threshold
    return i[exact], j[exact]


def _compare(rotations: dict, p: Similar):
    def run(table: pa.Table) -> pa.Table:
        rep, n, side = (table.column(c).to_numpy() for c in ("rep", "n", "side"))
        x = _matrix(table.column("vec"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        links, low = np.zeros(len(rep), np.int64), np.arange(len(rep))
        order = np.argsort(rep, kind="stable")
        name = np.empty(len(rep), np.int64)  # rows by the order of their ids
        name[order] = np.arange(len(rep))
        low = name.copy()
        same = len(right) == 0  # a tile against itself
        pairs = []
        for lo in range(0, len(left), 256):
            rows = left[lo:lo + 256]
            i, j = close_pairs(x[rows], x[left if same else right], rotations.get(x.shape[1]), p)
            i, j = rows[i], (left if same else right)[j]
            if same:
                i, j = i[i != j], j[i != j]
                np.add.at(links, i, n[j])
            else:
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
            pairs.append(np.stack((i, j)))
        i, j = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        while True:  # smallest id reachable inside the pair of tiles
            new = low.copy()
            np.minimum.at(new, i, low[j])
            np.minimum.at(new, j, low[i])
            new = np.minimum(new, new[order[new]])
            if (new == low).all():
                break
            low = new
        hit = np.flatnonzero(links)
        return pa.table({"rep": rep[hit], "links": links[hit], "low": rep[order[low[hit]]]})
    return run


def _rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, row) -> DataFrame:
    """(row, id, label, vec, good) of every vector; ``good`` ones may have links."""
    src = vectors.select(row.alias("row"), F.col(id_col).cast("long").alias("id"),
                         F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("vec"))
    good = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vec") > 0) & ~F.exists(
        "vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("vec", lambda v: v != 0)
    return src.withColumn("good", F.coalesce(good, F.lit(False)))


def _linked(src: DataFrame, p: Similar) -> DataFrame:
    """(row, id, n_links, component, component_id) of the good rows of ``_rows``.

    Equal vectors of a label are one class with a number of its own, so that an id
    with several vectors has a class for each."""
    width = math.sqrt(2 - 2 * p.threshold) * (1 + _SLACK)
    classes = (src.filter("good").groupBy("label", "vec").agg(F.min("id").alias("first"), F.count("*").alias("n"))
               .withColumn("size", F.size("vec")))
    firsts = numbered(classes, "vec-classes").withColumnRenamed("__row", "rep")
    classes = firsts.drop("first")
    sample = firsts.orderBy(F.xxhash64("first"), "first").limit(p.sample).select("vec").collect()
    rotations = fit_rotations([r["vec"] for r in sample])
    schema = StructType([*classes.schema.fields, StructField("c1", LongType()), StructField("c2", LongType())])
    placed = materialize(classes.mapInArrow(_cells(rotations, width), schema), "vec-cells")
    key = ["label", "size", "c1", "c2"]
    cells = materialize(placed.groupBy(key).agg(F.ceil(F.count("*") / p.tile).alias("tiles")), "vec-tiles")
    # Pairs of neighbouring cells, each once: (0,0) (0,1) (1,-1) (1,0) (1,1).
    steps = F.array(*(F.struct(F.lit(x).cast("long").alias("d1"), F.lit(y).cast("long").alias("d2"))
                      for x, y in [(0, 0), (0, 1), (1, -1), (1, 0), (1, 1)]))
    other = cells.select("label", "size", F.col("c1").alias("e1"), F.col("c2").alias("e2"),
                         F.col("tiles").alias("others"))
    near = cells.select("*", F.inline(steps)).withColumns(
        {"e1": F.col("c1") + F.col("d1"), "e2": F.col("c2") + F.col("d2")})
    near = materialize(near.join(other, ["label", "size", "e1", "e2"]), "vec-neighbours")
    dealt = (placed.join(cells, key).withColumn("own", F.pmod(F.xxhash64("rep"), "tiles")).drop("tiles"))
    left = dealt.join(near, key).select(
        *key, "d1", "d2", F.col("own").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1)).alias("j"),
        "rep", "n", "vec", F.lit(0).alias("side"))
    left = left.filter("d1 <> 0 or d2 <> 0 or i <= j")
    right = dealt.withColumnsRenamed({"c1": "e1", "c2": "e2"}).join(near, ["label", "size", "e1", "e2"]).select(
        *key, "d1", "d2",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("i"),
        F.col("own").alias("j"), "rep", "n", "vec", F.lit(1).alias("side"))
    right = right.filter("d1 <> 0 or d2 <> 0 or i < j")
    found = left.unionByName(right).groupBy(*key, "d1", "d2", "i", "j").applyInArrow(
        _compare(rotations, p), "rep long, links long, low long")
    found = materialize(found, "vec-links")
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found.filter("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    met = firsts.select("label", "vec", "rep", "n", "first").join(linked, "rep", "left").join(
        roots.withColumnRenamed("node", "rep"), "rep", "left")
    met = materialize(met.select(
        "label", "vec", "first", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("component"), F.col("links").isNotNull().alias("joined")), "vec-met")
    lowest = met.filter("joined").groupBy("component").agg(F.min("first").alias("lowest"))
    known = materialize(met.join(lowest, "component", "left").select(
        "label", "vec", "n_links", "component", F.coalesce("lowest", "first").alias("component_id")), "vec-known")
    return src.filter("good").join(known, ["label", "vec"]).select(
        "row", "id", "n_links", "component", "component_id")


def similar_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label", params: Similar = Similar()) -> DataFrame:
    """One row per vector: ``id_col, n_links`` (other vectors of its label with
    cosine >= threshold), ``component_id`` (smallest id reachable over links,
    itself included) and ``kept`` (it is its own component id).

    Rows with a null id or label, and vectors that are null, empty, zero or hold
    null or non-finite components, link with nothing. Vectors of different length
    are never compared. Rows that share an id are vectors of their own, with links
    and a component each. Other columns, whatever their names, are ignored.
    """
    src = _rows(vectors, id_col, vec_col, label_col, F.lit(0))
    out = _linked(src, params).select("id", "n_links", "component_id")
    out = out.unionByName(src.filter("not good").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_similar(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", params: Similar = Similar()) -> DataFrame:
    """``vectors``, all columns as they were, one row of each linked group (the
    smallest id; of rows that share it, any one); rows that link with nothing stay,
    null ids and labels included."""
    rows = numbered(vectors, "vec-rows")
    found = materialize(_linked(_rows(rows, id_col, vec_col, label_col, F.col("__row")), params).select(
        "component", F.struct("id", "row").alias("at")), "vec-found")
    best = found.groupBy("component").agg(F.min("at").alias("best"))
    gone = found.join(best, "component").filter("at <> best").select(F.col("at.row").alias("__row"))
    return without_rows(rows, gone, "vec-gone")
