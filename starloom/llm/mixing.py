"""Mixing sources to target weights by whole copies of documents.

Sizes are summed by source, each source gets a share of all words by its weight,
never more than ``cap`` times its own size, and its repetition rate is target over
size. A document is taken floor(rate) times plus one copy with probability equal
to the fraction: its draw is a hash of a seed and its id, so a rerun takes the same
copies. Of a fixed number of seeds, each source uses the one whose copies come
nearest its target.

Everything is DataFrame expressions. Grouping is a partial aggregate on the source;
the join back to the documents has plain scans below its exchanges, so a source
with a third of the rows is split by adaptive execution. The driver sees three
sums a round and one count per sorted partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Words: maximal runs of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights of the sources in code-point order, repeating.
CYCLE = (1, 2, 3)
#: No document is taken more often than this.
CAP = 3
#: Draws that each source chooses from.
SEEDS = 16


def _draw(seed: Column, doc: Column) -> Column:
    """A number in [0, 1) with 52 bits from the seed and the id (null: ``null``)."""
    hashed = F.md5(F.concat_ws(":", seed.cast("string"), F.coalesce(doc.cast("string"), F.lit("null"))))
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def _copies(rate: Column, draw: Column) -> Column:
    return F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")


def numbered_sources(sources: DataFrame, name: str = "source") -> DataFrame:
    """``sources`` (unique) with ``place``, from 0, in code-point order, null last.
    A range-partitioned sort, and a prefix sum over its partitions' counts."""
    own = (sources.repartitionByRange(F.col(name).asc_nulls_last()).sortWithinPartitions(F.col(name).asc_nulls_last())
           .withColumn("__at", F.monotonically_increasing_id()))
    own = materialize(own, "mix-sorted")
    part = F.shiftright("__at", 33)
    before, base = 0, {}
    for p, n in sorted(own.groupBy(part.alias("p")).count().collect()):  # one row a partition
        base[p], before = before, before + n
    start = F.create_map(*(F.lit(x) for kv in base.items() for x in kv))[part] if base else F.lit(0)
    return own.withColumn("place", (start + F.col("__at") - F.shiftleft(part, 33)).cast("long")).drop("__at")


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, cap: int = CAP) -> DataFrame:
    """``source, source_size, target`` of ``sizes`` (``source, size``).

    All sizes are shared by weight. Sources whose share is over ``cap`` times
    their size stop there, and what they leave is shared among the others by
    weight, until none is above.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*(F.lit(w) for w in cycle)), (F.col("place") % len(cycle) + 1).cast("int"))
    todo = numbered_sources(total).withColumn("weight", weight.cast("long")).drop("place")
    todo = materialize(todo.withColumn("most", F.lit(cap) * F.col("source_size")), "mix-sources")
    left, weights = todo.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    share, open_ = F.lit(0.0), todo
    while weights:
        share = F.lit(float(left)) * F.col("weight") / F.lit(float(weights))
        over = open_.filter(share > F.col("most")).agg(F.sum("most"), F.sum("weight")).first()
        if over[1] is None:
            break
        # A source at its cap stays there: the share of a weight only grows.
        open_ = open_.filter(share <= F.col("most"))
        left, weights = left - over[0], weights - over[1]
    return todo.select("source", "source_size", F.least(F.col("most").cast("double"), share).alias("target"))


def _rates(sized: DataFrame, cycle: tuple[int, ...], cap: int, seeds: int) -> DataFrame:
    """``__source, __size, __target, __rate, __seed``, one row per source."""
    targets = materialize(source_targets(sized, cycle, cap), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    own = targets.select(F.col("source").alias("__source"), F.col("source_size").alias("__size"),
                         F.col("target").alias("__target"), rate.alias("__rate"))
    rows = sized.join(own, F.col("source").eqNullSafe(F.col("__source")))
    tried = rows.groupBy("__source", "__size", "__target", "__rate").agg(
        *(F.sum(F.col("size") * _copies(F.col("__rate"), _draw(F.lit(s), F.col("doc")))).alias(f"t{s}")
          for s in range(seeds)))
    misses = (F.struct(F.abs(F.col(f"t{s}") - F.col("__target")).alias("miss"), F.lit(s).alias("seed"))
              for s in range(seeds))
    return materialize(tried.select("__source", "__size", "__target", "__rate",
                                    F.array_min(F.array(*misses))["seed"].alias("__seed")), "mix-rates")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    return materialize(docs.select(F.col(id_col).alias("doc"), F.col(source_col).cast("string").alias("source"),
                                   size.alias("size")), "mix-sizes")


def mix_sources(docs: DataFrame, cycle: tuple[int, ...] = CYCLE, cap: int = CAP, seeds: int = SEEDS,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``id_col, size, source_size, target`` (both of its
    source), ``copies`` (0 to ``cap``) and ``taken`` (size times copies).

    Null text has size 0, a null source is a source of its own (after all others),
    an empty one another. A source without words has target 0 and no copies. Rows
    with the same id share their draw; null ids share one. Other columns, whatever
    their names, are not looked at. No rows give no rows.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    out = sized.join(_rates(sized, cycle, cap, seeds), F.col("source").eqNullSafe(F.col("__source")))
    copies = _copies(F.col("__rate"), _draw(F.col("__seed"), F.col("doc"))).cast("long")
    out = out.withColumn("copies", copies)
    return out.select(F.col("doc").alias(id_col), "size", F.col("__size").alias("source_size"),
                      F.col("__target").alias("target"), "copies", (F.col("size") * F.col("copies")).alias("taken"))


def emit_copies(docs: DataFrame, cycle: tuple[int, ...] = CYCLE, cap: int = CAP, seeds: int = SEEDS,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture itself: every row of ``docs``, all columns, as often as
    ``mix_sources`` takes it. Texts are not shuffled unless a source is split."""
    rates = _rates(_sized(docs, id_col, text_col, source_col), cycle, cap, seeds)
    out = docs.join(rates, docs[source_col].cast("string").eqNullSafe(F.col("__source")))
    copies = _copies(F.col("__rate"), _draw(F.col("__seed"), docs[id_col])).cast("int")
    out = out.withColumn("__n", copies).filter("__n > 0")
    return out.withColumn("__n", F.explode(F.array_repeat(F.lit(0), F.col("__n")))).select(*docs.columns)
