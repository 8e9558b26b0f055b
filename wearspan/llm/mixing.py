"""Mixing sources to target weights by capped water-filling.

Every source asks for words in proportion to its weight. A source that would be read more
than ``cap`` times stops there and the excess goes to the others by weight, until none is
above. The closed form: sort sources by cap / weight; those below the water level are full.

Each source's target is met by whole repetitions of all its documents and a fractional one:
documents in the order of a seeded hash, up to the words still missing. The last of them is
taken in part, so a source's words meet its target to the word.

No task sees a whole source: words are summed in 4096 hash cells per source, and only the
documents of the one cell where the fraction ends are put in order.

Defined cases: null text has no words; a null source is a source, the last in order; sources
without words get target 0; equal rows share a hash and either may be the last taken; an
empty table gives no rows; other columns are kept by ``repeat`` and ignored by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.llm.common import settled, text_of, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 17


def _hash(docs: DataFrame, seed: int) -> Column:
    known = F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))
    return F.md5(F.concat(F.lit(f"{seed}:"), known, F.lit(":"), F.md5(text_of(docs).cast("binary"))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, percent: int = 100) -> DataFrame:
    """source, source_size -> also target, whole (repetitions), rest (words of the fractional one).

    One row per source: the windows over all of them run on this table alone. Weights repeat
    along the sources in code-point order, null last.
    """
    number = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (number % len(weights) + 1).cast("int"))
    wide = "decimal(38,0)"
    s = sizes.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * cap)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "filled": F.coalesce(F.sum("most").over(before), F.lit(0)),
            "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    s = s.withColumn("goal", F.expr(f"total * {percent} div 100"))
    full = F.col("most").cast(wide) * F.col("open") <= F.col("weight").cast(wide) * (F.col("goal") - F.col("filled"))
    s = s.withColumn("full", full)
    s = s.withColumns(
        {
            "left": F.col("goal") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0)),
            "share": F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything),
        }
    )
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise((F.col("left") * F.col("weight")).cast("double") / F.col("share"))
    s = s.withColumn("target", target).withColumn("budget", F.round("target").cast("long"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.expr("budget div source_size"))).otherwise(0).cast("long")
    s = s.withColumn("whole", whole)
    return s.select("source", "source_size", "target", "whole", (F.col("budget") - F.col("whole") * F.col("source_size")).alias("rest"))


def _cut(rows: DataFrame, weights: tuple[int, ...], cap: int, percent: int) -> DataFrame:
    """One row per source: its targets, and the hash cell in which the fractional repetition ends."""
    cells = settled(rows.groupBy("source", F.substring("h", 1, 3).alias("cell")).agg(F.sum("size").alias("words")), "cells")
    sizes = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    goals = targets(sizes, weights, cap, percent)
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cells = cells.withColumnRenamed("source", "of").join(goals.select("source", "rest"), F.col("of").eqNullSafe(F.col("source")))
    last = cells.where("before <= rest AND rest < before + words").select("of", F.col("cell").alias("last_cell"), "before")
    return settled(goals.join(last, F.col("of").eqNullSafe(F.col("source")), "left").drop("of"), "cut")


def _take(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """rows (source, size, h and more) with target, copies (whole ones) and part (words of a partial one)."""
    cell = F.substring("h", 1, 3)
    r = rows.join(cut.withColumnRenamed("source", "of"), F.col("of").eqNullSafe(F.col("source"))).drop("of")
    at_cut = F.coalesce(cell == F.col("last_cell"), F.lit(False))
    below = F.coalesce(cell < F.col("last_cell"), F.lit(False))
    plain = r.where(~at_cut).withColumns({"copies": F.col("whole") + below.cast("long"), "part": F.lit(0).cast("long")})
    order = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    edge = r.where(at_cut).withColumn("got", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    fits = F.col("got") + F.col("size") <= F.col("rest")
    part = F.when(fits, F.lit(0)).otherwise(F.greatest(F.lit(0), F.col("rest") - F.col("got")))
    edge = edge.withColumns({"copies": F.col("whole") + fits.cast("long"), "part": part.cast("long")}).drop("got")
    return plain.unionByName(edge)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, percent: int = 100, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, part, taken (= copies * size + part)."""
    rows = docs.select("doc_id", "source", word_count(text_of(docs)).alias("size"), _hash(docs, seed).alias("h"))
    rows = settled(rows, "sizes")
    taken = _take(rows, _cut(rows, weights, cap, percent))
    return taken.select(
        "doc_id", "source", "size", "source_size", "target", "copies", "part", (F.col("copies") * F.col("size") + F.col("part")).alias("taken")
    )


def repeat(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, percent: int = 100, seed: int = SEED) -> DataFrame:
    """The mixed corpus: documents with all their columns, each as often as the mix takes it.

    Texts stay whole here: the document taken in part counts if half of it or more is taken.
    """
    measured = docs.select(
        F.struct("*").alias("doc"), docs["source"].alias("source"), word_count(text_of(docs)).alias("size"), _hash(docs, seed).alias("h")
    )
    cut = _cut(settled(measured.select("source", "size", "h"), "sizes"), weights, cap, percent)
    taken = _take(measured, cut)
    copies = F.col("copies") + ((F.col("part") > 0) & (F.col("part") * 2 >= F.col("size"))).cast("long")
    taken = taken.withColumn("copies", copies).where("copies > 0")
    return taken.select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
