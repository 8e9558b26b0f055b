"""Matches of patterns with their places, by built-in functions, in time that grows with the text.

Between the matches of a pattern lie the pieces that ``split`` gives, so lengths give places. They
are added up in blocks of BLOCK matches: appending to an array copies it, so no array that grows
holds more than a block or one number a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
#: Code points of text before a match that are kept with it.
CONTEXT = 32
SPAN = "array<struct<start:int,stop:int,found:string,before:string,after:string>>"


def with_matches(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds a column per pattern: start, stop (code points, end exclusive), found, and beside them what is before and after.

    Beside each pattern stands a cheaper condition that every text with a match meets.
    before is the text since the last match, at most CONTEXT code points of its end; after is one code point or none.
    The columns are made in steps, as each is read more than once by the next.
    """
    none = F.array().cast(SPAN)
    df = df.withColumns({f"{name}_has": F.when(may, F.col(text).rlike(pattern)).otherwise(False) for name, (pattern, may) in patterns.items()})
    for name, (pattern, _) in patterns.items():
        has = F.col(f"{name}_has")
        both = {f"{name}_found": F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), f"{name}_gaps": F.when(has, F.split(text, pattern, -1))}
        df = df.withColumns(both).drop(f"{name}_has")
    for name in patterns:
        found, gaps = F.col(f"{name}_found"), F.col(f"{name}_gaps")
        pieces = F.arrays_zip(gaps.alias("gap"), found.alias("found"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("next"))
        pieces = F.slice(pieces, F.lit(1), F.size(found))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int")), lambda b: F.slice(pieces, b * BLOCK + 1, F.lit(BLOCK)))
        df = df.withColumn(f"{name}_blocks", blocks).drop(f"{name}_found", f"{name}_gaps")
    for name in patterns:
        df = df.withColumn(name, F.coalesce(_placed(F.col(f"{name}_blocks")), none)).drop(f"{name}_blocks")
    return df


def _placed(blocks: Column) -> Column:
    lengths = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda n, p: n + F.char_length(p["gap"]) + F.char_length(p["found"])))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    begins = F.aggregate(lengths, first, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")), lambda s: s["all"])

    def step(s: Column, p: Column) -> Column:
        start = s["at"] + F.char_length(p["gap"])
        stop = start + F.char_length(p["found"])
        beside = [F.right(p["gap"], F.lit(CONTEXT)).alias("before"), F.left(p["next"], F.lit(1)).alias("after")]
        span = F.struct(start.alias("start"), stop.alias("stop"), p["found"].alias("found"), *beside)
        return F.struct(stop.alias("at"), F.concat(s["spans"], F.array(span)).alias("spans"))

    def block_spans(block: Column, begin: Column) -> Column:
        return F.aggregate(block, F.struct(begin.alias("at"), F.array().cast(SPAN).alias("spans")), step, lambda s: s["spans"])

    return F.flatten(F.zip_with(blocks, begins, block_spans))
