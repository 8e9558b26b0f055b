"""Deterministic hold-outs, samples and parameter grids."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.operators.skew import with_position
from wearspan.schema import CYCLE, ENGINE

# Multipliers and moduli of the portable row hash.
ENGINE_FACTOR = 7919
CYCLE_FACTOR = 104729
PERCENT = 100
FINE = 1_000_003
#: Bits of the mixed hash, and how many of them a round of radix selection counts.
HASH_BITS = 60
RADIX_BITS = 15


def row_hash(modulus: int, engine: str = ENGINE, cycle: str | None = CYCLE) -> Column:
    """A hash of the row key that any SQL engine can repeat."""
    mixed = F.col(engine).cast("long") * ENGINE_FACTOR
    if cycle is not None:
        mixed = mixed + F.col(cycle).cast("long") * CYCLE_FACTOR
    return F.pmod(mixed, F.lit(modulus))


def scrambled_hash(engine: str = ENGINE, cycle: str | None = CYCLE) -> Column:
    """The row hash squared, so that rows next to each other in it are unrelated."""
    h = row_hash(FINE, engine, cycle)
    return F.pmod(h * h, F.lit(FINE))


def with_holdout(df: DataFrame, percent: int = 20, by: str = "row", engine: str = ENGINE, cycle: str = CYCLE) -> DataFrame:
    """Mark about ``percent`` of the rows as validation.

    ``by="row"`` splits rows, so neighbouring cycles of one engine land on both
    sides; ``by="engine"`` keeps engines whole and avoids that leak.
    """
    if by not in ("row", "engine"):
        raise ValueError("split by 'row' or by 'engine'")
    h = scrambled_hash(engine, cycle if by == "row" else None)
    return df.withColumn("is_validation", h % PERCENT < percent)


def mixed_hash(engine: str = ENGINE, cycle: str = CYCLE) -> Column:
    """``HASH_BITS`` well-mixed bits of the row key, from the first digits of its MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", F.col(engine), F.col(cycle)).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


@dataclass(frozen=True)
class HashCut:
    """The smallest hashes of a frame: all ``below`` the cut, and ``take`` of the ``at`` rows that have it."""

    total: int
    cut: int
    take: int
    at: int


def hash_cut(df: DataFrame, hashed: Column, size: Callable[[int], int]) -> HashCut:
    """Find the hash that ``size(total)`` rows do not exceed, by radix selection.

    Each round counts the rows per value of the next ``RADIX_BITS`` bits and keeps the one
    value in which the count is reached. A job shuffles and returns one number per value, so
    at most ``2 ** RADIX_BITS``, and reads the key columns only; once what is left has no more rows
    than that, its whole hashes are counted. Nothing is sorted and no row leaves its partition.
    """
    left, shift, below, wanted, total = df.select(hashed.alias("_hash")), HASH_BITS, 0, None, None
    while True:
        few = total is not None and at <= 1 << RADIX_BITS
        shift = 0 if few else max(0, shift - RADIX_BITS)
        digits = F.shiftright("_hash", shift)
        counts = sorted(map(tuple, left.groupBy(digits.alias("_digits")).agg(F.count(F.lit(1))).collect()))
        if total is None:
            total = sum(n for _, n in counts)
            wanted = min(size(total), total)
            if wanted <= 0:
                return HashCut(total, -1, 0, 0)
        for digit, at in counts:
            if below + at >= wanted:
                break
            below += at
        if shift == 0:
            return HashCut(total, digit, wanted - below, at)
        left = left.where(F.col("_hash").between(digit << shift, ((digit + 1) << shift) - 1))


def _mark_smallest(df: DataFrame, hashed: Column, found: HashCut, name: str) -> DataFrame:
    """Mark the rows of a cut: one expression, unless only some rows of the cut's own hash are wanted."""
    if found.take == found.at:
        return df.withColumn(name, hashed <= found.cut)
    marked = df.withColumn(name, hashed < found.cut)
    others = F.xxhash64(*df.columns)
    tied = with_position(df.where(hashed == found.cut), [], [others], [F.shiftright(others, 48)])
    return marked.where(hashed != found.cut).unionByName(tied.withColumn(name, F.col("_pos") <= found.take).drop("_pos"))


def exact_holdout(df: DataFrame, fraction: float = 0.2, engine: str = ENGINE, cycle: str = CYCLE) -> DataFrame:
    """Mark exactly ``max(1, int(n · fraction))`` rows as validation: those with the smallest hash.

    ``hash_cut`` finds the largest of these hashes; the marks are then a comparison in the
    row. Only where rows repeat a key and the cut falls between them are the rows of that one hash
    ranked, by a hash of all their columns and in cells of it; rows that are equal throughout share
    a cell. A null in the key hashes like an absent part. Fewer than two rows are an error.
    """
    hashed = mixed_hash(engine, cycle)
    found = hash_cut(df, hashed, lambda total: max(1, int(total * fraction)))
    if found.total < 2 or found.take < 1 or int(found.total * fraction) >= found.total:
        raise ValueError("a hold-out needs at least two rows")
    return _mark_smallest(df, hashed, found, "is_validation")


def background_sample(df: DataFrame, n: int, engine: str = ENGINE, cycle: str = CYCLE) -> DataFrame:
    """A repeatable sample of ``n`` rows without replacement (all rows if fewer); a filter, not a sort."""
    hashed = mixed_hash(engine, cycle)
    found = hash_cut(df, hashed, lambda total: n)
    if found.total <= n:
        return df
    return _mark_smallest(df, hashed, found, "_taken").where("_taken").drop("_taken")


def expand_grid(grid: dict[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All parameter combinations; the first name changes slowest."""
    combos: list[dict[str, Any]] = [{}]
    for name, values in grid.items():
        combos = [{**combo, name: value} for combo in combos for value in values]
    return combos


def grid_frame(lists: DataFrame, names: Sequence[str]) -> DataFrame:
    """Combinations as rows: each column of ``lists`` holds the values of one parameter.

    Arrays are exploded one after another, so no join is involved.
    """
    out = lists.select(*names, *[F.size(name).alias("_size_" + name) for name in names])
    ordinal = F.lit(0)
    for name in names:
        out = out.select(
            *[c for c in out.columns if c != name], F.posexplode(name).alias(f"_at_{name}", name)
        )
        ordinal = ordinal * F.col("_size_" + name) + F.col("_at_" + name)
    return out.select(ordinal.alias("ordinal"), *names)
