"""Z-scores fitted on the training panel, globally or per operating regime."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wearspan.functions.rul import present, repair_std
from wearspan.schema import REGIME

# A table of regime statistics up to this many rows is broadcast; the size only chooses the join.
SMALL_TABLE = 10_000
# Shares of one regime's rows in the join with a larger table.
SALTS = 32


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, variance and repaired sample spread of many columns in one pass (wide form).

    Missing values and those that are not numbers are skipped.
    """
    aggregates = []
    for c in columns:
        v = present(F.col(c))
        aggregates += [F.count(v).alias(f"{c}__n"), F.avg(v).alias(f"{c}__mean"), F.var_pop(v).alias(f"{c}__var")]
    # The sample spread follows from the population variance; a second aggregate would double the work.
    spreads = {
        f"{c}__std": repair_std(F.sqrt(F.col(f"{c}__var") * F.try_divide(F.col(f"{c}__n"), F.col(f"{c}__n") - 1)))
        for c in columns
    }
    return df.groupBy(*by).agg(*aggregates).withColumns(spreads)


def long_moments(wide: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per column: (…, column, mean, std)."""
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"))
            for c in columns
        ]
    )
    return wide.select(*keep, F.inline(entries))


@dataclass(frozen=True)
class NormalizationStats:
    """Fitted means and spreads: the global ones as numbers, the regime ones as a table."""

    columns: tuple[str, ...]
    means: dict[str, float]
    stds: dict[str, float]
    regimes: DataFrame | None = None
    small: bool = True
    regime: str = REGIME


def fit_normalization(
    train: DataFrame, columns: Sequence[str], by_regime: bool = False, regime: str = REGIME
) -> NormalizationStats:
    """Fit the scaling on a training panel; an action, like any other fit."""
    if not by_regime:
        means, stds = _numbers(moments(train, columns).first(), columns)
        return NormalizationStats(tuple(columns), means, stds)

    table = moments(train, columns, [regime]).persist()
    means, stds = _merged(table, columns)
    rows = table.limit(SMALL_TABLE + 1).collect()
    if len(rows) > SMALL_TABLE:
        return NormalizationStats(tuple(columns), means, stds, table.drop(*_raw(columns)), False, regime)
    # a small table is kept as values, so that nothing stays in the executors' memory
    kept = train.sparkSession.createDataFrame(rows, table.schema).drop(*_raw(columns))
    table.unpersist()
    return NormalizationStats(tuple(columns), means, stds, kept, True, regime)


def _raw(columns: Sequence[str]) -> list[str]:
    return [f"{c}__{part}" for c in columns for part in ("n", "var")]


def _numbers(row: Row, columns: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    return {c: _number(row[f"{c}__mean"], 0.0) for c in columns}, {c: _number(row[f"{c}__std"], 1.0) for c in columns}


def _merged(table: DataFrame, columns: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Global mean and spread from the regime ones: within-group plus between-group squares."""
    sums = [F.sum(F.col(f"{c}__n")).alias(f"{c}__n") for c in columns]
    sums += [F.sum(F.col(f"{c}__n") * F.col(f"{c}__mean")).alias(f"{c}__sum") for c in columns]
    totals = table.agg(*sums).first()
    means = {c: totals[f"{c}__sum"] / totals[f"{c}__n"] if totals[f"{c}__n"] else 0.0 for c in columns}
    squares = [
        F.sum(F.col(f"{c}__n") * (F.col(f"{c}__var") + F.pow(F.col(f"{c}__mean") - means[c], 2.0))).alias(c) for c in columns
    ]
    spread = table.agg(*squares).first()
    stds = {}
    for c in columns:
        n = totals[f"{c}__n"] or 0
        std = math.sqrt(spread[c] / (n - 1)) if n > 1 else 1.0
        stds[c] = std if std > 0 else 1.0
    return means, stds


def _number(value, default: float) -> float:
    return default if value is None or math.isnan(value) else float(value)


def _with_statistics(df: DataFrame, stats: NormalizationStats) -> DataFrame:
    """Rows beside the statistics of their regime; null statistics where it has none.

    A small table is broadcast. A large one is joined by shuffle, and there a regime may hold
    most rows: each row takes one of ``SALTS`` shares by a hash of its columns, and the table, one
    narrow row per regime, is repeated for each share. A null regime matches nothing but is dealt
    over the tasks in the same way.
    """
    if stats.small:
        return df.join(F.broadcast(stats.regimes), stats.regime, "left")
    shares = [c for c, kind in df.dtypes if "map<" not in kind]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*shares), F.lit(SALTS)).cast("int"))
    repeated = stats.regimes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [stats.regime, "_salt"], "left").drop("_salt")


def normalize(df: DataFrame, stats: NormalizationStats) -> DataFrame:
    """Replace the fitted columns by their z-scores, keeping column order.

    Regimes that were not seen in training, or are null, use the global statistics.
    """
    if stats.regimes is None:
        return df.withColumns({c: (F.col(c) - stats.means[c]) / F.lit(stats.stds[c]) for c in stats.columns})
    joined = _with_statistics(df, stats)

    def score(c: str) -> Column:
        mean = F.coalesce(F.col(f"{c}__mean"), F.lit(stats.means[c]))
        std = F.when(F.col(f"{c}__std").isNull(), stats.stds[c]).otherwise(F.col(f"{c}__std"))
        return ((F.col(c) - mean) / std).alias(c)

    scaled = set(stats.columns)
    return joined.select(*[score(c) if c in scaled else F.col(c) for c in df.columns])
