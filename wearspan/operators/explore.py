"""Exploratory profiles of a panel: one aggregation pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.schema import CYCLE, ENGINE, REGIME, RUL


def _long(wide: DataFrame, columns: Sequence[str], value: str, keep: Sequence[str] = ()) -> DataFrame:
    return wide.unpivot(list(keep), list(columns), "sensor", value)


def sensor_spread(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Sample spread of every sensor, one row per sensor."""
    return _long(df.agg(*[F.stddev_samp(s).alias(s) for s in sensors]), sensors, "std")


def flat_sensors(df: DataFrame, sensors: Sequence[str], tolerance: float = 1e-4) -> DataFrame:
    """Sensors whose spread is practically zero."""
    return sensor_spread(df, sensors).where(F.col("std") < tolerance)


def rul_correlation(df: DataFrame, sensors: Sequence[str], target: str = RUL) -> DataFrame:
    """Pearson correlation of every sensor with the label; null for a constant sensor."""
    y = F.col(target).cast("double")
    cells = [
        F.try_divide(F.covar_samp(F.col(s), y), F.stddev_samp(s) * F.stddev_samp(y)).alias(s) for s in sensors
    ]
    return _long(df.agg(*cells), sensors, "correlation").orderBy("correlation", "sensor")


def regime_means(df: DataFrame, sensors: Sequence[str], regime: str = REGIME) -> DataFrame:
    """Mean of chosen sensors per operating regime."""
    return df.groupBy(regime).agg(*[F.avg(s).alias(f"{s}_mean") for s in sensors])


def quality_profile(df: DataFrame, columns: Sequence[str], engine: str = ENGINE) -> DataFrame:
    """Rows, engines, and missing or non-finite cells per column."""
    facts = [F.count(F.lit(1)).alias("n_rows"), F.countDistinct(engine).alias("n_engines")]
    bad = [
        F.sum((F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))).cast("int")).alias(c)
        for c in columns
    ]
    wide = df.agg(*facts, *bad)
    return _long(wide, columns, "n_bad", ["n_rows", "n_engines"])


def engine_lives(df: DataFrame, engine: str = ENGINE, cycle: str = CYCLE) -> DataFrame:
    """Rows, first and last cycle per engine."""
    return df.groupBy(engine).agg(
        F.count(F.lit(1)).alias("n_cycles"), F.min(cycle).alias("first_cycle"), F.max(cycle).alias("max_cycle")
    )
