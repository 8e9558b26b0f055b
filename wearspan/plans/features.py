"""The feature plan: drop flat sensors, roll, (cluster), scale, clean, order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.functions.rul import clean
from wearspan.operators.normalize import NormalizationStats, fit_normalization, normalize
from wearspan.operators.regimes import RegimeModel, fit_regimes
from wearspan.operators.rolling import lookback, roll, rolled_frame, rolling_column_names
from wearspan.operators.skew import ROWS_PER_TASK, KeyProfile, Panel, split_panel
from wearspan.schema import CYCLE, ENGINE, FLAT_SENSORS, N_REGIMES, REGIME, ROLLING_WINDOWS, RUL, SEED, SENSORS, SETTINGS


@dataclass(frozen=True)
class FeatureConfig:
    drop_sensors: tuple[str, ...] = FLAT_SENSORS
    rolling_windows: tuple[int, ...] = ROLLING_WINDOWS
    normalize_by_regime: bool = False
    n_regimes: int = N_REGIMES
    seed: int = SEED
    rows_per_task: int = ROWS_PER_TASK


@dataclass(frozen=True)
class FeatureSet:
    """Lazy train and test features with what was fitted to make them.

    ``train`` and ``test`` are plain frames; the panels have the same rows, still partitioned for windows.
    """

    train: DataFrame
    test: DataFrame
    train_panel: Panel
    test_panel: Panel
    feature_columns: tuple[str, ...]
    sensor_columns: tuple[str, ...]
    rolling_columns: tuple[str, ...]
    stats: NormalizationStats
    regimes: RegimeModel | None


def build_features(
    train: DataFrame,
    test: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    regime_column: str | None = None,
    train_profile: KeyProfile | None = None,
    test_profile: KeyProfile | None = None,
) -> FeatureSet:
    """Engineer features of a labelled train and test panel."""
    reach = lookback(config.rolling_windows)
    return engineer(
        split_panel(train, reach, train_profile, config.rows_per_task),
        split_panel(test, reach, test_profile, config.rows_per_task),
        config,
        regime_column,
    )


def engineer(
    train: Panel, test: Panel, config: FeatureConfig = FeatureConfig(), regime_column: str | None = None
) -> FeatureSet:
    """The feature plan on panels that were split with enough lookback.

    Rolling statistics are taken on raw sensor values, then sensors and rolling
    columns (not the settings) are z-scored with statistics of the train panel.
    Pass ``regime_column`` to use a known regime id instead of clustering.
    """
    dropped = set(config.drop_sensors)
    sensors = [s for s in SENSORS if s not in dropped and s in train.columns]
    settings = [s for s in SETTINGS if s in train.columns]
    rolling = rolling_column_names(sensors, config.rolling_windows)
    features = [*([REGIME] if config.normalize_by_regime else []), *settings, *sensors, *rolling]

    regimes = None
    if config.normalize_by_regime and regime_column is None:
        regimes = fit_regimes(train.frame(), config.n_regimes, config.seed, settings=settings)

    def add_regime(rows: DataFrame) -> DataFrame:
        if regimes is not None:
            return regimes.assign(rows)
        return rows.withColumn(REGIME, F.col(regime_column).cast("int"))

    raw = [c for c in features if c not in rolling]

    def prepared(panel: Panel) -> Panel:
        kept = panel.map(lambda rows: rows.drop(*dropped))
        if config.normalize_by_regime:
            kept = kept.map(add_regime)
        return kept.select(ENGINE, CYCLE, *raw, RUL)

    train, test = prepared(train), prepared(test)
    # the fit reads neither settings nor labels
    fitted = train.select(ENGINE, CYCLE, *([REGIME] if config.normalize_by_regime else []), *sensors)
    stats = fit_normalization(rolled_frame(fitted, sensors, config.rolling_windows), sensors + rolling, config.normalize_by_regime)

    def finish(rows: DataFrame) -> DataFrame:
        return normalize(rows, stats).withColumns({c: clean(F.col(c)) for c in features if c != REGIME})

    def frame(panel: Panel) -> DataFrame:
        return finish(rolled_frame(panel, sensors, config.rolling_windows).select(ENGINE, CYCLE, *features, RUL))

    def windowed(panel: Panel) -> Panel:
        return roll(panel, sensors, config.rolling_windows).select(ENGINE, CYCLE, *features, RUL).map(finish)

    return FeatureSet(
        frame(train), frame(test), windowed(train), windowed(test), tuple(features), tuple(sensors), tuple(rolling), stats, regimes
    )


def of_engines(df: DataFrame, engines: DataFrame) -> DataFrame:
    """Rows of the engines listed in a table with an engine column."""
    return df.join(engines.select(ENGINE), ENGINE, "left_semi")


def select_features(df: DataFrame, features: Sequence[str], target: str = RUL) -> DataFrame:
    """Keys, model features in order, and the target."""
    return df.select(ENGINE, CYCLE, *features, target)
