"""Column names, types and defaults of the panel data model.

A *panel* is a DataFrame with one row per (engine, cycle). Cycles are integer
counters, so every window in this package is a ROWS frame.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Names and defaults that are part of the data contract.
ENGINE = "engine_id"
CYCLE = "cycle"
RUL = "rul"
REGIME = "operating_regime"
SETTINGS = [f"setting_{i}" for i in range(1, 4)]
SENSORS = [f"s_{i}" for i in range(1, 22)]
FLAT_SENSORS = ("s_1", "s_5", "s_6", "s_10", "s_16", "s_18", "s_19")
SUBSETS = ("FD001", "FD002", "FD003", "FD004")
MULTI_REGIME_SUBSETS = ("FD002", "FD004")
RUL_CAP = 125
ROLLING_WINDOWS = (5, 10)
WINDOW_SIZE = 30
N_REGIMES = 6
SEED = 42

TELEMETRY = T.StructType(
    [T.StructField(ENGINE, T.IntegerType(), False), T.StructField(CYCLE, T.IntegerType(), False)]
    + [T.StructField(c, T.DoubleType()) for c in SETTINGS + SENSORS]
)

METRICS = ("rmse", "mae", "r2", "nasa_score")

RUN_RECORD = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("artifact_path", T.StringType()),
        T.StructField("metadata_path", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("params", T.StringType()),
        T.StructField("feature_columns", T.ArrayType(T.StringType())),
        T.StructField("input_size", T.IntegerType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)


def active_sensors(dropped=FLAT_SENSORS, sensors=SENSORS) -> list[str]:
    """Sensors that remain after dropping the flat ones, in their usual order."""
    gone = set(dropped)
    return [s for s in sensors if s not in gone]


def rolling_names(sensors, window: int) -> tuple[list[str], list[str]]:
    """Names of the rolling mean and rolling std columns for one window length."""
    return [f"{s}_roll{window}_mean" for s in sensors], [f"{s}_roll{window}_std" for s in sensors]


def model_features(columns) -> list[str]:
    """Columns a model may see: everything but keys, label and regime id."""
    hidden = {ENGINE, CYCLE, RUL, REGIME}
    return [c for c in columns if c not in hidden]
