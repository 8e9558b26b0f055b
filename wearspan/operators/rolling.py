"""Trailing rolling statistics per engine."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearspan.functions.rul import present
from wearspan.operators.skew import ROWS_PER_TASK, Key, KeyProfile, Panel, split_panel
from wearspan.schema import CYCLE, ENGINE, ROLLING_WINDOWS, rolling_names


def lookback(windows: Sequence[int]) -> int:
    """Rows before the current one that the widest window reads."""
    if any(n <= 0 for n in windows):
        raise ValueError("a rolling window needs at least one row")
    return max(windows, default=1) - 1


def rolling_columns(panel: Panel, sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS) -> list[Column]:
    """Rolling means then rolling sample spreads, window by window.

    Frames may be partial at the start of an engine; a one-row frame has spread 0.
    Missing values and those that are not numbers are skipped.
    All frames share one partitioning and order, hence one shuffle and one sort.
    """
    lookback(windows)
    out = []
    for n in windows:
        frame = panel.trailing(n)
        means, spreads = rolling_names(sensors, n)
        out += [F.avg(present(F.col(s))).over(frame).alias(name) for s, name in zip(sensors, means)]
        out += [
            F.coalesce(F.stddev_samp(present(F.col(s))).over(frame), F.lit(0.0)).alias(name)
            for s, name in zip(sensors, spreads)
        ]
    return out


def rolling_column_names(sensors: Sequence[str], windows: Sequence[int]) -> list[str]:
    return [name for n in windows for part in rolling_names(sensors, n) for name in part]


def roll(panel: Panel, sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS) -> Panel:
    return panel.select(*panel.columns, *rolling_columns(panel, sensors, windows))


def _kernel(sensors: Sequence[str], windows: Sequence[int], names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rolling columns of batches that come in window order; ``_at`` is a row's place within its group.

    The sums run from the oldest row of a frame to the newest, as Spark's averages and spreads do.
    """
    reach = max(lookback(windows), 0)

    def frame(lags: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count, total, mean, squares = (np.zeros_like(lags[0]) for _ in range(4))
        for x in reversed(lags[:n]):
            known = ~np.isnan(x)
            count += known
            total += np.where(known, x, 0.0)
            delta = x - mean
            part = delta / count
            mean = np.where(known, mean + part, mean)
            squares = np.where(known, squares + delta * (delta - part), squares)
        return count, total / count, np.where(count > 1, np.sqrt(squares / (count - 1)), 0.0)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = np.full((len(sensors), reach), np.nan)
        for batch in batches:
            at = batch.column("_at").to_numpy()
            now = [batch.column(s).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False) for s in sensors]
            values = np.concatenate([before, np.reshape(now, (len(sensors), len(at)))], axis=1)
            lags = [np.where(at > k, values[:, reach - k : reach - k + len(at)], np.nan) for k in range(reach + 1)]
            before = values[:, values.shape[1] - reach :]
            columns = batch.columns[:-1]
            with np.errstate(all="ignore"):
                for n in windows:
                    count, means, spreads = frame(lags, n)
                    columns += [pa.array(m, mask=c == 0) for m, c in zip(means, count)]
                    columns += [pa.array(d) for d in spreads]
            yield pa.RecordBatch.from_arrays(columns, names=list(names))

    return step


def rolled_frame(panel: Panel, sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """The rows of ``roll`` as a plain frame, several times faster.

    Spark evaluates a sliding frame anew for every row. Here it only sorts and numbers the rows,
    and whole batches are summed with numpy. What follows is no longer known to be partitioned by
    engine, so ``roll`` remains for panels that are cut into windows. Decimals keep their exact sums in ``roll``.
    """
    kinds = {f.name: f.dataType for f in panel.rows.schema.fields}
    if not (sensors and windows) or not all(isinstance(kinds[s], (T.FractionalType, T.IntegralType)) and not isinstance(kinds[s], T.DecimalType) for s in sensors):
        return roll(panel, sensors, windows).frame()
    helpers = ["_halo"] if panel.split else []
    rows = panel.rows.select(*panel.columns, *helpers, F.row_number().over(panel.ordered).alias("_at"))
    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(c, T.DoubleType()) for c in rolling_column_names(sensors, windows)]])
    made = rows.mapInArrow(_kernel(sensors, windows, schema.names), schema)
    return made.where(~F.col("_halo")).drop("_halo") if panel.split else made


def add_rolling(
    df: DataFrame,
    sensors: Sequence[str],
    windows: Sequence[int] = ROLLING_WINDOWS,
    profile: KeyProfile | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    engine: Key = ENGINE,
    cycle: str = CYCLE,
) -> DataFrame:
    """Add rolling mean and spread of every sensor without crossing engines."""
    return rolled_frame(split_panel(df, lookback(windows), profile, rows_per_task, engine, cycle), sensors, windows)
