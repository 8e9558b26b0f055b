"""Trailing statistics per machine on a stream: the rolling columns of ``operators/rolling``, row by row.

The state of a machine is its last cycle and a ring of its latest ``n - 1`` rows, whatever its
history. Rows of a batch are taken in the order of their cycles. A row whose cycle is not above the
last one seen is late or repeated: its frame has been left behind, so it comes out marked
``late`` and without statistics and doesn't enter the ring. Of equal cycles in one batch the first counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from wearspan.operators.rolling import lookback, rolling_column_names
from wearspan.schema import CYCLE, ENGINE, ROLLING_WINDOWS

STATE = "last_cycle int, ring array<double>"


def frames_of(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample spread of the last n rows at each row, skipping what is no number; a single value has spread 0."""
    padded = np.concatenate([np.full((n - 1, values.shape[1]), np.nan), values])
    frame = np.lib.stride_tricks.sliding_window_view(padded, n, axis=0)
    known = (~np.isnan(frame)).sum(-1)
    total = np.nansum(frame, -1)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.where(known > 0, total / known, np.nan)
        square = np.nansum((frame - mean[..., None]) ** 2, -1)
        spread = np.where(known > 1, np.sqrt(square / (known - 1)), 0.0)
    return mean, spread


def advance(rows: pd.DataFrame, last: int | None, ring: np.ndarray, sensors: Sequence[str], windows: Sequence[int]) -> tuple[pd.DataFrame, int | None, np.ndarray]:
    """The rows with their statistics, and the state after them."""
    reach = lookback(windows)
    # arrays throughout: a group is small, and each pandas operation costs more than all its numbers
    engines, cycles = rows[ENGINE].to_numpy(), rows[CYCLE].to_numpy()
    order = np.argsort(cycles, kind="stable")
    engines, cycles = engines[order], cycles[order]
    late = np.zeros(len(cycles), dtype=bool)
    late[1:] = cycles[1:] == cycles[:-1]
    if last is not None:
        late |= cycles <= last
    fresh = ~late
    readings = np.stack([rows[s].to_numpy(dtype=float)[order][fresh] for s in sensors], axis=1)
    values = np.concatenate([ring, readings])
    n_late = int(late.sum())
    out = {ENGINE: np.concatenate([engines[fresh], engines[late]]), CYCLE: np.concatenate([cycles[fresh], cycles[late]])}
    out["late"] = np.repeat([False, True], [len(readings), n_late])
    nothing = np.full(n_late, np.nan)
    for n in windows:
        mean, spread = frames_of(values, n)
        for kind, cells in (("mean", mean), ("std", spread)):
            for i, s in enumerate(sensors):
                out[f"{s}_roll{n}_{kind}"] = np.concatenate([cells[len(ring) :, i], nothing])
    if len(readings):
        last = int(cycles[fresh][-1])
    kept = values[len(values) - min(reach, len(values)) :]
    return pd.DataFrame(out), last, kept


def trailing(readings: DataFrame, sensors: Sequence[str], windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """engine, cycle, late and the rolling columns of every row of a stream of readings."""
    lookback(windows)
    names = rolling_column_names(sensors, windows)
    kinds = ", ".join(f"{c} double" for c in names)

    def step(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, ring = state.get if state.exists else (None, [])
        parts = list(frames)
        rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        out, last, kept = advance(rows, last, np.array(ring, dtype=float).reshape(-1, len(sensors)), sensors, windows)
        state.update((last, kept.ravel().tolist()))
        yield out[[ENGINE, CYCLE, "late", *names]]

    needed = readings.select(F.col(ENGINE).cast("int").alias(ENGINE), F.col(CYCLE).cast("int").alias(CYCLE), *[F.col(s).cast("double").alias(s) for s in sensors])
    named = needed.where(F.col(ENGINE).isNotNull() & F.col(CYCLE).isNotNull())
    return named.groupBy(ENGINE).applyInPandasWithState(
        step, f"{ENGINE} int, {CYCLE} int, late boolean, {kinds}", STATE, "append", GroupStateTimeout.NoTimeout
    )


def start_trailing(
    readings: DataFrame,
    sensors: Sequence[str],
    output_path: str,
    checkpoint_path: str,
    windows: Sequence[int] = ROLLING_WINDOWS,
    once: bool = False,
) -> StreamingQuery:
    writer = trailing(readings, sensors, windows).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start(output_path)
