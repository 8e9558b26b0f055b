"""Fixed-length sequence windows per engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearspan.operators.skew import ROWS_PER_TASK, Key, KeyProfile, Panel, key_columns, split_panel
from wearspan.schema import CYCLE, ENGINE, RUL, WINDOW_SIZE


def _finish(ended: DataFrame, engine: Key) -> DataFrame:
    """Turn ``_steps`` (structs cycle/target/x) into the window columns."""
    last = F.element_at("_steps", -1)
    return ended.select(
        *key_columns(engine),
        F.element_at("_steps", 1)["cycle"].alias("start_cycle"),
        last["cycle"].alias("end_cycle"),
        last["target"].cast("float").alias("target"),
        F.col("_steps.x").alias("window"),
    )


def _step(features: Sequence[str], target: str, cycle: str):
    return F.struct(
        F.col(cycle).alias("cycle"),
        F.col(target).alias("target"),
        F.array(*[F.col(c).cast("float") for c in features]).alias("x"),
    )


def window_lookback(size: int, stride: int = 1) -> int:
    """Rows before a window's last one that cutting it reads."""
    if size <= 0:
        raise ValueError("a window needs at least one row")
    if stride <= 0:
        raise ValueError("windows need a stride of at least one row")
    return size - 1 if stride == 1 else size + stride - 1


def make_windows(
    df: DataFrame,
    features: Sequence[str],
    target: str = RUL,
    size: int = WINDOW_SIZE,
    stride: int = 1,
    profile: KeyProfile | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    engine: Key = ENGINE,
    cycle: str = CYCLE,
) -> DataFrame:
    """Cut (size × features) windows starting at rows 0, stride, 2·stride … of each engine.

    One row per window: engine, start and end cycle, label of the last row, and
    the float cells in time-major order. Windows never cross engines, and engines
    shorter than ``size`` give none.
    """
    panel = split_panel(df, window_lookback(size, stride), profile, rows_per_task, engine, cycle)
    return cut_windows(panel, features, target, size, stride)


def cut_windows(
    panel: Panel, features: Sequence[str], target: str = RUL, size: int = WINDOW_SIZE, stride: int = 1
) -> DataFrame:
    """``make_windows`` on a panel that was split with enough lookback.

    With a stride, rows are first gathered into blocks of ``stride`` rows that end
    where windows end; a window then takes its last blocks, so the work per row is
    ``1 + size/stride`` instead of ``size``.
    """
    window_lookback(size, stride)
    step = _step(features, target, panel.cycle)
    if stride == 1:
        framed = panel.select(
            *panel.keys, panel.position.alias("_at"), F.collect_list(step).over(panel.trailing(size)).alias("_steps")
        )
        return _finish(framed.frame().where(F.col("_at") >= size), panel.engine)

    group = panel.group
    ranked = panel.rows.select(*group, panel.position.alias("_at"), panel.owned.alias("_owned"), step.alias("_step"))
    block = F.ceil((F.col("_at") - size) / F.lit(stride)).cast("long")
    blocks = ranked.groupBy(*group, block.alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct("_at", "_owned", "_step"))).alias("_rows")
    )
    recent = Window.partitionBy(*group).orderBy("_block").rowsBetween(1 - -(-size // stride), 0)
    joined = blocks.select(
        *group,
        "_block",
        F.element_at("_rows", -1).alias("_end"),
        F.flatten(F.collect_list("_rows").over(recent)).alias("_all"),
    )
    complete = (F.col("_block") >= 0) & (F.col("_end._at") == F.col("_block") * stride + size) & F.col("_end._owned")
    ended = joined.where(complete).withColumn("_steps", F.slice(F.col("_all._step"), -size, size))
    return _finish(ended, panel.engine)


def last_windows(
    df: DataFrame,
    features: Sequence[str],
    target: str = RUL,
    size: int = WINDOW_SIZE,
    engine: Key = ENGINE,
    cycle: str = CYCLE,
) -> DataFrame:
    """The latest window of every engine that is at least ``size`` rows long.

    Only the last ``size`` rows per engine are kept, and Spark applies that limit
    before the shuffle, so no other window is built.
    """
    window_lookback(size)
    newest = Window.partitionBy(*key_columns(engine)).orderBy(F.col(cycle).desc())
    tail = df.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= size)
    gathered = tail.groupBy(*key_columns(engine)).agg(
        F.array_sort(F.collect_list(_step(features, target, cycle))).alias("_steps")
    )
    return _finish(gathered.where(F.size("_steps") == size), engine)


def latest_window(windows: DataFrame, engine: Key = ENGINE) -> DataFrame:
    """From windows already built, keep the one with the largest end cycle per engine."""
    newest = Window.partitionBy(*key_columns(engine)).orderBy(F.col("end_cycle").desc(), F.col("start_cycle"))
    return windows.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def last_cycle_snapshot(df: DataFrame, engine: Key = ENGINE, cycle: str = CYCLE) -> DataFrame:
    """The last observed row of every engine (limit applied before the shuffle)."""
    newest = Window.partitionBy(*key_columns(engine)).orderBy(F.col(cycle).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")
