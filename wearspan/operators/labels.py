"""Remaining-useful-life labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.functions.rul import cap_rul
from wearspan.operators.skew import ROWS_PER_TASK, Key, KeyProfile, Panel, attach, key_columns, profile_key, split_panel
from wearspan.schema import CYCLE, ENGINE, RUL, RUL_CAP

# Ids that an error message spells out; it also says how many there are.
NAMED_ENGINES = 100


def label_train(panel: Panel, cap: int | None = RUL_CAP) -> Panel:
    """Label a run-to-failure panel: cycles left until the engine's last one, capped."""
    return panel.select(*panel.columns, cap_rul(panel.last_cycle - F.col(panel.cycle), cap).alias(RUL))


def label_test(panel: Panel, final_rul: DataFrame, cap: int | None = RUL_CAP, profile: KeyProfile | None = None) -> Panel:
    """Label a censored panel: cycles to its last row plus the official life left there."""
    ahead = panel.select(*panel.columns, (panel.last_cycle - F.col(panel.cycle)).alias("_ahead"))
    label = cap_rul(F.col("_ahead") + F.col("final_rul").cast("int"), cap)
    official = final_rul.select(*panel.keys, "final_rul")
    known = ahead.map(lambda rows: attach(rows, official, panel.engine, "left", profile))
    return known.select(*panel.columns, label.alias(RUL))


def add_train_rul(
    df: DataFrame,
    cap: int | None = RUL_CAP,
    profile: KeyProfile | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    engine: Key = ENGINE,
    cycle: str = CYCLE,
) -> DataFrame:
    """Label run-to-failure histories; one shuffle, shared with later windows on the engine."""
    return label_train(split_panel(df, 0, profile, rows_per_task, engine, cycle), cap).frame()


def missing_final_rul(df: DataFrame, final_rul: DataFrame, engine: Key = ENGINE) -> DataFrame:
    """Engines of a censored panel that have no official final label, or an empty one."""
    known = final_rul.where(F.col("final_rul").isNotNull()) if "final_rul" in final_rul.columns else final_rul
    keys = key_columns(engine)
    return df.select(*keys).distinct().join(known, keys, "left_anti").orderBy(*keys)


def add_test_rul(
    df: DataFrame,
    final_rul: DataFrame,
    cap: int | None = RUL_CAP,
    profile: KeyProfile | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    engine: Key = ENGINE,
    cycle: str = CYCLE,
    check: bool = True,
) -> DataFrame:
    """Label censored histories from the official remaining life at their last cycle.

    ``final_rul`` has one row ``(engine, final_rul)`` per engine. Engines without
    one raise ``ValueError`` (turn ``check`` off if the caller has checked).
    """
    if check:
        require_final_rul(df, final_rul, engine)
    profile = profile or profile_key(df, engine, cycle, rows_per_task)
    return label_test(split_panel(df, 0, profile, rows_per_task, engine, cycle), final_rul, cap, profile).frame()


def require_final_rul(df: DataFrame, final_rul: DataFrame, engine: Key = ENGINE) -> None:
    """Fail if engines lack an official label, with their number and the first of their ids."""
    missing = missing_final_rul(df, final_rul, engine)
    found = missing.agg(F.count(F.lit(1)).alias("n")).first()
    if found["n"]:
        some = [r[0] if len(r) == 1 else tuple(r) for r in missing.limit(NAMED_ENGINES).collect()]
        more = f" and {found['n'] - len(some)} more (missing_final_rul lists all)" if found["n"] > len(some) else ""
        raise ValueError(f"{found['n']} engines have no official remaining life: {some}{more}")


def join_last_cycle(df: DataFrame, profile: KeyProfile | None = None, engine: Key = ENGINE, cycle: str = CYCLE) -> DataFrame:
    """Attach ``max_cycle`` by joining the per-engine maximum back.

    Cheaper than a window for a panel read straight from storage: the maximum is
    combined map-side, and while it is small enough to broadcast no row moves.
    """
    top = df.groupBy(*key_columns(engine)).agg(F.max(cycle).alias("max_cycle"))
    return attach(df, top, engine, "inner", profile)


def label_breaks(df: DataFrame, profile: KeyProfile | None = None, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per engine: rows, label at the last cycle, and places where the label rises."""
    panel = split_panel(df, 1, profile, rows_per_task)
    previous = F.lag(RUL).over(panel.ordered)
    steps = panel.select(ENGINE, CYCLE, RUL, previous.alias("_previous")).frame()
    return steps.groupBy(ENGINE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum((F.col(RUL) > F.col("_previous")).cast("int")), F.lit(0)).alias("violations"),
        F.max_by(RUL, CYCLE).alias("last_rul"),
        F.max(RUL).alias("top_rul"),
    )
