"""Keeping per-engine work parallel when one engine holds much of the data.

A window partitioned by engine puts a whole engine into one task. That is the
best plan for the usual panel (hundreds of cycles per engine, one shuffle) and a
dead end for an engine with a third of all rows. A panel is therefore measured
first. Without a heavy engine ``split_panel`` returns the frame untouched; with
one, the rows of the heavy engines are cut into segments of consecutive positions,
and each segment carries the few preceding rows a trailing frame needs. Results
are the same either way. A ``Panel`` is split once and then passed from operator to
operator, so labels, rolling statistics and windows share one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from wearspan.schema import CYCLE, ENGINE

# Rows one task may hold for one window partition.
ROWS_PER_TASK = 2_000_000
# Most keys a broadcast table may have, whatever it is built from.
BROADCAST_KEYS = 100_000

UNBOUNDED = Window.unboundedPreceding


#: A key column, or several (such as subset and engine) that name a machine together.
Key = str | Sequence[str]


def key_columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


@dataclass(frozen=True)
class KeyProfile:
    """Row count of a frame and the keys too large for one task.

    ``heavy`` holds one row per heavy key: (key, first cycle, last cycle), and
    ``dense`` says that those keys have every cycle from first to last.
    """

    rows: int
    heavy: DataFrame | None = None
    dense: bool = True


def heavy_threshold(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Size above which a key is split.

    At most ``rows / threshold`` keys can exceed it, so there are never more than
    ``BROADCAST_KEYS`` heavy keys and they may always be collected and broadcast.
    """
    return max(rows_per_task, rows // BROADCAST_KEYS)


def profile_key(
    df: DataFrame, key: Key = ENGINE, cycle: str | None = CYCLE, rows_per_task: int = ROWS_PER_TASK
) -> KeyProfile:
    """Find the keys that are too large for one task.

    A frame that fits one task as a whole has none; for files that count comes
    from their footers. Otherwise the keys are counted, map-side first. Without a
    ``cycle`` column the rows of a key are taken as cycles 1, 2, 3 …
    """
    rows = df.count()
    if rows <= rows_per_task:
        return KeyProfile(rows)
    n = F.count(F.lit(1))
    first, last = (F.min(cycle), F.max(cycle)) if cycle else (F.lit(1), n)
    sizes = df.groupBy(*key_columns(key)).agg(n.alias("_n"), first.cast("long").alias("_first"), last.cast("long").alias("_last"))
    found = sizes.where(F.col("_n") > heavy_threshold(rows, rows_per_task)).collect()
    if not found:
        return KeyProfile(rows)
    dense = all(r["_last"] - r["_first"] + 1 == r["_n"] for r in found)
    heavy = df.sparkSession.createDataFrame(found, sizes.schema).drop("_n")
    return KeyProfile(rows, heavy, dense)


def with_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Sequence[Column], name: str = "_pos"
) -> DataFrame:
    """Add the 1-based rank of a row within its key without sorting a key in one task.

    ``bucket`` must rise with ``order`` and hold no nulls. Rows are ranked inside
    their bucket and shifted by the number of rows in the key's earlier buckets.
    """
    tags = [f"_b{i}" for i in range(len(bucket))]
    tagged = df.withColumns(dict(zip(tags, bucket)))
    cells = [*keys, *tags]
    before = Window.partitionBy(*keys).orderBy(*tags).rowsBetween(UNBOUNDED, -1)
    starts = (
        tagged.groupBy(*cells)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*cells, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    inside = F.row_number().over(Window.partitionBy(*cells).orderBy(*order))
    ranked = tagged.withColumn("_inside", inside)
    return ranked.join(starts, cells).select(*df.columns, (F.col("_start") + F.col("_inside")).alias(name))


def rank_within(
    df: DataFrame, key: Key, order: Sequence[Column], bucket: Sequence[Column], name: str, profile: KeyProfile
) -> DataFrame:
    """Rank rows within a key: plain window for ordinary keys, bucketed for heavy ones."""
    keys = key_columns(key)
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if profile.heavy is None:
        return df.withColumn(name, plain)
    heavy = F.broadcast(profile.heavy.select(*keys))
    light = df.join(heavy, keys, "left_anti").withColumn(name, plain)
    split = with_position(df.join(heavy, keys, "left_semi"), keys, order, bucket, name)
    return light.unionByName(split)


@dataclass(frozen=True)
class Panel:
    """Panel rows ready for trailing windows, with the columns to partition them by."""

    rows: DataFrame
    engine: Key = ENGINE
    cycle: str = CYCLE
    split: bool = False

    # Columns of a split panel: position, segment, carried-along flag, engine's last cycle.
    HELPERS = ("_pos", "_segment", "_halo", "_last")

    @property
    def keys(self) -> list[str]:
        """The columns that name a machine."""
        return key_columns(self.engine)

    @property
    def group(self) -> list[str]:
        return [*self.keys, "_segment"] if self.split else self.keys

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in self.HELPERS]

    @property
    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(self.cycle)

    def trailing(self, n: int) -> WindowSpec:
        """Frame of the last n rows up to the current one."""
        return self.ordered.rowsBetween(1 - n, 0)

    @property
    def position(self) -> Column:
        """1-based row position within the engine."""
        rank = F.row_number().over(self.ordered)
        return F.coalesce(F.col("_pos"), rank) if self.split else rank

    @property
    def last_cycle(self) -> Column:
        """Largest cycle of the engine, on every row."""
        top = F.max(self.cycle).over(self.ordered.rowsBetween(UNBOUNDED, Window.unboundedFollowing))
        return F.coalesce(F.col("_last"), top) if self.split else top

    @property
    def owned(self) -> Column:
        """False on rows that are only carried along for a following segment."""
        return ~F.col("_halo") if self.split else F.lit(True)

    def select(self, *columns: str | Column) -> Panel:
        """Project, keeping what the split needs."""
        kept = self.HELPERS if self.split else ()
        return replace(self, rows=self.rows.select(*columns, *kept))

    def map(self, step: Callable[[DataFrame], DataFrame]) -> Panel:
        """Apply a row-wise step to the rows."""
        return replace(self, rows=step(self.rows))

    def frame(self) -> DataFrame:
        """The plain panel again: every row once."""
        return self.rows.where(self.owned).drop(*self.HELPERS) if self.split else self.rows


def split_panel(
    df: DataFrame,
    lookback: int = 0,
    profile: KeyProfile | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    engine: Key = ENGINE,
    cycle: str = CYCLE,
) -> Panel:
    """Prepare a panel for frames that look back ``lookback`` rows."""
    keys = key_columns(engine)
    profile = profile or profile_key(df, engine, cycle, rows_per_task)
    if profile.heavy is None:
        return Panel(df, engine, cycle)

    kind = df.schema[cycle].dataType
    heavy = F.broadcast(profile.heavy)
    if profile.dense:
        joined = df.join(heavy, keys, "left").withColumn("_pos", F.col(cycle) - F.col("_first") + 1)
    else:
        bucket = F.floor(F.col(cycle) / F.lit(rows_per_task))
        hot = with_position(df.join(heavy, keys), keys, [F.col(cycle)], [bucket])
        light = df.join(heavy, keys, "left_anti")
        joined = hot.unionByName(light, allowMissingColumns=True)
    size = F.lit(max(rows_per_task, lookback, 1))
    home = F.coalesce(F.floor((F.col("_pos") - 1) / size), F.lit(0)).cast("long")
    tail = F.pmod(F.col("_pos") - 1, size) >= size - lookback
    placed = joined.withColumn("_segment", F.explode(F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))))
    rows = placed.select(
        *df.columns, "_pos", "_segment", (F.col("_segment") != home).alias("_halo"), F.col("_last").cast(kind).alias("_last")
    )
    return Panel(rows, engine, cycle, True)


def attach(
    df: DataFrame, lookup: DataFrame, key: Key, how: str = "left", profile: KeyProfile | None = None
) -> DataFrame:
    """Join rows to a table with one row per key.

    The lookup is counted and, if small, broadcast. A larger one is joined by
    shuffle, except for the heavy keys, whose few lookup rows are broadcast.
    """
    keys = key_columns(key)
    if lookup.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        return df.join(F.broadcast(lookup), keys, how)
    profile = profile or profile_key(df, key, None)
    if profile.heavy is None:
        return df.join(lookup, keys, how)
    heavy = F.broadcast(profile.heavy.select(*keys))
    light = df.join(heavy, keys, "left_anti").join(lookup, keys, how)
    hot = df.join(heavy, keys, "left_semi").join(F.broadcast(lookup.join(heavy, keys, "left_semi")), keys, how)
    return light.unionByName(hot)
