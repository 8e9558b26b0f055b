"""Queries on sequence windows.

Windows are arrays; each query reduces them to plain columns that pin down every
cell and its place (position-weighted sums), so results compare as values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.functions.arrays import channels, flat, instance_normalize, last_step, patches
from wearspan.operators.labels import add_train_rul
from wearspan.operators.sequences import last_windows, latest_window, make_windows
from wearspan.queries.common import labelled, rounded
from wearspan.queries.registry import EVENTS, TELEMETRY, query
from wearspan.schema import ENGINE, RUL
from wearspan.sources.tables import telemetry_events

FEATURES = ["s_2", "s_4"]
PLACE = [ENGINE, "start_cycle", "end_cycle", "target"]


def _weighted(cells: Column) -> Column:
    """Sum of cell × position over a flattened window."""
    numbered = F.transform(cells, lambda x, i: x.cast("double") * (i + 1))
    return F.aggregate(numbered, F.lit(0.0), lambda acc, x: acc + x)


def _summary(windows: DataFrame) -> DataFrame:
    return rounded(
        windows.select(
            *PLACE,
            _weighted(flat("window")).alias("checksum"),
            F.element_at(last_step("window"), 1).cast("double").alias("last_s_2"),
        ),
        ["checksum", "last_s_2"],
        3,
    )


def _window_sql(source: str, size: int, keep: str, features: tuple[str, ...] = ("s_2", "s_4")) -> str:
    """Windows by ROWS frames; the checksum weights cell (t, f) by t·F + f + 1."""
    frame = f"(PARTITION BY engine_id ORDER BY \"cycle\" ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    width = len(features)
    cells = " + ".join(
        f"sum(CAST(CAST({c} AS FLOAT) AS DOUBLE) * (\"cycle\" * {width} + {f + 1})) OVER {frame} "
        f"- ({width} * (\"cycle\" - {size} + 1)) * sum(CAST(CAST({c} AS FLOAT) AS DOUBLE)) OVER {frame}"
        for f, c in enumerate(features)
    )
    return f"""framed AS (
  SELECT engine_id, "cycle" - {size} + 1 AS start_cycle, "cycle" AS end_cycle, CAST(rul AS FLOAT) AS target,
         round({cells}, 3) AS checksum, round(CAST(CAST(s_2 AS FLOAT) AS DOUBLE), 3) AS last_s_2,
         max("cycle") OVER (PARTITION BY engine_id) AS top
  FROM {source})
SELECT engine_id, CAST(start_cycle AS INTEGER) AS start_cycle, end_cycle, target, checksum, last_s_2
FROM framed WHERE end_cycle >= {size} AND {keep}"""


@query(f"WITH {TELEMETRY}, {_window_sql('labelled', 30, '(end_cycle - 30) % 10 = 0')}")
def seq_windows_w30_s10(spark: SparkSession, folder: str) -> DataFrame:
    rows, profile = labelled(spark, folder)
    return _summary(make_windows(rows, FEATURES, RUL, 30, 10, profile))


@query(f"WITH {TELEMETRY}, {_window_sql('labelled', 30, 'true')}")
def seq_windows_w30_s1(spark: SparkSession, folder: str) -> DataFrame:
    rows, profile = labelled(spark, folder)
    return _summary(make_windows(rows, FEATURES, RUL, 30, 1, profile))


@query(f"WITH {EVENTS}, {_window_sql('labelled_events', 60, '(end_cycle - 60) % 7 = 0', ('s_2', 's_3'))}")
def seq_windows_short_engines(spark: SparkSession, folder: str) -> DataFrame:
    """Windows longer than some engines: those give none."""
    source = telemetry_events(spark, folder)
    rows = add_train_rul(source.rows, profile=source.profile)
    return _summary(make_windows(rows, ["s_2", "s_3"], RUL, 60, 7, source.profile))


@query(f"WITH {TELEMETRY}, {_window_sql('labelled', 30, 'end_cycle = top')}")
def seq_last_window(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = labelled(spark, folder)
    return _summary(last_windows(rows, FEATURES, RUL, 30))


LATEST = "end_cycle = 30 + 10 * ((top - 30) // 10)"


@query(f"WITH {TELEMETRY}, {_window_sql('labelled', 30, LATEST)}")
def seq_latest_of_strided(spark: SparkSession, folder: str) -> DataFrame:
    """The latest among windows that were cut with a stride."""
    rows, profile = labelled(spark, folder)
    return _summary(latest_window(make_windows(rows, FEATURES, RUL, 30, 10, profile)))


def _channels(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (window, feature): windows of 30 rows, stride 10, in feature-major order."""
    rows, profile = labelled(spark, folder)
    windows = make_windows(rows, FEATURES, RUL, 30, 10, profile)
    turned = windows.select(ENGINE, "end_cycle", F.posexplode(channels(F.col("window"), len(FEATURES))).alias("f", "channel"))
    names = F.array(*[F.lit(f) for f in FEATURES])
    return turned.select(
        ENGINE, "end_cycle", F.element_at(names, F.col("f") + 1).alias("feature"), F.col("channel").cast("array<double>")
    )


# One row per (window, feature, step) with its place t = 0..29 in the window.
STEPS = """ends AS (SELECT engine_id, "cycle" AS end_cycle FROM telemetry WHERE "cycle" >= 30 AND ("cycle" - 30) % 10 = 0),
steps AS (
  SELECT e.engine_id, e.end_cycle, 's_2' AS feature, t."cycle" - e.end_cycle + 29 AS t, CAST(CAST(t.s_2 AS FLOAT) AS DOUBLE) AS x
  FROM ends e JOIN telemetry t ON t.engine_id = e.engine_id AND t."cycle" BETWEEN e.end_cycle - 29 AND e.end_cycle
  UNION ALL
  SELECT e.engine_id, e.end_cycle, 's_4', t."cycle" - e.end_cycle + 29, CAST(CAST(t.s_4 AS FLOAT) AS DOUBLE)
  FROM ends e JOIN telemetry t ON t.engine_id = e.engine_id AND t."cycle" BETWEEN e.end_cycle - 29 AND e.end_cycle)"""


@query(
    f"""WITH {TELEMETRY}, {STEPS},
scaled AS (
  SELECT *, (x - avg(x) OVER w) / greatest(stddev_pop(x) OVER w, 1e-5) AS z
  FROM steps WINDOW w AS (PARTITION BY engine_id, end_cycle, feature))
SELECT engine_id, end_cycle, feature, round(sum(z * (t + 1)), 4) AS checksum, round(sum(z * z), 4) AS energy,
       round(max(CASE WHEN t = 0 THEN z END), 5) AS first_z, round(max(CASE WHEN t = 29 THEN z END), 5) AS last_z
FROM scaled GROUP BY ALL"""
)
def window_revin(spark: SparkSession, folder: str) -> DataFrame:
    """Instance normalisation of every channel of every window."""
    z = _channels(spark, folder).withColumn("z", instance_normalize(F.col("channel")))
    out = z.select(
        ENGINE,
        "end_cycle",
        "feature",
        F.round(_weighted(F.col("z")), 4).alias("checksum"),
        F.round(F.aggregate("z", F.lit(0.0), lambda acc, v: acc + v * v), 4).alias("energy"),
        F.round(F.element_at("z", 1), 5).alias("first_z"),
        F.round(F.element_at("z", -1), 5).alias("last_z"),
    )
    return out


@query(
    f"""WITH {TELEMETRY}, {STEPS}
SELECT engine_id, end_cycle, feature, CAST(p AS INTEGER) AS patch, count(*) AS n_cells,
       round(sum(x * (t - p * 5 + 1)), 3) AS checksum
FROM steps, generate_series(0, 4) AS g(p)
WHERE t BETWEEN p * 5 AND p * 5 + 9
GROUP BY ALL"""
)
def window_patches(spark: SparkSession, folder: str) -> DataFrame:
    """Every channel cut into patches of 10 steps, 5 apart."""
    cut = _channels(spark, folder).select(
        ENGINE, "end_cycle", "feature", F.posexplode(patches(F.col("channel"), 30, 10, 5)).alias("patch", "cells")
    )
    return cut.select(
        ENGINE,
        "end_cycle",
        "feature",
        "patch",
        F.size("cells").cast("long").alias("n_cells"),
        F.round(_weighted(F.col("cells")), 3).alias("checksum"),
    )
