"""Queries on panels of several subsets, whose machines share engine numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.functions.arrays import flat
from wearspan.operators.labels import add_test_rul, add_train_rul, missing_final_rul
from wearspan.operators.rolling import add_rolling
from wearspan.operators.sequences import last_windows, make_windows
from wearspan.operators.skew import profile_key
from wearspan.queries.common import rounded
from wearspan.queries.registry import EVENTS, TELEMETRY, query
from wearspan.queries.windows import _weighted
from wearspan.schema import CYCLE, ENGINE, RUL
from wearspan.sources.tables import DATASET, MACHINE, subset_final_rul, subset_panel

SUBSETS_SQL = f"""{TELEMETRY}, {EVENTS},
panel AS MATERIALIZED (
  SELECT 'FD001' AS dataset, engine_id, "cycle", s_2, s_3 FROM telemetry
  UNION ALL SELECT 'FD002', engine_id, "cycle", s_2, s_3 FROM telemetry_events),
subset AS MATERIALIZED (
  SELECT *, max("cycle") OVER (PARTITION BY dataset, engine_id) AS top,
         CAST(least(max("cycle") OVER (PARTITION BY dataset, engine_id) - "cycle", 125) AS INTEGER) AS rul
  FROM panel)"""


@query(
    f"""WITH {SUBSETS_SQL}
SELECT dataset, engine_id, "cycle", rul,
       CAST(CASE WHEN dataset = 'FD001' THEN least(top - "cycle" + 20 + engine_id % 100, 125)
                 WHEN engine_id % 3 <> 0 THEN least(top - "cycle" + engine_id % 50, 125) END AS INTEGER) AS censored_rul
FROM subset"""
)
def multi_subset_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of both kinds per (subset, engine); some machines of one subset have no official life."""
    panel = subset_panel(spark, folder)
    profile = profile_key(panel, MACHINE)
    labelled = add_train_rul(panel.select(*MACHINE, CYCLE), profile=profile, engine=MACHINE).withColumnRenamed(RUL, "_rul")
    both = add_test_rul(labelled, subset_final_rul(spark, folder), profile=profile, engine=MACHINE, check=False)
    return both.select(*MACHINE, CYCLE, F.col("_rul").alias(RUL), F.col(RUL).alias("censored_rul"))


@query(
    f"""WITH {SUBSETS_SQL}
SELECT DISTINCT dataset, engine_id FROM panel WHERE dataset = 'FD002' AND engine_id % 3 = 0"""
)
def multi_subset_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Machines without an official life: the other subset's engine of that number has one."""
    return missing_final_rul(subset_panel(spark, folder), subset_final_rul(spark, folder), MACHINE)


def _windows_sql(keep: str) -> str:
    frame = '(PARTITION BY dataset, engine_id ORDER BY "cycle" ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)'
    cells = " + ".join(
        f'sum(CAST(CAST({c} AS FLOAT) AS DOUBLE) * ("cycle" * 2 + {f + 1})) OVER {frame} '
        f'- (2 * ("cycle" - 30 + 1)) * sum(CAST(CAST({c} AS FLOAT) AS DOUBLE)) OVER {frame}'
        for f, c in enumerate(("s_2", "s_3"))
    )
    return f"""WITH {SUBSETS_SQL},
framed AS (SELECT dataset, engine_id, "cycle" - 29 AS start_cycle, "cycle" AS end_cycle, CAST(rul AS FLOAT) AS target, top,
                  round({cells}, 3) AS checksum FROM subset)
SELECT dataset, engine_id, CAST(start_cycle AS INTEGER) AS start_cycle, end_cycle, target, checksum
FROM framed WHERE end_cycle >= 30 AND {keep}"""


def _summary(windows: DataFrame) -> DataFrame:
    summed = windows.select(*MACHINE, "start_cycle", "end_cycle", "target", _weighted(flat("window")).alias("checksum"))
    return rounded(summed, ["checksum"], 3)


@query(_windows_sql("(end_cycle - 30) % 10 = 0"))
def multi_subset_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows never run from a machine of one subset into the machine of that number in another."""
    panel = subset_panel(spark, folder)
    profile = profile_key(panel, MACHINE)
    rows = add_train_rul(panel, profile=profile, engine=MACHINE)
    return _summary(make_windows(rows, ["s_2", "s_3"], RUL, 30, 10, profile, engine=MACHINE))


@query(_windows_sql("end_cycle = top"))
def multi_subset_last_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = add_train_rul(subset_panel(spark, folder), engine=MACHINE)
    return _summary(last_windows(rows, ["s_2", "s_3"], RUL, 30, engine=MACHINE))


@query(
    f"""WITH {SUBSETS_SQL}
SELECT dataset, engine_id, "cycle", round(avg(s_2) OVER w, 6) AS s_2_roll5_mean, round(coalesce(stddev_samp(s_2) OVER w, 0.0), 4) AS s_2_roll5_std
FROM panel WINDOW w AS (PARTITION BY dataset, engine_id ORDER BY "cycle" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""
)
def multi_subset_rolling(spark: SparkSession, folder: str) -> DataFrame:
    rolled = add_rolling(subset_panel(spark, folder), ["s_2"], (5,), engine=MACHINE)
    rolled = rolled.select(DATASET, ENGINE, CYCLE, "s_2_roll5_mean", "s_2_roll5_std")
    return rounded(rounded(rolled, ["s_2_roll5_mean"], 6), ["s_2_roll5_std"], 4)
