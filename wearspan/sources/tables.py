"""Panel views over the given Parquet tables, so the operators have data to run on.

``lineitem`` becomes telemetry: a supplier is an engine, its shipments in date
order are the cycles, return flag and line status are the settings (six operating
regimes), and quantity, price, discount and tax are sensors. ``events`` becomes a
second panel with short histories, one engine per user.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.skew import ROWS_PER_TASK, KeyProfile, profile_key, rank_within
from wearspan.schema import CYCLE, ENGINE

TELEMETRY_SENSORS = ["s_1", "s_2", "s_3", "s_4", "s_7"]
TELEMETRY_ACTIVE = ["s_2", "s_3", "s_4", "s_7"]
EVENT_SENSORS = ["s_2", "s_3"]
DATASET = "dataset"
#: What names a machine in a panel of several subsets: engine numbers repeat between them.
MACHINE = (DATASET, ENGINE)

# What the adapters put in place of real settings and labels.
CONSTANT_SETTING = 100.0
CONSTANT_SENSOR = 518.67
TEST_EVERY = 5
SHORTEST_FINAL_RUL = 20
FINAL_RUL_SPREAD = 100
# Order keys of one supplier and day are ranked in runs of this width when split.
ORDER_RUN = 2**28


@dataclass(frozen=True)
class PanelSource:
    """A panel with the measured profile of its engine key."""

    rows: DataFrame
    profile: KeyProfile


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def telemetry(spark: SparkSession, folder: str, rows_per_task: int = ROWS_PER_TASK) -> PanelSource:
    """The telemetry panel; keeps the ship date as ``observed_on``."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("int").alias(ENGINE),
        "l_shipdate",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0).alias("setting_1"),
        F.when(F.col("l_linestatus") == "F", 0.0).otherwise(1.0).alias("setting_2"),
        F.lit(CONSTANT_SETTING).alias("setting_3"),
        F.lit(CONSTANT_SENSOR).alias("s_1"),
        F.col("l_quantity").alias("s_2"),
        F.col("l_extendedprice").alias("s_3"),
        F.col("l_discount").alias("s_4"),
        F.col("l_tax").alias("s_7"),
    )
    profile = profile_key(lines, ENGINE, None, rows_per_task)
    order = [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")]
    bucket = [F.col("l_shipdate"), F.floor(F.col("l_orderkey") / F.lit(ORDER_RUN))]
    ranked = rank_within(lines, ENGINE, order, bucket, "_cycle", profile)
    rows = ranked.select(
        ENGINE,
        F.col("_cycle").cast("int").alias(CYCLE),
        "setting_1",
        "setting_2",
        "setting_3",
        *TELEMETRY_SENSORS,
        F.col("l_shipdate").cast("date").alias("observed_on"),
    )
    return PanelSource(rows, profile)


def telemetry_events(spark: SparkSession, folder: str, rows_per_task: int = ROWS_PER_TASK) -> PanelSource:
    """The events panel: 45 to 99 cycles per engine in the given data."""
    events = table(spark, folder, "events").select(
        F.col("user_id").cast("int").alias(ENGINE),
        "ts",
        "event_id",
        F.hour("ts").cast("double").alias("setting_1"),
        F.col("value").alias("s_2"),
        F.get_json_object("props", "$.k").cast("double").alias("s_3"),
    )
    profile = profile_key(events, ENGINE, None, rows_per_task)
    bucket = [F.date_trunc("minute", "ts")]
    ranked = rank_within(events, ENGINE, [F.col("ts"), F.col("event_id")], bucket, "_cycle", profile)
    rows = ranked.select(ENGINE, F.col("_cycle").cast("int").alias(CYCLE), "setting_1", "s_2", "s_3")
    return PanelSource(rows, profile)


def subset_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Two subsets in one panel, told apart by ``dataset``: telemetry and events, with the two sensors that both have."""
    parts = {"FD001": telemetry(spark, folder).rows, "FD002": telemetry_events(spark, folder).rows}
    first, second = (rows.select(F.lit(name).alias(DATASET), ENGINE, CYCLE, *EVENT_SENSORS) for name, rows in parts.items())
    return first.unionByName(second)


def subset_final_rul(spark: SparkSession, folder: str) -> DataFrame:
    """Official final life per machine of ``subset_panel``; a third of the second subset's machines have none."""
    users = table(spark, folder, "events").select(F.col("user_id").cast("int").alias(ENGINE)).distinct()
    second = users.where(F.col(ENGINE) % 3 != 0).select(F.lit("FD002").alias(DATASET), ENGINE, (F.col(ENGINE) % 50).alias("final_rul"))
    return supplier_final_rul(spark, folder).select(F.lit("FD001").alias(DATASET), ENGINE, "final_rul").unionByName(second)


def is_test(engine: str = ENGINE) -> Column:
    """The train/test split by engine; both sides are always kept and labelled."""
    return F.col(engine) % TEST_EVERY == 0


def final_rul_of(engine: str = ENGINE) -> Column:
    return (SHORTEST_FINAL_RUL + F.col(engine) % FINAL_RUL_SPREAD).cast("int")


def supplier_final_rul(spark: SparkSession, folder: str) -> DataFrame:
    """Official final remaining life per engine, from the supplier table."""
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("int").alias(ENGINE))
    return suppliers.select(ENGINE, final_rul_of().alias("final_rul"))


def regime_of() -> Column:
    """Regime id straight from the settings: six values."""
    return (F.col("setting_1") * 2 + F.col("setting_2")).cast("int")
