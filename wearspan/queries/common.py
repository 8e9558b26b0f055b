"""Frames that several registered queries start from."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.labels import add_test_rul, add_train_rul
from wearspan.operators.skew import KeyProfile, attach, split_panel
from wearspan.schema import CYCLE, ENGINE
from wearspan.sources.tables import is_test, supplier_final_rul, telemetry


def rounded(df: DataFrame, columns: Iterable[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def round_metrics(df: DataFrame) -> DataFrame:
    return rounded(rounded(df, ["rmse", "mae", "r2"], 6), ["nasa_score"], 2)


def labelled(spark: SparkSession, folder: str) -> tuple[DataFrame, KeyProfile]:
    """Telemetry with run-to-failure labels."""
    source = telemetry(spark, folder)
    return add_train_rul(source.rows, profile=source.profile), source.profile


@dataclass(frozen=True)
class SplitPanels:
    train: DataFrame
    test: DataFrame
    train_profile: KeyProfile
    test_profile: KeyProfile

    def both(self) -> DataFrame:
        train = self.train.withColumn("split", F.lit("train"))
        return train.unionByName(self.test.withColumn("split", F.lit("test")))


def split_panels(spark: SparkSession, folder: str) -> SplitPanels:
    """Labelled train engines, and test engines cut off before they fail."""
    source = telemetry(spark, folder)
    final = supplier_final_rul(spark, folder)
    panel = split_panel(source.rows, 0, source.profile)
    whole = panel.select(*panel.columns, panel.last_cycle.alias("_end")).frame()
    train = whole.where(~is_test()).drop("_end")
    cut = attach(whole.where(is_test()), final, ENGINE, "left", source.profile)
    lacking = F.raise_error(F.concat(F.lit("no official remaining life for engine "), F.col(ENGINE).cast("string")))
    life = F.coalesce(F.col("final_rul").cast("int"), lacking.cast("int"))
    test = cut.where(F.col(CYCLE) <= F.col("_end") - life).drop("_end", "final_rul")
    test_profile = source.profile
    if test_profile.heavy is not None:
        ends = test_profile.heavy.join(final, ENGINE).withColumn("_last", F.col("_last") - F.col("final_rul"))
        test_profile = replace(test_profile, heavy=ends.drop("final_rul"))
    return SplitPanels(
        add_train_rul(train, profile=source.profile),
        add_test_rul(test, final, profile=test_profile, check=False),
        source.profile,
        test_profile,
    )
