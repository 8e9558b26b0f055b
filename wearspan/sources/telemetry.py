"""Readers for sensor logs and official remaining-life files in plain text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearspan.functions.rul import present
from wearspan.operators.skew import with_position
from wearspan.schema import ENGINE, SUBSETS, TELEMETRY


@dataclass(frozen=True)
class PanelTriple:
    """Train panel, censored test panel, and final remaining life per test engine."""

    train: DataFrame
    test: DataFrame
    final_rul: DataFrame


def _fields(line: str = "value"):
    return F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " ")


def read_sensor_log(spark: SparkSession, path: str | list[str], schema: T.StructType = TELEMETRY) -> DataFrame:
    """Read header-less, whitespace-separated rows: engine, cycle, settings, sensors.

    Any run of blanks separates fields, blank lines are skipped, missing trailing
    fields are null, and so is NaN. A missing path is Spark's path-not-found error.
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0).select(_fields().alias("_f"))

    def column(i: int, field: T.StructField):
        number = present(F.get("_f", F.lit(i)).cast("double"))
        return number.cast(field.dataType).alias(field.name)

    return lines.select(*[column(i, f) for i, f in enumerate(schema.fields)])


def read_final_rul(spark: SparkSession, path: str) -> DataFrame:
    """Read one remaining-life value per line; line n belongs to engine n.

    Lines are numbered inside each file block and shifted by the lines of the
    blocks before it, so a large file is still read in parallel. The part files of a
    folder count on in the order of their names.
    """
    lines = (
        spark.read.text(path)
        .select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("_line"))
        .where(F.length(F.trim("value")) > 0)
    )
    numbered = with_position(lines, [], [F.col("_line")], [F.col("file_path"), F.col("file_block_start")], "_n")
    first = F.element_at(_fields(), 1).cast("double").cast("int")
    return numbered.select(F.col("_n").cast("int").alias(ENGINE), first.alias("final_rul"))


def load_subset(spark: SparkSession, dataset: str, data_root: str) -> PanelTriple:
    """Read one named subset from ``train_*.txt``, ``test_*.txt`` and ``RUL_*.txt``."""
    name = dataset.upper()
    if name not in SUBSETS:
        raise ValueError(f"unknown subset {name}; choose from {SUBSETS}")
    root = data_root.rstrip("/")
    return PanelTriple(
        read_sensor_log(spark, f"{root}/train_{name}.txt"),
        read_sensor_log(spark, f"{root}/test_{name}.txt"),
        read_final_rul(spark, f"{root}/RUL_{name}.txt"),
    )


def load_subsets(spark: SparkSession, datasets: Sequence[str], data_root: str) -> PanelTriple:
    """Several subsets at once, told apart by a ``dataset`` column."""
    if not datasets:
        raise ValueError("name at least one subset")
    parts = [(name.upper(), load_subset(spark, name, data_root)) for name in datasets]

    def stacked(pick) -> DataFrame:
        frames = [pick(triple).withColumn("dataset", F.lit(name)) for name, triple in parts]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    return PanelTriple(stacked(lambda t: t.train), stacked(lambda t: t.test), stacked(lambda t: t.final_rul))


def with_notebook_names(df: DataFrame) -> DataFrame:
    """Rename the key columns to the exploratory naming."""
    return df.withColumnsRenamed({"engine_id": "unit_nr", "cycle": "time_cycles"})


def write_sensor_log(df: DataFrame, path: str, schema: T.StructType = TELEMETRY) -> None:
    """Write a panel in the text layout that ``read_sensor_log`` reads."""
    cells = [F.coalesce(F.col(f.name).cast("string"), F.lit("NaN")) for f in schema.fields]
    df.select(F.concat_ws(" ", *cells).alias("value")).write.text(path)
