"""Alerts on scored machines, kept as a history in which each alert stands once.

Every micro-batch writes its alerts into a folder named by the batch. A batch that is processed
again, because the query stopped between writing and committing it, replaces its own
folder, so a replay neither repeats nor loses alerts. Folders of batches without alerts are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

PREDICTION = "rul_prediction"
BATCH = "batch"


def below(threshold: float, prediction: str = PREDICTION) -> Column:
    """True where the predicted life is under the threshold; no prediction, or one that is no number, is no alert."""
    return F.coalesce((F.col(prediction) < threshold) & ~F.isnan(prediction), F.lit(False))


def alerts_of(scored: DataFrame, threshold: float, prediction: str = PREDICTION) -> DataFrame:
    return scored.where(below(threshold, prediction)).withColumn("threshold", F.lit(float(threshold)))


def write_batch(history_path: str):
    """The sink: what a batch holds is what its folder holds."""

    def write(alerts: DataFrame, batch: int) -> None:
        alerts.write.mode("overwrite").parquet(f"{history_path.rstrip('/')}/{BATCH}={batch}")

    return write


def start_alerts(
    scored: DataFrame, threshold: float, history_path: str, checkpoint_path: str, prediction: str = PREDICTION, once: bool = False
) -> StreamingQuery:
    """Watch a stream of scored rows and add what is under the threshold to the history."""
    writer = alerts_of(scored, threshold, prediction).writeStream.foreachBatch(write_batch(history_path))
    writer = writer.option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_alerts(spark: SparkSession, history_path: str, schema: StructType) -> DataFrame:
    """All alerts with the number of their batch; ``schema`` is that of the scored rows."""
    known = StructType([*schema.fields]).add("threshold", "double").add(BATCH, "long")
    return spark.read.schema(known).parquet(history_path)
