"""Sensor readings as they arrive, each kept once.

A reading that is sent again within ``lateness`` of its first arrival, counted in event time, is
dropped; Spark forgets a reading's key once the watermark has passed it by that much, so
the state holds the keys of that span and no more. A reading older than the watermark itself is
dropped as too late. Readings without a time or with an empty key column can't be told from
repeats and don't pass; ``complete`` is the condition, so that a caller can write them elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wearspan.schema import CYCLE, ENGINE

OBSERVED = "observed_at"


def complete(keys: Sequence[str] = (ENGINE, CYCLE), time: str = OBSERVED):
    """True for readings that have a time and all key columns."""
    whole = F.col(time).isNotNull()
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    return whole


def deduplicated(
    readings: DataFrame, keys: Sequence[str] = (ENGINE, CYCLE), time: str = OBSERVED, lateness: str = "1 hour"
) -> DataFrame:
    """The complete readings of a stream, the first of each key within the watermark."""
    stamped = readings.where(complete(keys, time)).withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def start_ingest(
    readings: DataFrame,
    output_path: str,
    checkpoint_path: str,
    keys: Sequence[str] = (ENGINE, CYCLE),
    time: str = OBSERVED,
    lateness: str = "1 hour",
    once: bool = False,
) -> StreamingQuery:
    """Append the deduplicated readings as Parquet; the file sink commits each batch once."""
    writer = deduplicated(readings, keys, time, lateness).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start(output_path)
