"""Queries that replay given tables through the streaming operators and read the answers back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.queries.common import rounded
from wearspan.queries.registry import EVENTS, TELEMETRY, query
from wearspan.schema import CYCLE, ENGINE
from wearspan.session import work_folder
from wearspan.sources.tables import table, telemetry, telemetry_events
from wearspan.streaming.alerts import read_alerts, start_alerts
from wearspan.streaming.ingest import start_ingest
from wearspan.streaming.trailing import start_trailing

#: Machines send their history in so many parts, one after the other.
PARTS = 3


@query(
    """SELECT CAST(user_id AS INTEGER) AS user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, value FROM events"""
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Events, each third one sent twice: the stream keeps each once. Files come in no order, so lateness covers the whole table."""
    home = work_folder(spark, "ingest")
    events = table(spark, folder, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    events.unionByName(events.where(F.col("event_id") % 3 == 0)).write.parquet(f"{home}/in")
    readings = spark.readStream.schema(events.schema).parquet(f"{home}/in")
    span = events.agg((F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))).alias("s")).first()["s"] or 0
    start_ingest(readings, f"{home}/out", f"{home}/state", ["user_id", "event_id"], "ts", f"{span + 1} seconds", once=True).awaitTermination()
    kept = spark.read.schema(events.schema).parquet(f"{home}/out")
    return kept.select(F.col("user_id").cast("int").alias("user_id"), "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "value")


@query(
    f"""WITH {EVENTS}
SELECT engine_id, "cycle", s_2 AS rul_prediction, CAST(20 AS DOUBLE) AS threshold FROM telemetry_events WHERE s_2 < 20"""
)
def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Readings under a threshold, in the history once although the last batch is processed twice."""
    home = work_folder(spark, "alerts")
    rows = telemetry_events(spark, folder).rows.select(ENGINE, CYCLE, F.col("s_2").alias("rul_prediction"))
    rows.write.parquet(f"{home}/in")
    for attempt in range(2):  # a second query without the first one's checkpoint replays its batches from number 0
        scored = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        start_alerts(scored, 20.0, f"{home}/history", f"{home}/state-{attempt}", once=True).awaitTermination()
    return read_alerts(spark, f"{home}/history", rows.schema).drop("batch")


@query(
    f"""WITH {TELEMETRY}
SELECT engine_id, "cycle", round(avg(s_2) OVER w, 6) AS s_2_roll5_mean, round(coalesce(stddev_samp(s_2) OVER w, 0.0), 4) AS s_2_roll5_std
FROM telemetry WINDOW w AS (PARTITION BY engine_id ORDER BY "cycle" ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""
)
def stream_trailing(spark: SparkSession, folder: str) -> DataFrame:
    """Every machine's history arrives in parts; the rows of a part end up as the batch operator has them."""
    home = work_folder(spark, "trailing")
    rows = telemetry(spark, folder).rows.select(ENGINE, CYCLE, "s_2")
    top = rows.agg(F.max(CYCLE)).first()[0] or 0
    for part in range(PARTS):
        mine = F.least(F.floor((F.col(CYCLE) - 1) * PARTS / (top + 1)), F.lit(PARTS - 1)) == part
        rows.where(mine).write.mode("append").parquet(f"{home}/in")
        readings = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
        start_trailing(readings, ["s_2"], f"{home}/out", f"{home}/state", (5,), once=True).awaitTermination()
    kept = spark.read.parquet(f"{home}/out").where("NOT late").drop("late")
    return rounded(rounded(kept, ["s_2_roll5_mean"], 6), ["s_2_roll5_std"], 4)
