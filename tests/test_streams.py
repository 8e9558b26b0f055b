"""Streaming ingest, alerts and trailing statistics on readings that come late, twice and in parts."""

import shutil

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wearspan.operators.rolling import add_rolling
from wearspan.streaming.alerts import alerts_of, read_alerts, start_alerts, write_batch
from wearspan.streaming.ingest import start_ingest
from wearspan.streaming.trailing import advance, start_trailing

READING = "engine_id INT, cycle INT, observed_at TIMESTAMP, s_2 DOUBLE"


def arrive(spark, path, rows, schema=READING):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_ingest_keeps_each_reading_once(spark, tmp_path):
    import datetime as dt

    home = str(tmp_path)
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    batches = [
        [(1, 1, at(0), 1.0), (1, 1, at(0), 1.0), (1, 2, at(5), 2.0), (2, 1, at(1), 5.0)],
        [(1, 2, at(5), 2.0), (1, 3, at(20), 3.0), (None, 1, at(6), 9.0), (4, 1, None, 9.0)],
        [(1, 1, at(0), 1.0), (2, 2, at(90), 6.0)],
        [(1, 4, at(200), 4.0), (2, 1, at(1), 5.0)],
    ]
    for rows in batches:
        arrive(spark, f"{home}/in", rows)
        start_ingest(spark.readStream.schema(READING).parquet(f"{home}/in"), f"{home}/out", f"{home}/state", lateness="60 minutes", once=True).awaitTermination()
    got = sorted((r["engine_id"], r["cycle"]) for r in spark.read.parquet(f"{home}/out").collect())
    assert got == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2)]


def test_replayed_alerts_stand_once(spark, tmp_path):
    home, schema = str(tmp_path), "engine_id INT, rul_prediction DOUBLE"
    for rows in ([(1, 30.0), (2, 10.0), (3, float("nan")), (4, None)], [(1, 5.0), (5, 20.0)]):
        arrive(spark, f"{home}/in", rows, schema)
        start_alerts(spark.readStream.schema(schema).parquet(f"{home}/in"), 20.0, f"{home}/history", f"{home}/state", once=True).awaitTermination()
    shape = spark.createDataFrame([], schema).schema
    want = [(2, 10.0, 20.0, 0), (1, 5.0, 20.0, 1)]
    assert sorted(map(tuple, read_alerts(spark, f"{home}/history", shape).collect())) == sorted(want)
    # the query stopped before it could note that its last batch was done
    for name in ("commits/1", "commits/.1.crc"):
        (tmp_path / "state" / name).unlink()
    start_alerts(spark.readStream.schema(schema).parquet(f"{home}/in"), 20.0, f"{home}/history", f"{home}/state", once=True).awaitTermination()
    assert sorted(map(tuple, read_alerts(spark, f"{home}/history", shape).collect())) == sorted(want)
    # or while it wrote: the folder is there, the rows are not
    shutil.rmtree(tmp_path / "history" / "batch=1")
    again = alerts_of(spark.createDataFrame([(1, 5.0), (5, 20.0)], schema), 20.0)
    for _ in range(2):
        write_batch(f"{home}/history")(again, 1)
    assert sorted(map(tuple, read_alerts(spark, f"{home}/history", shape).collect())) == sorted(want)


def test_trailing_replay_equals_rolling(spark, tmp_path):
    home, rng = str(tmp_path), np.random.default_rng(4)
    rows = [(e, c, float(rng.normal()) if rng.random() > 0.1 else float("nan")) for e in range(1, 6) for c in range(1, 4 + 7 * e)]
    schema = "engine_id INT, cycle INT, s_2 DOUBLE"
    for low, high in ((0, 4), (4, 5), (5, 20), (20, 99)):
        part = [r for r in rows if low < r[1] <= high]
        late = [r for r in rows if r[1] == low - 1][:2] + part[:1]  # behind the last cycle, and sent twice
        arrive(spark, f"{home}/in", [part[i] for i in rng.permutation(len(part))] + late, schema)
        readings = spark.readStream.schema(schema).parquet(f"{home}/in")
        start_trailing(readings, ["s_2"], f"{home}/out", f"{home}/state", (3, 5), once=True).awaitTermination()
    out = spark.read.parquet(f"{home}/out")
    names = [f"s_2_roll{n}_{k}" for n in (3, 5) for k in ("mean", "std")]
    got = out.where("NOT late").select("engine_id", "cycle", *[F.round(F.nanvl(n, F.lit(None).cast("double")), 9) for n in names])
    want = add_rolling(spark.createDataFrame(rows, schema), ["s_2"], (3, 5)).select("engine_id", "cycle", *[F.round(n, 9) for n in names])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert out.where("late").count() >= 4


def test_state_stays_small():
    rows = pd.DataFrame({"engine_id": 1, "cycle": range(1, 1001), "s_2": 1.0})
    out, last, ring = advance(rows, None, np.zeros((0, 1)), ["s_2"], (5, 10))
    assert len(out) == 1000 and last == 1000 and ring.shape == (9, 1)
    out, last, ring = advance(rows.head(3), last, ring, ["s_2"], (5, 10))
    assert out["late"].all() and last == 1000 and ring.shape == (9, 1)
