"""The physical plans are the ones the scale notes promise."""

from pyspark.sql import functions as F

from wearspan.operators.labels import join_last_cycle, label_train
from wearspan.operators.rolling import roll
from wearspan.operators.sequences import cut_windows
from wearspan.operators.skew import profile_key, split_panel
from wearspan.sources.tables import TELEMETRY_ACTIVE, table, telemetry

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_labels_rolling_and_windows_share_one_exchange(spark):
    source = telemetry(spark, FOLDER)
    panel = roll(label_train(split_panel(source.rows, 38, source.profile)), TELEMETRY_ACTIVE)
    for stride in (1, 10):
        text = plan(cut_windows(panel, TELEMETRY_ACTIVE, size=30, stride=stride))
        assert text.count("Exchange hashpartitioning") == 1


def test_a_split_panel_adds_no_union_and_keeps_one_exchange(spark, tmp_path):
    path = str(tmp_path / "panel")
    telemetry(spark, FOLDER).rows.write.parquet(path)
    stored = spark.read.parquet(path)
    profile = profile_key(stored, rows_per_task=200)
    assert profile.heavy is not None and profile.dense
    panel = roll(label_train(split_panel(stored, 38, profile, 200)), TELEMETRY_ACTIVE)
    text = plan(cut_windows(panel, TELEMETRY_ACTIVE, size=30))
    assert text.count("Exchange hashpartitioning") == 1 and "Union" not in text
    assert "BroadcastHashJoin" in text and "CartesianProduct" not in text


def test_only_needed_columns_are_read(spark):
    rows = telemetry(spark, FOLDER).rows
    text = plan(rows.agg(F.avg("s_2")))
    assert "l_tax" not in text and "l_extendedprice" not in text


def test_small_lookup_moves_no_rows(spark):
    rows = table(spark, FOLDER, "lineitem").select(F.col("l_suppkey").alias("engine_id"), F.col("l_linenumber").alias("cycle"))
    text = plan(join_last_cycle(rows))
    assert "BroadcastHashJoin" in text
    # The only shuffle is that of the partial maxima.
    assert text.count("Exchange hashpartitioning") == 1
