"""Rolling columns in batches: the very numbers of Spark's sliding frames, without evaluating them."""

import random
import struct

from wearspan.operators import rolling
from wearspan.operators.skew import profile_key, split_panel
from wearspan.plans.features import FeatureConfig, build_features

ODD = [None, float("nan"), float("inf"), -0.0, 0.1, 0.1, 0.1, 1e5]


def made_rows():
    draw = random.Random(1)
    rows = [(e, c, draw.choice(ODD), draw.uniform(-1e5, 1e5), draw.randrange(9)) for e in [None, *range(1, 40)] for c in range(1, (e or 3) * 3)]
    draw.shuffle(rows)
    return rows


def panel(spark):
    return spark.createDataFrame(made_rows(), "engine_id int, cycle int, s_2 double, s_3 double, s_4 int").repartition(5)


def bits(df):
    plain = lambda v: "nan" if v != v else struct.pack("d", v) if isinstance(v, float) else v
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)


def test_the_same_bits_as_sliding_frames(spark):
    df = panel(spark)
    for profile, size in ((None, 2_000_000), (profile_key(df, rows_per_task=16), 16)):
        split = split_panel(df, 9, profile, size)
        was = rolling.roll(split, ["s_2", "s_3", "s_4"]).frame()
        now = rolling.rolled_frame(split, ["s_2", "s_3", "s_4"])
        assert now.columns == was.columns and bits(now) == bits(was)


def test_small_batches_carry_rows_over(spark):
    split = split_panel(panel(spark), 9)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert bits(rolling.rolled_frame(split, ["s_2", "s_3"])) == bits(rolling.roll(split, ["s_2", "s_3"]).frame())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_frames_slide_nowhere(spark):
    df = spark.createDataFrame([(1, c, 1.0 * c, 0.0, 0.0, 0.0, 5) for c in range(1, 5)], "engine_id int, cycle int, s_2 double, setting_1 double, setting_2 double, setting_3 double, rul int")
    for frame in (rolling.add_rolling(df, ["s_2"]), build_features(df, df, FeatureConfig()).train):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in text and "stddev_samp" not in text and text.count("Exchange hashpartitioning") == 1
