import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearspan.operators import splits
from wearspan.operators.metrics import early_stopping, evaluate, metrics_dict, ranked_leaderboard, weighted_mean
from wearspan.operators.splits import background_sample, exact_holdout, expand_grid, grid_frame, with_holdout


def scored(spark, truth, predicted):
    return spark.createDataFrame([(float(a), float(b)) for a, b in zip(truth, predicted)], "rul double, prediction double")


def test_late_errors_cost_more(spark):
    early = metrics_dict(scored(spark, [100], [90]))["nasa_score"]
    late = metrics_dict(scored(spark, [100], [110]))["nasa_score"]
    assert early == pytest.approx(math.exp(10 / 13) - 1) and late == pytest.approx(math.e - 1) and late > early


def test_metric_values(spark):
    got = metrics_dict(scored(spark, [1, 2, 3], [1, 2.5, 2]))
    assert set(got) == {"rmse", "mae", "r2", "nasa_score"}
    assert got["rmse"] == pytest.approx(math.sqrt(1.25 / 3)) and got["mae"] == pytest.approx(0.5)
    assert got["r2"] == pytest.approx(1 - 1.25 / 2)


def test_r2_of_constant_truth_and_single_rows(spark):
    assert metrics_dict(scored(spark, [4, 4], [4, 4]))["r2"] == 1.0
    assert metrics_dict(scored(spark, [0.1] * 10, [1.0] * 10))["r2"] == 0.0
    assert metrics_dict(scored(spark, [4], [3]))["r2"] is None


def test_grouped_metrics(spark):
    df = scored(spark, [1, 2, 10, 20], [1, 2, 11, 22]).withColumn("g", F.col("rul") >= 10)
    got = {r["g"]: (r["n"], r["mae"]) for r in evaluate(df, ["g"]).collect()}
    assert got == {False: (2, 0.0), True: (2, 1.5)}


def test_weighted_mean(spark):
    df = spark.createDataFrame([(1.0, 3), (5.0, 1)], "loss double, n int")
    assert df.agg(weighted_mean(F.col("loss"), F.col("n"))).first()[0] == pytest.approx(2.0)
    assert df.limit(0).agg(weighted_mean(F.col("loss"), F.col("n"))).first()[0] == 0.0


def test_early_stopping(spark):
    losses = [5.0, 4.0, 4.5, 4.2, 4.1, 3.0]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(losses, 1)], "run string, epoch int, validation_loss double")
    got = early_stopping(df, ["run"], patience=3).orderBy("epoch").collect()
    assert [r["epochs_since_best"] for r in got] == [0, 0, 1, 2, 3, 0]
    assert [r["best_loss"] for r in got] == [5.0, 4.0, 4.0, 4.0, 4.0, 3.0]
    assert [r["stopped_before"] for r in got] == [False] * 5 + [True]


def test_leaderboard_ranks(spark):
    rows = [("a", "FD001", 2.0, 1.0, 0.8, 10.0), ("b", "FD001", 1.0, 2.0, 0.9, 10.0)]
    df = spark.createDataFrame(rows, "model_name string, dataset string, rmse double, mae double, r2 double, nasa_score double")
    got = {r["model_name"]: (r["rmse_rank"], r["mae_rank"], r["r2_rank"], r["nasa_score_rank"]) for r in ranked_leaderboard(df).collect()}
    assert got == {"a": (2, 1, 2, 1), "b": (1, 2, 1, 1)}


def rows(spark, engines=7, cycles=40):
    return spark.range(engines * cycles).select(
        (F.col("id") % engines).cast("int").alias("engine_id"), (F.floor(F.col("id") / engines) + 1).cast("int").alias("cycle")
    )


def test_hash_holdouts(spark):
    marked = with_holdout(rows(spark), 20).toPandas()
    assert 0.1 < marked["is_validation"].mean() < 0.3
    whole = with_holdout(rows(spark), 50, "engine").toPandas().groupby("engine_id")["is_validation"].nunique()
    assert (whole == 1).all()
    with pytest.raises(ValueError, match="row"):
        with_holdout(rows(spark), by="cycle")


@pytest.mark.parametrize("fraction, expected", [(0.2, 56), (0.001, 1), (0.5, 140), (0.99, 277)])
def test_exact_holdout_size(spark, fraction, expected):
    got = exact_holdout(rows(spark), fraction).toPandas()
    assert len(got) == 280 and got["is_validation"].sum() == expected
    assert not got.duplicated(["engine_id", "cycle"]).any()


@pytest.mark.parametrize("radix", [3, 15])
def test_holdout_is_the_smallest_hashes(spark, monkeypatch, radix):
    monkeypatch.setattr(splits, "RADIX_BITS", radix)
    got = exact_holdout(rows(spark, 50, 80), 0.3).withColumn("h", splits.mixed_hash()).toPandas()
    assert got["is_validation"].sum() == 1200 and got["h"].nunique() == 4000
    assert got.loc[got["is_validation"], "h"].max() < got.loc[~got["is_validation"], "h"].min()
    digest = hashlib.md5(f"{got['engine_id'][0]}:{got['cycle'][0]}".encode()).hexdigest()
    assert got["h"][0] == int(digest[:15], 16)


def test_holdout_of_repeated_keys_is_exact(spark):
    repeated = rows(spark, 1, 3).crossJoin(spark.range(1000).withColumnRenamed("id", "copy"))
    for fraction in (0.1, 0.5, 0.9):
        got = exact_holdout(repeated, fraction).toPandas()
        assert len(got) == 3000 and got["is_validation"].sum() == int(3000 * fraction)
        assert not got.duplicated(["engine_id", "cycle", "copy"]).any()
    same = rows(spark, 1, 1).crossJoin(spark.range(10)).drop("id")
    assert exact_holdout(same, 0.3).where("is_validation").count() == 3


def test_holdout_of_many_keys_is_one_expression(spark):
    """A billion keys: the marks need neither an exchange nor a window."""
    many = spark.range(10**9).select((F.col("id") % 10**6).alias("engine_id"), F.floor(F.col("id") / 10**6).alias("cycle"))
    marked = splits._mark_smallest(many, splits.mixed_hash(), splits.HashCut(10**9, 2**57, 1, 1), "is_validation")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan


def test_exact_holdout_needs_two_rows(spark):
    with pytest.raises(ValueError, match="two rows"):
        exact_holdout(rows(spark, 1, 1))


def test_background_sample(spark):
    sample = background_sample(rows(spark), 25).toPandas()
    assert len(sample) == 25 and not sample.duplicated().any()
    assert background_sample(rows(spark), 1000).count() == 280
    again = background_sample(rows(spark).repartition(3), 25).toPandas()
    assert set(map(tuple, again.to_numpy())) == set(map(tuple, sample.to_numpy()))


def test_grid_order(spark):
    grid = {"a": [1, 2], "b": ["x", "y"]}
    want = [{"a": 1, "b": "x"}, {"a": 1, "b": "y"}, {"a": 2, "b": "x"}, {"a": 2, "b": "y"}]
    assert expand_grid(grid) == want
    lists = spark.createDataFrame([([1, 2], ["x", "y"])], "a array<int>, b array<string>")
    got = grid_frame(lists, ["a", "b"]).orderBy("ordinal").collect()
    assert [(r["ordinal"], r["a"], r["b"]) for r in got] == [(i, w["a"], w["b"]) for i, w in enumerate(want)]
    np.testing.assert_equal(len(expand_grid({"a": []})), 0)
