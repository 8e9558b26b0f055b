import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import keyed, panel_rows
from wearspan.functions.rul import clean
from wearspan.operators import explore, normalize as norm
from wearspan.operators.labels import add_train_rul
from wearspan.operators.regimes import fit_regimes
from wearspan.plans.features import FeatureConfig, build_features
from wearspan.schema import FLAT_SENSORS, REGIME, SETTINGS, TELEMETRY, active_sensors, model_features


def test_feature_names_and_no_missing_values(tiny):
    labelled = add_train_rul(tiny)
    made = build_features(labelled, labelled, FeatureConfig(rolling_windows=(3,)))
    assert "s_1" not in made.train.columns
    assert {"s_2_roll3_mean", "s_2_roll3_std"} <= set(made.train.columns)
    bad = explore.quality_profile(made.train, made.feature_columns).agg(F.sum("n_bad")).first()[0]
    assert bad == 0
    assert made.train.columns == ["engine_id", "cycle", *made.feature_columns, "rul"]


def test_default_feature_count(tiny):
    labelled = add_train_rul(tiny)
    made = build_features(labelled, labelled)
    assert len(model_features(made.train.columns)) == 73
    assert len(active_sensors()) == 14 and not set(FLAT_SENSORS) & set(active_sensors())


def test_scaling_matches_numpy_and_leaves_settings(tiny):
    labelled = add_train_rul(tiny)
    made = build_features(labelled, labelled, FeatureConfig(rolling_windows=()))
    raw = labelled.orderBy("engine_id", "cycle").toPandas()
    out = made.train.orderBy("engine_id", "cycle").toPandas()
    want = (raw["s_2"] - raw["s_2"].mean()) / raw["s_2"].std()
    np.testing.assert_allclose(out["s_2"], want, atol=1e-9)
    assert list(out["setting_1"]) == list(raw["setting_1"])


@pytest.mark.parametrize("rows_per_task", [None, 2])
def test_regime_means_are_centred(spark, rows_per_task):
    rows = panel_rows([1, 2], 5) + panel_rows([3, 4], 5, shift=50.0)
    labelled = add_train_rul(spark.createDataFrame(rows, TELEMETRY))
    extra = {"rows_per_task": rows_per_task} if rows_per_task else {}
    made = build_features(
        labelled, labelled, FeatureConfig(rolling_windows=(), normalize_by_regime=True, n_regimes=2, **extra)
    )
    means = made.train.groupBy(REGIME).agg(F.avg("s_2").alias("m")).collect()
    assert len(means) == 2 and all(abs(r["m"]) < 1e-6 for r in means)
    assert made.feature_columns[0] == REGIME and REGIME not in model_features(made.train.columns)


def test_unseen_regime_uses_global_statistics(spark):
    train = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0), (1, 10.0)], f"{REGIME} int, x double")
    test = spark.createDataFrame([(0, 2.0), (1, 11.0), (7, 6.0)], f"{REGIME} int, x double")
    stats = norm.fit_normalization(train, ["x"], by_regime=True)
    got = {r[0]: r[1] for r in norm.normalize(test, stats).collect()}
    everything = np.array([1.0, 3.0, 10.0, 10.0])
    assert got[0] == pytest.approx(0.0)
    assert got[1] == pytest.approx(1.0)  # a flat regime is divided by one
    assert got[7] == pytest.approx((6.0 - everything.mean()) / everything.std(ddof=1))


def test_large_regime_table_is_joined_lazily(spark, monkeypatch):
    monkeypatch.setattr(norm, "SMALL_TABLE", 1)
    train = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 4.0), (1, 8.0)], f"{REGIME} int, x double")
    stats = norm.fit_normalization(train, ["x"], by_regime=True)
    assert not stats.small
    scored = [r[1] for r in norm.normalize(train, stats).orderBy("x").collect()]
    np.testing.assert_allclose(scored, [-(0.5**0.5)] * 2 + [0.5**0.5] * 2)
    assert stats.means["x"] == 4.0


def test_constant_and_single_row_columns(spark):
    one = spark.createDataFrame([(5.0,)], "x double")
    stats = norm.fit_normalization(one, ["x"])
    assert stats.stds["x"] == 1.0 and norm.normalize(one, stats).first()[0] == 0.0


def test_clean_replaces_every_bad_value(spark):
    rows = [(None,), (float("nan"),), (float("inf"),), (float("-inf"),), (-2.5,), (0.0,)]
    df = spark.createDataFrame(rows, "x double").select(clean(F.col("x")).alias("x"))
    assert [r[0] for r in df.collect()] == [0.0, 0.0, 0.0, 0.0, -2.5, 0.0]


def test_regimes_are_numbered_by_centre(spark):
    points = [(float(a), float(b), 100.0) for a in range(3) for b in range(2)]
    rows = [(i, *p) for i in range(4) for p in points]
    df = spark.createDataFrame(rows, "i int, setting_1 double, setting_2 double, setting_3 double")
    ids = fit_regimes(df, 6, n_init=5).assign(df).select(*SETTINGS, REGIME).distinct().collect()
    assert {(r[0], r[1]): r[3] for r in ids} == {(a, b): int(a * 2 + b) for a, b, _ in points}


def test_hot_regime_in_a_large_table(spark, monkeypatch):
    """Ninety of a hundred rows in one regime: the same scores, and no task with much more than its share."""
    n = 40_000
    regime = F.when(F.col("id") % 10 < 9, 0).when(F.col("id") % 50 == 9, None).otherwise(F.col("id") % 997).cast("int")
    df = spark.range(n).select("id", regime.alias(REGIME), (F.col("id") % 113).cast("double").alias("s_2"))
    stats = norm.fit_normalization(df, ["s_2"], True)
    monkeypatch.setattr(norm, "SMALL_TABLE", 5)
    large = norm.fit_normalization(df, ["s_2"], True)
    assert stats.small and not large.small
    want = {r["id"]: r["s_2"] for r in norm.normalize(df, stats).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = norm.normalize(df, large).withColumn("_task", F.spark_partition_id()).toPandas()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        large.regimes.unpersist()
    assert len(got) == n and list(got.columns) == ["id", REGIME, "s_2", "_task"]
    np.testing.assert_allclose(got["s_2"], got["id"].map(want), atol=1e-12)
    sizes = got.groupby("_task").size()
    assert sizes.max() <= 3 * sizes.median()


def test_regimes_of_continuous_settings(spark):
    """A planted mixture: the same centres however the points are spread, near the planted ones."""
    planted = np.array([(0.0, 0.0, 100.0), (10.0, 0.2, 100.0), (20.0, 0.7, 100.0), (25.0, 0.6, 60.0), (35.0, 0.8, 100.0), (42.0, 0.8, 60.0)])
    rng = np.random.default_rng(11)
    kind = rng.choice(6, 3000, p=[0.4, 0.2, 0.1, 0.1, 0.1, 0.1])
    points = planted[kind] + rng.normal(0, [0.3, 0.01, 0.3], (3000, 3))
    df = spark.createDataFrame([(int(k), *map(float, p)) for k, p in zip(kind, points)], "kind int, setting_1 double, setting_2 double, setting_3 double")
    fits = [fit_regimes(df.repartition(n)) for n in (3, 50)]
    np.testing.assert_allclose(fits[0].centres, fits[1].centres, atol=1e-9)
    np.testing.assert_allclose(fits[0].centres, [points[kind == k].mean(axis=0) for k in range(6)], atol=1e-6)
    got = fits[0].assign(df).select("kind", REGIME).distinct().collect()
    assert sorted((r[0], r[1]) for r in got) == [(k, k) for k in range(6)]


def test_regimes_of_odd_rows(spark):
    schema = "setting_1 double, setting_2 double, setting_3 double"
    odd = [(None, 1.0, 1.0), (float("nan"), 1.0, 1.0), (float("inf"), 1.0, 1.0)]
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (1.0, 1.0, 1.0), (5.0, 1.0, 1.0), *odd], schema)
    model = fit_regimes(df)
    assert model.centres == ((1.0, 1.0, 1.0), (5.0, 1.0, 1.0))
    assert [r[0] for r in model.assign(df).select(REGIME).collect()] == [0, 0, 1, None, None, None]
    with pytest.raises(ValueError, match="finite"):
        fit_regimes(spark.createDataFrame(odd, schema))


def test_exploration(spark, tiny):
    flat = tiny.withColumn("s_1", F.lit(1.5))
    labelled = add_train_rul(flat, cap=None)
    assert [r["sensor"] for r in explore.flat_sensors(labelled, ["s_1", "s_2"]).collect()] == ["s_1"]
    corr = {r["sensor"]: r["correlation"] for r in explore.rul_correlation(labelled, ["s_1", "s_2"]).collect()}
    pdf = labelled.toPandas()
    assert corr["s_1"] is None and corr["s_2"] == pytest.approx(pdf["s_2"].corr(pdf["rul"]))
    lives = {r["engine_id"]: r["max_cycle"] for r in explore.engine_lives(tiny).collect()}
    assert lives == {1: 5, 2: 5}
    assert keyed(tiny, "s_2")[(2, 3)] == 204.0


def test_values_that_are_no_numbers_are_skipped(spark):
    rows = [(1, c, 1.0, float("nan") if c == 3 else float(c)) for c in range(1, 6)]
    df = spark.createDataFrame(rows, "engine_id int, cycle int, setting_1 double, s_2 double").withColumn("operating_regime", F.lit(0))
    for by_regime in (False, True):
        stats = norm.fit_normalization(df, ["s_2"], by_regime)
        assert stats.means["s_2"] == 3.0 and abs(stats.stds["s_2"] - 1.8257418583505538) < 1e-9
    from wearspan.operators.rolling import add_rolling

    rolled = {r["cycle"]: (r["s_2_roll2_mean"], r["s_2_roll2_std"]) for r in add_rolling(df, ["s_2"], (2,)).collect()}
    assert rolled[3] == (2.0, 0.0) and rolled[4] == (4.0, 0.0) and rolled[5] == (4.5, 0.7071067811865476)
