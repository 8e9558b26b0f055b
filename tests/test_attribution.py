import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearspan.operators import attribution as at


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=300), rng.normal(size=300)
    y = 3 * a - 2 * b + 7 + rng.normal(scale=0.1, size=300)
    data = [(i % 3, i // 3, float(a[i]), float(b[i]), float(y[i])) for i in range(300)]
    return spark.createDataFrame(data, "engine_id int, cycle int, a double, b double, rul double").cache()


@pytest.fixture(scope="module")
def fit(rows):
    return at.fit_linear(rows, ["a", "b"])


def test_linear_fit_is_least_squares(rows, fit):
    pdf = rows.toPandas()
    x = np.column_stack([pdf["a"], pdf["b"], np.ones(len(pdf))])
    want = np.linalg.lstsq(x, pdf["rul"], rcond=None)[0]
    np.testing.assert_allclose([*fit.coefficients, fit.intercept], want, atol=1e-8)
    np.testing.assert_allclose(fit.means, [pdf["a"].mean(), pdf["b"].mean()])


def test_contributions_add_up_and_rank(rows, fit):
    keys = ["engine_id", "cycle"]
    ranked = at.linear_attribution(rows, fit, keys)
    again = at.rank_attributions(ranked.drop("rank"), keys).select(*ranked.columns)
    assert again.exceptAll(ranked).count() == 0
    total = ranked.groupBy(*keys).agg(F.sum("value").alias("v"))
    joined = total.join(rows.select(*keys, fit.predict().alias("p")), keys).toPandas()
    np.testing.assert_allclose(joined["v"] + fit.base, joined["p"])
    built = at.waterfall(ranked.withColumnRenamed("running", "inside"), keys, fit.base)
    assert built.where(F.abs(F.col("running") - F.col("inside")) > 1e-9).count() == 0
    end = built.where("rank = 2").join(rows.select(*keys, fit.predict().alias("p")), keys).toPandas()
    np.testing.assert_allclose(end["running"], end["p"])
    first = ranked.groupBy(*keys).agg(F.max_by(F.abs("value"), -F.col("rank")).alias("top"), F.max(F.abs("value")).alias("big")).toPandas()
    assert (first["top"] == first["big"]).all()


def test_global_importance_and_top(rows, fit):
    parts = at.linear_attribution(rows, fit, ["engine_id", "cycle"])
    assert [r["feature"] for r in at.top_features(at.mean_importance(parts), 1).collect()] == ["a"]
    per_engine = at.mean_importance(parts, ["engine_id"])
    assert per_engine.count() == 6


def test_worst_sample_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([(2, 10.0, 5.0), (1, 0.0, 5.0), (3, 5.0, 5.0)], "engine_id int, rul double, prediction double")
    worst = at.worst_sample(df, ["engine_id"]).first()
    assert (worst["engine_id"], worst["abs_error"]) == (1, 5.0)


def test_explanation_record(rows, fit):
    keys = ["engine_id", "cycle"]
    records = at.explanation_records(rows, fit, keys, "linear", "FD001", background_n=100)
    record = json.loads(at.explanation_json(records, keys).first()["json"])
    assert set(record) == {
        "model_name", "dataset", "rul_prediction", "feature_importances", "shap_values_full", "explanation_metadata",
    }
    sizes = list(record["feature_importances"].values())
    assert sizes == sorted(sizes, reverse=True) and record["shap_values_full"] is None
    meta = record["explanation_metadata"]
    assert meta["explainer_type"] == "LinearExplainer" and meta["background_n"] == 100 and len(meta["shap_values_1d"]) == 2


def test_window_attribution(spark):
    rng = np.random.default_rng(2)
    cells = rng.normal(size=(60, 3, 2)).round(3)
    target = cells[:, 2, 0] * 4 + 1
    data = [(i, cells[i].tolist(), float(target[i])) for i in range(60)]
    windows = spark.createDataFrame(data, "engine_id int, window array<array<float>>, target float")
    fit = at.fit_window_linear(windows, 3, ["s_2", "s_3"])
    scored = at.score_windows(windows, fit).toPandas()
    np.testing.assert_allclose(scored["prediction"], target, atol=1e-3)
    parts = at.window_attribution(windows, fit, ["s_2", "s_3"], ["engine_id"])
    assert parts.count() == 60 * 6
    total = parts.groupBy("engine_id").agg(F.sum("value").alias("v")).orderBy("engine_id").toPandas()
    np.testing.assert_allclose(total["v"] + fit.base, scored.sort_values("engine_id")["prediction"], atol=1e-9)
    strongest = at.mean_importance(parts.where("timestep = 2")).orderBy(F.desc("importance")).first()
    assert strongest["feature"] == "s_2"


def test_shuffled_values_do_not_depend_on_cells(rows):
    few, many = (at.shuffled_values(rows, ["a", "b"], rows_per_task=n) for n in (10**6, 7))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


@pytest.mark.parametrize("rows_per_task", [40, 10**6])
def test_shuffled_values_are_a_permutation(rows, rows_per_task):
    out = at.shuffled_values(rows, ["a", "b"], rows_per_task=rows_per_task).toPandas()
    assert len(out) == 300
    assert sorted(out["a_shuffled"]) == sorted(out["a"]) and sorted(out["b_shuffled"]) == sorted(out["b"])
    assert (out["a_shuffled"] != out["a"]).mean() > 0.95


def test_permutation_importance(rows, fit):
    scores = at.permutation_importance(rows, ["a", "b"], lambda df: df.withColumn("prediction", fit.predict()))
    got = {r["feature"]: r["importance"] for r in scores.collect()}
    assert got["a"] > got["b"] > 1.0
