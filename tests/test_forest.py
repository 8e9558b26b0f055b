"""Forests and boosted trees grown on binned rows, against plain searches for the best split."""

import inspect

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from wearspan.operators import forest as fo
from wearspan.plans import training as tr
from wearspan.queries import modelling
from wearspan.queries.common import SplitPanels

NAMES = ["a", "b", "c", "d"]
PLAIN = {"n_estimators": 1, "max_depth": 4, "min_samples_leaf": 3, "max_features": "all", "bootstrap": False, "seed": 7}


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 12, 900), rng.integers(0, 5, 900), rng.integers(0, 30, 900), np.full(900, 2)])
    y = (6 * x[:, 0] - 9 * (x[:, 1] == 3) * x[:, 0] + 0.5 * x[:, 2]).round()
    rows = [(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row int, a double, b double, c double, d double, rul int").repartition(5)
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).persist()


def by_hand(x, y, depth, least):
    """Predictions of a tree whose splits are found by trying all midpoints."""
    best = None
    if depth and len(y) >= 2 * least and y.std() > 0:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for t in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= t
                if least <= low.sum() <= len(y) - least:
                    fall = y[low].sum() ** 2 / low.sum() + y[~low].sum() ** 2 / (~low).sum()
                    if best is None or fall > best[0] + 1e-6:
                        best = (fall, low)
    if best is None or best[0] - y.sum() ** 2 / len(y) < 1e-9:
        return np.full(len(y), y.mean())
    out = np.empty(len(y))
    for side in (best[1], ~best[1]):
        out[side] = by_hand(x[side], y[side], depth - 1, least)
    return out


@pytest.fixture
def by_levels(monkeypatch):
    """All nodes are grown by passes over the blocks, in several parts."""
    monkeypatch.setattr(fo, "LOCAL_ROWS", 0)
    monkeypatch.setattr(fo, "PASS_CELLS", 3 * fo.BINS * len(NAMES))


@pytest.mark.parametrize("how", ["by_task", "by_levels", "by_both"])
def test_a_tree_is_the_one_found_by_hand(vectors, how, request, monkeypatch):
    if how == "by_levels":
        request.getfixturevalue("by_levels")
    if how == "by_both":  # passes for the first levels, single tasks for the smaller nodes
        monkeypatch.setattr(fo, "LOCAL_ROWS", 500)
        monkeypatch.setattr(fo, "LOCAL_LEVELS", 1)
    model = tr.random_forest(PLAIN).fit(vectors)
    rows = model.transform(vectors).select("row", *NAMES, "rul", "prediction").toPandas().sort_values("row")
    np.testing.assert_allclose(rows["prediction"], by_hand(rows[NAMES].to_numpy(), rows["rul"].to_numpy(float), 4, 3), atol=1e-9)


def test_mllib_grows_the_same_tree(vectors):
    mine = tr.random_forest(PLAIN).fit(vectors).transform(vectors)
    theirs = RandomForestRegressor(labelCol="rul", numTrees=1, maxDepth=4, minInstancesPerNode=3, featureSubsetStrategy="all", bootstrap=False).fit(vectors)
    both = mine.select("row", "prediction").join(theirs.transform(vectors).select("row", F.col("prediction").alias("other")), "row").toPandas()
    np.testing.assert_allclose(both["prediction"], both["other"], atol=1e-9)


def test_mllib_boosts_the_same_rounds(vectors):
    params = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample": "all", "seed": 1}
    mine = tr.boosted_trees(params).fit(vectors)
    theirs = GBTRegressor(labelCol="rul", maxIter=5, maxDepth=3, stepSize=0.3).fit(vectors)
    assert list(mine.treeWeights) == list(theirs.treeWeights)
    both = mine.transform(vectors).select("row", "prediction").join(theirs.transform(vectors).select("row", F.col("prediction").alias("other")), "row").toPandas()
    np.testing.assert_allclose(both["prediction"], both["other"], atol=1e-9)


def test_a_forest_repeats_itself_and_scores_like_its_model(spark, vectors):
    params = {**PLAIN, "n_estimators": 9, "max_depth": 6, "bootstrap": True, "max_features": "sqrt"}
    estimator = tr.random_forest(params)
    with estimator.bin(vectors) as data:
        first, again = estimator.grow(data), estimator.grow(data)
        fewer = tr.random_forest({**params, "n_estimators": 4}).grow(data)
        scored = sorted(r["prediction"] for r in first.score(data.blocks, "rul").collect())
    assert all((a == b).all() for a, b in zip(first.trees, again.trees)) and all((a == b).all() for a, b in zip(first.trees, fewer.trees))
    assert len({len(t) for t in first.trees}) > 1 and all(abs(t["n"][0] - 900) < 150 for t in first.trees)
    model = first.model(spark, estimator.regressor, type(tr.random_forest(params).fit(vectors)))
    np.testing.assert_allclose(scored, sorted(r[0] for r in model.transform(vectors).select("prediction").collect()), atol=1e-9)
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9


def test_many_values_are_cut_into_equal_shares():
    rng = np.random.default_rng(2)
    x = rng.normal(size=200_000)
    held = None
    for part in np.array_split(x, 40):
        now = (part, np.ones(len(part)))
        held = fo._merged([held, now] if held else [now], fo.SUMMARY_HELD)
    cuts = fo.thresholds(*fo._shortened(*held, fo.SUMMARY))
    shares = np.bincount(np.searchsorted(cuts, x), minlength=fo.BINS) / len(x)
    assert len(cuts) == fo.BINS - 1 and abs(shares - 1 / fo.BINS).max() < 0.01
    assert fo.thresholds(np.array([1.0, 2.0, 4.0]), np.ones(3)).tolist() == [1.5, 3.0] and len(fo.thresholds(np.array([5.0]), np.ones(1))) == 0


def test_labels_that_are_missing_are_an_error(spark, vectors):
    lacking = vectors.withColumn("rul", F.when(F.col("row") != 5, F.col("rul")))
    with pytest.raises(Exception, match="labels must not be null"):
        tr.random_forest(PLAIN).fit(lacking)
    with pytest.raises(ValueError, match="at least one row"):
        tr.random_forest(PLAIN).fit(vectors.limit(0))


def test_fits_keep_their_rows_out_of_memory(spark, vectors, monkeypatch):
    """Neither the vectors of a fit nor its blocks lie in the executors' memory, and MLlib's fit isn't used."""
    monkeypatch.setattr(RandomForestRegressor, "_fit", None)
    kept = []
    real = fo.grow_forest
    monkeypatch.setattr(fo, "grow_forest", lambda data, *a: (kept.append(data.blocks.storageLevel), real(data, *a))[1])
    with tr.assemble(vectors.drop("features"), NAMES) as data:
        kept.append(data.rows.storageLevel)
        data.fit(tr.random_forest(PLAIN))
    assert len(kept) == 2 and all(level.useDisk and not level.useMemory for level in kept)


def test_training_runs_over_the_whole_grid(spark, monkeypatch):
    """The registered query passes no parameters that shrink the grids, the forests or the windows."""
    seen = []

    def prepared(raw, *a, **b):
        seen.append((a, b))
        return "data"

    class Listed(Exception):
        pass

    def trained(dataset, data, catalog, results_path=None, tune=True, params=None):
        seen.append((data, tune, params))
        raise Listed

    panel = spark.createDataFrame([(1, 1, 5)], "engine_id int, cycle int, rul int")
    monkeypatch.setattr(modelling, "split_panels", lambda *a: SplitPanels(panel, panel, None, None))
    monkeypatch.setattr(modelling, "supplier_final_rul", lambda *a: panel.select("engine_id"))
    monkeypatch.setattr(modelling, "prepare_training_data", prepared)
    monkeypatch.setattr(modelling, "train_all", trained)
    with pytest.raises(Listed):
        modelling.train_and_register(spark, "no folder is read")
    assert seen == [((), {}), ("data", True, None)]
    assert inspect.signature(tr.train_all).parameters["tune"].default is True
