import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wearspan.operators.trees import tree_attribution, tree_fit
from wearspan.plans.training import boosted_trees, random_forest

NAMES = ["a", "b", "flat"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 9, 600), rng.integers(0, 7, 600)
    rows = [(i, float(x), float(y), 1.0, int(10 * x - 4 * y + x * y)) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "row int, a double, b double, flat double, rul int")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)


FOREST = {"n_estimators": 7, "max_depth": 5, "min_samples_leaf": 1, "max_features": "all", "seed": 3}
BOOSTED = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample": "all", "seed": 3}


@pytest.mark.parametrize("factory, params", [(random_forest, FOREST), (boosted_trees, BOOSTED)])
def test_contributions_add_up(spark, vectors, factory, params):
    model = factory(params).fit(vectors)
    fit = tree_fit(spark, model, NAMES)
    got = tree_attribution(vectors, fit, ["row"]).toPandas()
    assert len(got) == 600 * 3 and (got.loc[got["feature"] == "flat", "value"] == 0.0).all()
    total = got.groupby("row").agg(value=("value", "sum"), prediction=("prediction", "first"))
    np.testing.assert_allclose(total["value"] + fit.base, total["prediction"], atol=1e-9)
    plain = model.transform(vectors).select("row", "prediction").toPandas().set_index("row")["prediction"]
    np.testing.assert_allclose(total["prediction"], plain.loc[total.index], atol=0)
    fit.release()


def test_a_path_gives_its_steps(spark, vectors):
    """One tree of depth two, followed by hand."""
    one = random_forest({**FOREST, "n_estimators": 1, "max_depth": 2, "bootstrap": False})
    model = one.fit(vectors)
    fit = tree_fit(spark, model, NAMES)
    assert fit.base == pytest.approx(vectors.agg(F.avg("rul")).first()[0])
    got = tree_attribution(vectors, fit, ["row"]).toPandas().pivot(index="row", columns="feature", values="value")
    data = vectors.select("row", *NAMES, "rul").toPandas().set_index("row").join(got, rsuffix="_part")

    def best(rows):
        cuts = []
        for name in NAMES:
            values = np.unique(rows[name])
            for t in (values[1:] + values[:-1]) / 2:
                low, high = rows.loc[rows[name] <= t, "rul"], rows.loc[rows[name] > t, "rul"]
                cuts.append((len(low) * low.var(ddof=0) + len(high) * high.var(ddof=0), name, t))
        return min(cuts)[1:]

    want = {name: np.zeros(len(data)) for name in NAMES}

    def follow(rows, depth):
        if depth == 2:
            return
        name, t = best(rows)
        for side in (rows[rows[name] <= t], rows[rows[name] > t]):
            want[name][side.index] += side["rul"].mean() - rows["rul"].mean()
            follow(side, depth + 1)

    follow(data, 0)
    for name in NAMES:
        np.testing.assert_allclose(data[f"{name}_part"], want[name], atol=1e-9)


def test_no_rows_and_a_single_leaf(spark, vectors):
    constant = vectors.withColumn("rul", F.lit(4))
    fit = tree_fit(spark, random_forest(FOREST).fit(constant), NAMES)
    assert fit.base == pytest.approx(4.0)
    assert tree_attribution(constant, fit, ["row"]).where("value <> 0").count() == 0
    assert tree_attribution(constant.limit(0), fit, ["row"]).count() == 0
