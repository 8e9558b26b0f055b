"""Queries on tree models whose result has a closed form: splits on one level, all features, all rows.

The four features have few distinct values, so every midpoint between two of them is a
candidate and SQL can find the best one: the model, its scores, attributions, search log and
stopping round are compared value by value.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.splits import with_holdout
from wearspan.operators.trees import tree_attribution, tree_fit
from wearspan.plans.training import boosted_trees, fit_model, grid_search, random_forest, search_log_frame
from wearspan.queries.common import rounded, split_panels
from wearspan.queries.modelling import FOREST, _features
from wearspan.queries.registry import ROW_KEY, SPLIT, query, sql_metrics, sql_percentile
from wearspan.schema import CYCLE, ENGINE, RUL, SEED

KEYS = [ENGINE, CYCLE]
NAMES = ["setting_1", "setting_2", "s_4", "s_7"]

STUMP = {"n_estimators": 1, "max_depth": 1, "min_samples_leaf": 1, "max_features": "all", "bootstrap": False, "seed": SEED}
RATE = 0.1
ROUNDS = {"n_estimators": 2, "max_depth": 1, "learning_rate": RATE, "subsample": 1.0, "colsample": "all", "seed": SEED}
SEARCH = {"n_estimators": [1, 2], "learning_rate": [0.1, 0.5]}


def sql_stump(name: str, source: str, target: str) -> str:
    """The best single split of ``target``: feature, cut and the means on both sides."""
    return f"""
{name}_cells AS (
  SELECT ordinal, feature, x, count(*) AS n, sum(y) AS s
  FROM (SELECT unnest(range({len(NAMES)})) AS ordinal, unnest({NAMES}) AS feature, unnest([{", ".join(NAMES)}]) AS x, {target} AS y
        FROM {source}) GROUP BY ordinal, feature, x),
{name}_cuts AS (
  SELECT ordinal, feature, (x + lead(x) OVER w) / 2 AS cut, sum(n) OVER w AS n_low, sum(s) OVER w AS s_low,
         sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
  FROM {name}_cells WINDOW w AS (PARTITION BY feature ORDER BY x)),
{name} AS MATERIALIZED (
  SELECT feature, cut, s / n AS root, s_low / n_low AS low, (s - s_low) / (n - n_low) AS high
  FROM {name}_cuts WHERE cut IS NOT NULL
  ORDER BY s_low * s_low / n_low + (s - s_low) * (s - s_low) / (n - n_low) DESC, ordinal LIMIT 1)"""


def sql_value(stump: str) -> str:
    value = " ".join(f"WHEN '{n}' THEN {n}" for n in NAMES)
    return f"CASE WHEN (CASE {stump}.feature {value} END) <= {stump}.cut THEN {stump}.low ELSE {stump}.high END"


def sql_rounds(train: str) -> str:
    """Two boosting rounds of squared error: the second split is fitted on twice the residuals."""
    return f"""{sql_stump("one", train, "rul")},
residuals AS MATERIALIZED (SELECT t.*, 2 * (rul - ({sql_value("one")})) AS residual FROM {train} t CROSS JOIN one),
{sql_stump("two", "residuals", "residual")}"""


TRAIN = f"""{SPLIT}, train AS (SELECT * FROM split_panel WHERE split = 'train'), test AS (SELECT * FROM split_panel WHERE split = 'test')"""
PARTED = f"""{SPLIT},
marked AS (SELECT *, {sql_percentile(ROW_KEY)} < 20 AS is_validation FROM split_panel WHERE split = 'train'),
train AS (SELECT * FROM marked WHERE NOT is_validation), held AS (SELECT * FROM marked WHERE is_validation)"""


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)


@query(
    f"""WITH {TRAIN}, {sql_stump("one", "train", "rul")},
scored AS (SELECT t.*, one.feature AS chosen, root, {sql_value("one")} AS prediction FROM test t CROSS JOIN one)
SELECT engine_id, "cycle", feature, round(CASE WHEN feature = chosen THEN prediction - root ELSE 0 END, 6) AS value,
       round(root, 6) AS base, round(prediction, 6) AS prediction
FROM scored CROSS JOIN (SELECT unnest({NAMES}) AS feature)"""
)
def stump_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """A tree of one split: its scores on the test cycles, and what each feature adds to the mean."""
    panels = split_panels(spark, folder)
    model = fit_model(random_forest(STUMP), panels.train, NAMES).stages[-1]
    fit = tree_fit(spark, model, NAMES)
    parts = tree_attribution(_vectors(panels.test.select(*KEYS, *NAMES)), fit, KEYS)
    return rounded(parts.withColumn("base", F.lit(fit.base)), ["value", "base", "prediction"], 6)


@query(
    f"""WITH {TRAIN}, {sql_rounds("train")}
SELECT engine_id, "cycle", rul, round(({sql_value("one")}) + {RATE} * ({sql_value("two")}), 6) AS prediction
FROM test CROSS JOIN one CROSS JOIN two"""
)
def boosted_rounds_score(spark: SparkSession, folder: str) -> DataFrame:
    """Two boosting rounds on all train cycles, scored on all test cycles."""
    panels = split_panels(spark, folder)
    model = fit_model(boosted_trees(ROUNDS), panels.train, NAMES)
    return rounded(model.transform(panels.test).select(*KEYS, RUL, "prediction"), ["prediction"], 6)


@query(
    f"""WITH {PARTED}, {sql_rounds("train")},
errors AS (
  SELECT avg(power(rul - ({sql_value("one")}), 2)) AS first, avg(power(rul - ({sql_value("one")}) - {RATE} * ({sql_value("two")}), 2)) AS second
  FROM held CROSS JOIN one CROSS JOIN two),
tolerances AS (SELECT CAST(unnest([0.01, 0.0]) AS DOUBLE) AS tolerance)
SELECT tolerance, CAST(CASE WHEN first - second < tolerance * greatest(second, 0.01) OR second >= first THEN 1 ELSE 2 END AS INTEGER) AS trees,
       round(first, 6) AS first_error
FROM errors CROSS JOIN tolerances"""
)
def boosted_rounds_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Early stopping: the rounds kept under two tolerances, and the hold-out error of the first round."""
    train = with_holdout(split_panels(spark, folder).train, 20)
    held = train.where("is_validation")
    rows = []
    for tolerance in (0.01, 0.0):
        early = {"validation_column": "is_validation", "tolerance": tolerance}
        model = fit_model(boosted_trees({**ROUNDS, **early}), train, NAMES)
        errors = model.stages[-1].evaluateEachIteration(_vectors(held), "squared")
        rows.append((tolerance, model.stages[-1].getNumTrees, round(errors[0], 6)))
    return spark.createDataFrame(rows, "tolerance double, trees int, first_error double")


@query(
    f"""WITH {PARTED}, {sql_rounds("train")},
candidates AS (SELECT CAST(2 * t + r AS INTEGER) AS ordinal, t + 1 AS n_estimators, {SEARCH["learning_rate"]}[r + 1] AS learning_rate
  FROM range(2) a(t), range(2) b(r)),
scored AS (
  SELECT ordinal, CAST(rul AS DOUBLE) AS rul,
         ({sql_value("one")}) + CASE WHEN n_estimators = 2 THEN learning_rate * ({sql_value("two")}) ELSE 0 END AS prediction
  FROM held CROSS JOIN one CROSS JOIN two CROSS JOIN candidates),
measured AS (SELECT ordinal, {sql_metrics()} FROM scored GROUP BY ordinal)
SELECT ordinal, CAST(n_estimators AS VARCHAR) AS n_estimators, CAST(learning_rate AS VARCHAR) AS learning_rate, rmse, mae, r2, nasa_score,
       row_number() OVER (ORDER BY rmse, ordinal) = 1 AS is_best
FROM measured JOIN candidates USING (ordinal)"""
)
def grid_search_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """A hold-out grid search with all its numbers."""
    train = split_panels(spark, folder).train
    best, log = grid_search(lambda p: boosted_trees({**ROUNDS, **p}), train, NAMES, SEARCH)
    frame = search_log_frame(spark, [{**e, "params": {**e["params"], "best": e["params"] == best}} for e in log])
    params = F.col("params")
    found = frame.select(
        "ordinal", params["n_estimators"].alias("n_estimators"), params["learning_rate"].alias("learning_rate"),
        "rmse", "mae", "r2", "nasa_score", (params["best"] == "True").alias("is_best"),
    )
    return rounded(rounded(found, ["rmse", "mae", "r2"], 6), ["nasa_score"], 2)


@query(
    f"""WITH {SPLIT}
SELECT engine_id, max("cycle") AS "cycle", true AS adds_up FROM split_panel WHERE split = 'test' GROUP BY engine_id"""
)
def forest_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """A forest on all features: the parts of each last cycle's prediction, added up."""
    _, made, columns = _features(spark, folder)
    fitted = fit_model(random_forest(FOREST), made.train, columns)
    fit = tree_fit(spark, fitted.stages[-1], columns)
    last = made.test.groupBy(ENGINE).agg(F.max_by(F.struct(CYCLE, *columns), CYCLE).alias("_row")).select(ENGINE, "_row.*")
    parts = tree_attribution(fitted.stages[0].transform(last), fit, KEYS)
    total = parts.groupBy(*KEYS, "prediction").agg(F.sum("value").alias("_total"), F.count("feature").alias("_n"))
    right = (F.abs(F.col("_total") + fit.base - F.col("prediction")) < 1e-6) & (F.col("_n") == len(columns))
    return total.select(*KEYS, right.alias("adds_up"))
