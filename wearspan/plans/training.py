"""From a raw panel to model-ready frames, and from there to trained models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.forest import HistogramBoosting, HistogramForest, HistogramTrees, to_blocks
from wearspan.operators.labels import label_test, label_train, require_final_rul
from wearspan.operators.metrics import metrics_dict
from wearspan.operators.rolling import lookback
from wearspan.operators.sequences import cut_windows, last_cycle_snapshot, last_windows, window_lookback
from wearspan.operators.skew import split_panel
from wearspan.operators.splits import expand_grid, with_holdout
from wearspan.plans.features import FeatureConfig, FeatureSet, engineer
from wearspan.schema import (
    FLAT_SENSORS,
    MULTI_REGIME_SUBSETS,
    ROLLING_WINDOWS,
    RUL,
    RUL_CAP,
    SEED,
    WINDOW_SIZE,
    model_features,
)
from wearspan.sources.catalog import RunCatalog
from wearspan.sources.telemetry import PanelTriple, load_subset

# MLlib grows trees at most this deep; it stands for "no limit".
DEEPEST_TREE = 30
# Depth above which a forest may have more nodes than the driver holds several times.
DEEP_TREE = 15
# Fits of a search that run at the same time.
PARALLEL_FITS = 3


@dataclass(frozen=True)
class TrainingData:
    """Lazy frames for tabular and sequence models; nothing is computed until used."""

    train_features: DataFrame
    test_features: DataFrame
    test_snapshot: DataFrame
    feature_columns: tuple[str, ...]
    train_windows: DataFrame
    test_windows: DataFrame
    final_test_windows: DataFrame
    features: FeatureSet


def prepare_training_data(
    raw: PanelTriple,
    rul_cap: int | None = RUL_CAP,
    rolling_windows: Sequence[int] = ROLLING_WINDOWS,
    window_size: int = WINDOW_SIZE,
    window_stride: int = 1,
    drop_sensors: Sequence[str] = FLAT_SENSORS,
    normalize_by_regime: bool = False,
) -> TrainingData:
    """Label, engineer and window a train/test panel.

    The panels are split once, with lookback for rolling columns and windows
    together, so every step shares the same partitioning.
    """
    require_final_rul(raw.test, raw.final_rul)
    reach = lookback(rolling_windows) + window_lookback(window_size, window_stride)
    train = label_train(split_panel(raw.train, reach), rul_cap)
    test = label_test(split_panel(raw.test, reach), raw.final_rul, rul_cap)
    config = FeatureConfig(tuple(drop_sensors), tuple(rolling_windows), normalize_by_regime)
    made = engineer(train, test, config)
    columns = model_features(made.train_panel.columns)
    return TrainingData(
        train_features=made.train,
        test_features=made.test,
        test_snapshot=last_cycle_snapshot(made.test),
        feature_columns=tuple(columns),
        train_windows=cut_windows(made.train_panel, columns, RUL, window_size, window_stride),
        test_windows=cut_windows(made.test_panel, columns, RUL, window_size, window_stride),
        final_test_windows=last_windows(made.test, columns, RUL, window_size),
        features=made,
    )


def get_training_data(
    spark: SparkSession,
    dataset: str,
    data_root: str,
    normalize_by_regime: bool | None = None,
    **options: Any,
) -> TrainingData:
    """Read one subset and prepare it; subsets with several regimes are scaled per regime."""
    dataset = dataset.upper()
    by_regime = dataset in MULTI_REGIME_SUBSETS if normalize_by_regime is None else normalize_by_regime
    return prepare_training_data(load_subset(spark, dataset, data_root), normalize_by_regime=by_regime, **options)


# --- estimators ---------------------------------------------------------------

# Default parameters and grids of the tabular baselines.
FOREST_DEFAULTS = {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 2, "max_features": "sqrt", "seed": SEED}
FOREST_GRID = {"n_estimators": [200, 400], "max_depth": [12, None], "min_samples_leaf": [1, 2]}
BOOSTED_DEFAULTS = {
    "n_estimators": 600,
    "max_depth": 4,
    "learning_rate": 0.03,
    "subsample": 0.9,
    "colsample": 0.9,
    "seed": SEED,
}
BOOSTED_GRID = {"n_estimators": [300, 600], "max_depth": [3, 4], "learning_rate": [0.03, 0.05]}


def random_forest(params: dict[str, Any]) -> Estimator:
    depth = params.get("max_depth")
    regressor = RandomForestRegressor(
        featuresCol="features",
        labelCol=RUL,
        numTrees=params["n_estimators"],
        maxDepth=DEEPEST_TREE if depth is None else depth,
        minInstancesPerNode=params["min_samples_leaf"],
        featureSubsetStrategy=str(params["max_features"]),
        bootstrap=params.get("bootstrap", True),
        seed=params["seed"],
    )
    return HistogramForest(regressor)


def boosted_trees(params: dict[str, Any]) -> Estimator:
    """Gradient-boosted trees; ``validation_column`` turns on early stopping."""
    early = {}
    if params.get("validation_column"):
        early = {"validationIndicatorCol": params["validation_column"], "validationTol": params.get("tolerance", 0.01)}
    regressor = GBTRegressor(
        featuresCol="features",
        labelCol=RUL,
        maxIter=params["n_estimators"],
        maxDepth=params["max_depth"],
        stepSize=params["learning_rate"],
        subsamplingRate=params["subsample"],
        featureSubsetStrategy=str(params["colsample"]),
        seed=params["seed"],
        **early,
    )
    return regressor if early else HistogramBoosting(regressor)


def linear(params: dict[str, Any]) -> Estimator:
    return LinearRegression(featuresCol="features", labelCol=RUL, regParam=params.get("reg", 0.0))


FAMILIES: dict[str, tuple[Callable[[dict[str, Any]], Estimator], dict[str, Any], dict[str, list[Any]]]] = {
    "random_forest": (random_forest, FOREST_DEFAULTS, FOREST_GRID),
    "gradient_boosting": (boosted_trees, BOOSTED_DEFAULTS, BOOSTED_GRID),
}


@dataclass(frozen=True)
class Assembled:
    """A feature frame as vectors, computed once and shared by all fits on it; use as a context.

    The vectors are several times the input, so they go to the executors' disks and not into their memory.
    """

    assembler: VectorAssembler
    rows: DataFrame

    def __enter__(self) -> Assembled:
        self.rows.persist(StorageLevel.DISK_ONLY)
        return self

    def __exit__(self, *_: object) -> None:
        self.rows.unpersist()

    def fit(self, estimator: Estimator, rows: DataFrame | None = None) -> PipelineModel:
        return PipelineModel([self.assembler, estimator.fit(self.rows if rows is None else rows)])


def assemble(train: DataFrame, features: Sequence[str], *marks: str) -> Assembled:
    """Vectors, labels and the columns that mark rows."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Assembled(assembler, assembler.transform(train).select("features", RUL, *marks))


def fit_model(estimator: Estimator, train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Fit on assembled columns that are computed once; tree fits read them several times."""
    marks = "validationIndicatorCol"
    extra = [estimator.getOrDefault(marks)] if estimator.hasParam(marks) and estimator.isSet(marks) else []
    with assemble(train, features, *extra) as data:
        return data.fit(estimator)


def evaluate_candidates(
    factory: Callable[[dict[str, Any]], Estimator], data: Assembled, candidates: Sequence[dict[str, Any]]
) -> list[dict[str, Any]]:
    """One row per candidate: its hold-out metrics. A few fits run side by side; trees share their binned rows.

    Forests without a depth limit have millions of nodes, so only one is grown at a time.
    """
    fit_rows, valid_rows = data.rows.where(~F.col("is_validation")), data.rows.where("is_validation")
    estimators = [factory(c) for c in candidates]
    deep = any(isinstance(e, HistogramForest) and e.regressor.getMaxDepth() > DEEP_TREE for e in estimators)

    def evaluate(scored: Callable[[Estimator], DataFrame]) -> list[dict[str, Any]]:
        def one(place: int) -> dict[str, Any]:
            return {"ordinal": place, "params": candidates[place], "metrics": metrics_dict(scored(estimators[place]))}

        with ThreadPoolExecutor(1 if deep else PARALLEL_FITS) as pool:
            return list(pool.map(inheritable_thread_target(data.rows.sparkSession)(one), range(len(candidates))))

    if not all(isinstance(e, HistogramTrees) and e.takes(fit_rows) for e in estimators):
        return evaluate(lambda estimator: estimator.fit(fit_rows).transform(valid_rows))
    with estimators[0].bin(fit_rows) as binned:
        valid = to_blocks(valid_rows, binned.cuts, RUL)
        return evaluate(lambda estimator: estimator.grow(binned).score(valid, RUL))


def winner(log: Sequence[dict[str, Any]]) -> dict[str, Any]:
    """The parameters of the lowest RMSE, the first of equals."""
    return min(log, key=lambda row: (row["metrics"]["rmse"], row["ordinal"]))["params"]


def grid_search(
    factory: Callable[[dict[str, Any]], Estimator],
    train: DataFrame,
    features: Sequence[str],
    grid: dict[str, Sequence[Any]],
    percent: int = 20,
    by: str = "row",
) -> tuple[dict[str, Any], list[dict[str, Any]]]:
    """Evaluate every combination on a hold-out: the best one, and the whole log."""
    candidates = expand_grid(grid) if grid else []
    if not candidates:
        raise ValueError("the parameter grid is empty")
    with assemble(with_holdout(train, percent, by), features, "is_validation") as data:
        log = evaluate_candidates(factory, data, candidates)
    return winner(log), log


def search_log_frame(spark: SparkSession, log: list[dict[str, Any]]) -> DataFrame:
    rows = [(e["ordinal"], {k: str(v) for k, v in e["params"].items()}, *e["metrics"].values()) for e in log]
    return spark.createDataFrame(
        rows, "ordinal int, params map<string,string>, rmse double, mae double, r2 double, nasa_score double"
    )


@dataclass(frozen=True)
class FamilyRun:
    """A fitted family: the candidates as rows, the one chosen, and its snapshot metrics."""

    family: str
    dataset: str
    features: tuple[str, ...]
    candidates: tuple[dict[str, Any], ...]
    chosen: dict[str, Any]
    model: PipelineModel
    metrics: dict[str, float]
    version: str | None = None


def register(catalog: RunCatalog, run: FamilyRun) -> FamilyRun:
    """Store a run: the same run with its version."""
    saved = catalog.save(
        run.model,
        run.family,
        run.dataset,
        run.metrics,
        {"chosen": run.chosen, "candidates": list(run.candidates)},
        run.features,
        f"{run.family} on engineered features, one row per cycle",
    )
    return replace(run, version=saved["version"])


def fit_families(
    dataset: str,
    data: TrainingData,
    families: Sequence[str] = tuple(FAMILIES),
    overrides: dict[str, dict[str, Any]] | None = None,
    tune: bool = True,
) -> list[FamilyRun]:
    """Fit families on one assembled frame: candidates on its hold-out, then the best on all its rows.

    Without tuning the only candidate is the family's defaults with the overrides.
    """
    snapshot, runs = data.test_snapshot, []
    with assemble(with_holdout(data.train_features), data.feature_columns, "is_validation") as shared:
        for family in families:
            factory, defaults, grid = FAMILIES[family]
            base = defaults | (overrides or {}).get(family, {})
            points = [base | point for point in expand_grid(grid)] if tune else [base]
            log = evaluate_candidates(factory, shared, points) if tune else []
            best = winner(log) if tune else base
            model = shared.fit(factory(best))
            metrics = metrics_dict(model.transform(snapshot))
            runs.append(FamilyRun(family, dataset, data.feature_columns, tuple(log), best, model, metrics))
    return runs


def train_all(
    dataset: str,
    data: TrainingData,
    catalog: RunCatalog,
    results_path: str | None = None,
    tune: bool = True,
    params: dict[str, dict[str, Any]] | None = None,
) -> list[FamilyRun]:
    """Fit every tabular family, register the runs and append them to the results table."""
    runs = [register(catalog, run) for run in fit_families(dataset, data, tuple(FAMILIES), params, tune)]
    if results_path:
        catalog.append_results(results_path, [(r.family, r.dataset, r.metrics, r.version) for r in runs])
    return runs
