import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearspan.plans import training as tr
from wearspan.plans.scoring import FeatureContractError, UnsupportedModelError, apply_contract, check_features, contract_from_map, score
from wearspan.sources.catalog import ModelNotFoundError, RunCatalog, best_runs, coverage, latest_runs, list_runs, result_rows
from wearspan.sources.telemetry import PanelTriple
from wearspan.streaming.scoring import start_scoring

SCHEMA = "engine_id int, cycle int, setting_1 double, setting_2 double, setting_3 double, s_2 double, s_3 double"
SMALL = {
    "random_forest": {"n_estimators": 4, "max_depth": 4},
    "gradient_boosting": {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3},
}


def degrading(engines, stop, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for e in engines:
        life = int(rng.integers(25, 40))
        for c in range(1, life + 1 - stop):
            left = life - c
            rows.append((e, c, float(e % 2), 0.0, 100.0, float(-left + rng.normal(scale=0.5)), float(rng.normal())))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    train = spark.createDataFrame(degrading(range(1, 9), 0, 1), SCHEMA)
    test = spark.createDataFrame(degrading(range(1, 5), 6, 2), SCHEMA)
    final = spark.createDataFrame([(e, 6) for e in range(1, 5)], "engine_id int, final_rul int")
    return tr.prepare_training_data(PanelTriple(train, test, final), rolling_windows=(3,), window_size=5, window_stride=2)


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    return RunCatalog(spark, str(tmp_path_factory.mktemp("runs")))


@pytest.fixture(scope="module")
def trained(data, catalog):
    return tr.train_all("FD001", data, catalog, f"{catalog.root}-results", tune=False, params=SMALL)


def test_bundle(data):
    assert data.feature_columns[:5] == ("setting_1", "setting_2", "setting_3", "s_2", "s_3")
    assert data.test_snapshot.count() == 4
    assert [r["rul"] for r in data.test_snapshot.collect()] == [6] * 4
    last = data.final_test_windows
    assert last.count() == 4 and len(last.first()["window"][0]) == len(data.feature_columns)
    assert set(r["target"] for r in last.collect()) == {6.0}
    assert data.train_windows.count() > data.test_windows.count() > 4


def test_models_beat_the_mean(trained, data):
    spread = data.test_snapshot.agg(F.avg("rul")).first()[0]
    mean = data.train_features.agg(F.avg("rul")).first()[0]
    for result in trained:
        assert set(result.metrics) == {"rmse", "mae", "r2", "nasa_score"}
        assert result.metrics["rmse"] < abs(mean - spread)


def test_results_are_appended(spark, catalog, trained):
    lines = spark.read.json(f"{catalog.root}-results")
    assert sorted(r["model_name"] for r in lines.collect()) == ["gradient_boosting", "random_forest"]
    assert lines.first()["line"].startswith("| ") and lines.first()["line"].count("|") == 7


def test_listing_and_resolution(catalog, trained):
    listed = catalog.list_models("random_forest", "FD001").collect()
    assert len(listed) == 1 and listed[0]["artifact_available"] and "rmse" in listed[0]["metrics"]
    assert json.loads(listed[0]["params"])["chosen"]["n_estimators"] == 4
    record = catalog.resolve("random_forest", "FD001")
    assert record["version"] == trained[0].version
    assert catalog.resolve("random_forest", "FD001", record["version"])["created_at"] == record["created_at"]
    for model, version in (("absent", "latest"), ("random_forest", "19990101T000000Z")):
        with pytest.raises(ModelNotFoundError):
            catalog.resolve(model, "FD001", version)
    assert catalog.list_models("absent").count() == 0


def test_versions_never_collide(spark, tmp_path):
    catalog = RunCatalog(spark, str(tmp_path))
    saved = [catalog.save(None, "gru_rul", "FD001", {"rmse": float(i)}, {}, ["s_2"], input_size=1) for i in range(3)]
    assert len({s["version"] for s in saved}) == 3
    newest = catalog.resolve("gru_rul", "FD001")
    assert newest["version"] == saved[-1]["version"] and newest["input_size"] == 1
    rows = catalog.list_models().collect()
    assert [r["artifact_available"] for r in rows] == [False] * 3
    assert [r["version"] for r in rows] == [s["version"] for s in reversed(saved)]
    with pytest.raises(ModelNotFoundError, match="no saved model"):
        catalog.load("gru_rul", "FD001")
    assert RunCatalog(spark, str(tmp_path / "nothing")).list_models().count() == 0


def test_moved_catalogue_still_loads(spark, tmp_path, data):
    model = tr.fit_model(tr.linear({}), data.train_features, ["s_2"])
    old = RunCatalog(spark, str(tmp_path / "old"))
    old.save(model, "linear", "FD001", {"rmse": 1.0}, {}, ["s_2"])
    home = next((tmp_path / "old" / "linear" / "FD001").iterdir())
    meta = json.loads((home / "metadata.json").read_text())
    meta["artifact_path"] = "/elsewhere/model"
    old._write_text(str(home / "metadata.json"), json.dumps(meta))
    assert old.list_models().first()["artifact_available"]
    assert old.load("linear", "FD001")[0]["artifact_path"] == "/elsewhere/model"


def test_scoring_contract(spark, catalog, trained, data):
    keys = ["engine_id"]
    rows = data.test_snapshot.select("engine_id", *reversed(data.feature_columns))
    out = score(catalog, rows, "random_forest", "FD001", keys=keys)
    assert out.columns == ["engine_id", "model_name", "dataset", "model_version", "rul_prediction"]
    want = trained[0].model.transform(data.test_snapshot).select("engine_id", F.col("prediction"))
    got = {r[0]: r["rul_prediction"] for r in out.collect()}
    assert got == {r[0]: r[1] for r in want.collect()}
    zeros = spark.createDataFrame([tuple(0.0 for _ in data.feature_columns)], list(data.feature_columns))
    assert isinstance(score(catalog, zeros, "gradient_boosting", "FD001").first()["rul_prediction"], float)
    with pytest.raises(FeatureContractError, match=rf"Missing features \({len(data.feature_columns) - 1}\)"):
        score(catalog, spark.createDataFrame([(0.0,)], "setting_1 double"), "random_forest", "FD001")
    with pytest.raises(FeatureContractError, match=r"not registered \(1\): extra"):
        apply_contract(zeros.withColumn("extra", F.lit(1.0)), data.feature_columns)
    with pytest.raises(UnsupportedModelError):
        score(catalog, zeros, "gru_rul", "FD001")


def test_long_missing_lists_are_shortened(spark):
    with pytest.raises(FeatureContractError) as error:
        check_features(spark, [], [f"f{i}" for i in range(20)])
    assert str(error.value) == "Missing features (20): f0, f1, f2, f3, f4, f5, f6, f7"


def test_map_payload(spark):
    df = spark.createDataFrame([({"b": 2.0, "a": 1.0},), ({"a": 5.0},)], "features map<string,double>")
    assert [tuple(r) for r in contract_from_map(df, ["a", "b"]).collect()] == [(1.0, 2.0), (5.0, None)]


def test_grid_search_keeps_the_whole_log(data):
    grid = {"max_depth": [1, 4], "n_estimators": [3]}
    base = {**tr.FOREST_DEFAULTS, "seed": 1}
    best, log = tr.grid_search(lambda p: tr.random_forest({**base, **p}), data.train_features, data.feature_columns, grid)
    assert [e["params"]["max_depth"] for e in log] == [1, 4] and best["max_depth"] == 4
    with pytest.raises(ValueError, match="empty"):
        tr.grid_search(tr.random_forest, data.train_features, data.feature_columns, {})


def test_early_stopping_uses_the_validation_rows(data):
    marked = data.train_features.withColumn("is_validation", F.col("engine_id") % 4 == 0)
    params = {**tr.BOOSTED_DEFAULTS, "n_estimators": 30, "max_depth": 2, "learning_rate": 0.5, "validation_column": "is_validation"}
    model = tr.fit_model(tr.boosted_trees({**params, "tolerance": 0.1}), marked, data.feature_columns)
    assert model.stages[-1].getNumTrees < 30


def test_run_tables(spark):
    rows = [
        ("gru", "FD001", "v1", "2026-07-02T11:00:00+00:00", 15.5333),
        ("gru", "FD001", "v2", "2026-07-04T07:00:00+00:00", 17.4359),
        ("rf", "FD002", "v3", "2026-07-03T07:00:00+00:00", 18.1),
    ]
    runs = spark.createDataFrame(rows, "model_name string, dataset string, version string, created_at string, rmse double")
    runs = runs.withColumns({m: F.lit(1.23456) for m in ("mae", "r2", "nasa_score")})
    assert [r["version"] for r in list_runs(runs).collect()] == ["v2", "v3", "v1"]
    assert {r["model_name"]: r["version"] for r in latest_runs(runs).collect()} == {"gru": "v2", "rf": "v3"}
    assert {r["dataset"]: r["version"] for r in best_runs(runs).collect()} == {"FD001": "v1", "FD002": "v3"}
    matrix = {r["model_name"]: (r["FD001"], r["FD002"]) for r in coverage(runs, ["FD001", "FD002"]).collect()}
    assert matrix == {"gru": (2, 0), "rf": (0, 1)}
    assert result_rows(runs).first()["line"] == "| gru | FD001 | 15.5333 | 1.2346 | 1.2346 | 1.2346 |"


def test_streamed_requests(spark, tmp_path, data):
    model = tr.fit_model(tr.linear({}), data.train_features, ["s_2", "s_3"])
    catalog = RunCatalog(spark, str(tmp_path / "runs"))
    catalog.save(model, "linear", "FD001", {"rmse": 1.0}, {}, ["s_2", "s_3"])
    inbox = tmp_path / "in"
    inbox.mkdir()
    requests = [
        {"request_id": "good", "features": {"s_2": -3.0, "s_3": 0.0}},
        {"request_id": "short", "features": {"s_2": 0.0}},
        {"request_id": "long", "features": {"s_2": 0.0, "s_3": 0.0, "s_9": 1.0}},
        {"request_id": "empty"},
    ]
    (inbox / "a.json").write_text("\n".join(json.dumps(r) for r in requests))
    start_scoring(
        spark, catalog, str(inbox), str(tmp_path / "out"), str(tmp_path / "state"), "linear", "FD001", once=True
    ).awaitTermination()
    answers = {r["request_id"]: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert answers["good"]["error"] is None and answers["good"]["rul_prediction"] is not None
    assert answers["short"]["error"] == "Missing features (1): s_3"
    assert answers["long"]["error"] == "features not registered (1): s_9"
    assert "features" in answers["empty"]["error"]
    assert all(answers[k]["rul_prediction"] is None for k in ("short", "long", "empty"))
    with pytest.raises(UnsupportedModelError):
        start_scoring(spark, catalog, str(inbox), "x", "y", "gru_rul", "FD001")
