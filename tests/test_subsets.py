"""Machines named by subset and engine: labels, windows and rolling frames, also where one machine is split."""

import pytest
from pyspark.sql import functions as F

from wearspan.operators.attribution import LinearFit, explanation_json, fit_window_average, score_windows, sequence_explanation_records
from wearspan.operators.labels import add_test_rul, add_train_rul, join_last_cycle
from wearspan.operators.rolling import add_rolling
from wearspan.operators.sequences import last_windows, latest_window, make_windows
from wearspan.operators.skew import profile_key

MACHINE = ("dataset", "engine_id")


def panel(spark):
    rows = [(d, e, c, float(e * 100 + c * (1 if d == "A" else 3))) for d, e, n in (("A", 1, 40), ("A", 2, 7), ("B", 1, 5), ("B", 3, 12)) for c in range(1, n + 1)]
    return spark.createDataFrame(rows, "dataset STRING, engine_id INT, cycle INT, s_2 DOUBLE")


def alone(df, step):
    """The step on each subset by itself."""
    parts = [step(df.where(F.col("dataset") == d)).withColumn("dataset", F.lit(d)) for d in ("A", "B")]
    return parts[0].unionByName(parts[1])


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert rows(a) == rows(b) and a.count()


@pytest.mark.parametrize("rows_per_task", [10**6, 9])
def test_each_subset_has_its_own_machines(spark, rows_per_task):
    df = panel(spark)
    args = {"rows_per_task": rows_per_task}
    assert (profile_key(df, MACHINE, rows_per_task=rows_per_task).heavy is not None) == (rows_per_task == 9)
    plain = {"rows_per_task": 10**6}
    same(add_train_rul(df, engine=MACHINE, **args), alone(df, lambda x: add_train_rul(x, **plain)))
    same(add_rolling(df, ["s_2"], (3,), engine=MACHINE, **args), alone(df, lambda x: add_rolling(x, ["s_2"], (3,), **plain)))
    labelled = add_train_rul(df, engine=MACHINE)
    for stride in (1, 3):
        cut = make_windows(labelled, ["s_2"], size=6, stride=stride, engine=MACHINE, **args)
        same(cut, alone(labelled, lambda x, s=stride: make_windows(x, ["s_2"], size=6, stride=s, **plain)))
    same(latest_window(make_windows(labelled, ["s_2"], size=6, engine=MACHINE), MACHINE), last_windows(labelled, ["s_2"], size=6, engine=MACHINE))
    same(join_last_cycle(df, engine=MACHINE), alone(df, join_last_cycle))


def test_final_life_of_the_right_subset(spark):
    df = panel(spark)
    final = spark.createDataFrame([("A", 1, 3), ("A", 2, 4), ("B", 1, 50), ("B", 3, 6)], "dataset STRING, engine_id INT, final_rul INT")
    last = add_test_rul(df, final, engine=MACHINE).groupBy(*MACHINE).agg(F.max_by("rul", "cycle").alias("rul"))
    assert {(r[0], r[1]): r[2] for r in last.collect()} == {("A", 1): 3, ("A", 2): 4, ("B", 1): 50, ("B", 3): 6}
    with pytest.raises(ValueError, match=r"\('B', 1\)"):
        add_test_rul(df, final.where("final_rul <> 50"), engine=MACHINE)


def test_sequence_record_of_equal_cells(spark):
    windows = spark.createDataFrame([(1, [[6.0, 6.0]] * 3)], "engine_id INT, window ARRAY<ARRAY<FLOAT>>")
    fit = LinearFit(tuple(f"{t}:{f}" for t in range(3) for f in "ab"), (0.25,) * 6, -3.0, (2.0,) * 6)
    row = sequence_explanation_records(windows, fit, ["a", "b"], ["engine_id"], "m", "FD001").withColumn("order", F.map_entries("feature_importances")).first()
    assert row["rul_prediction"] == 6.0 and row["shap_values_full"] == [[1.0, 1.0]] * 3
    assert list(map(tuple, row["order"])) == [("b", 1.0), ("a", 1.0)]
    assert row["explanation_metadata"]["base_value"] == 0.0


def test_sequence_records_add_up(spark):
    labelled = add_train_rul(panel(spark).withColumn("s_3", F.col("cycle") % 4 + F.lit(0.5)).withColumn("s_4", F.lit(7.0)), engine=MACHINE)
    features = ["s_2", "s_3", "s_4"]
    windows = make_windows(labelled, features, size=5, engine=MACHINE)
    fit = fit_window_average(windows, 5, features)
    assert fit.coefficients[2::3] == (0.0,) * 5 and any(fit.coefficients)
    keys = [*MACHINE, "end_cycle"]
    records = sequence_explanation_records(windows, fit, features, keys, "m", None)
    both = records.withColumn("order", F.map_values("feature_importances")).join(score_windows(windows, fit).select(*keys, "prediction"), keys).collect()
    for r in both:
        cells = [v for step in r["shap_values_full"] for v in step]
        assert len(r["shap_values_full"]) == 5 and fit.base + sum(cells) == pytest.approx(r["prediction"]) == pytest.approx(r["rul_prediction"])
        sizes = {f: sum(abs(step[i]) for step in r["shap_values_full"]) / 5 for i, f in enumerate(features)}
        assert r["feature_importances"] == pytest.approx(sizes)
        assert r["order"] == sorted(r["order"], reverse=True)
    assert '"shap_values_full":[[' in explanation_json(records, keys).first()["json"]
    with pytest.raises(ValueError, match="no window"):
        fit_window_average(windows.limit(0), 5, features)
