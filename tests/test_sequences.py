import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wearspan.functions.arrays import channels, instance_normalize, patch_count, patches
from wearspan.operators.labels import add_train_rul
from wearspan.operators.sequences import last_cycle_snapshot, last_windows, latest_window, make_windows


def rows_of(windows):
    return sorted(
        (r["engine_id"], r["start_cycle"], r["end_cycle"], r["target"], tuple(map(tuple, r["window"]))) for r in windows.collect()
    )


def by_hand(pdf, features, size, stride):
    out = []
    for engine, part in pdf.sort_values("cycle").groupby("engine_id"):
        cells = part[features].to_numpy(np.float32)
        for start in range(0, len(part) - size + 1, stride):
            end = start + size - 1
            cycles, ruls = part["cycle"].to_numpy(), part["rul"].to_numpy()
            window = tuple(tuple(float(x) for x in row) for row in cells[start : end + 1])
            out.append((int(engine), int(cycles[start]), int(cycles[end]), float(ruls[end]), window))
    return sorted(out)


def test_window_shape_and_ends(tiny):
    windows = make_windows(add_train_rul(tiny), ["s_2", "s_3"], size=3, stride=2)
    found = rows_of(windows)
    assert [w[0] for w in found] == [1, 1, 2, 2]
    assert all(w[2] - w[1] == 2 and len(w[4]) == 3 and len(w[4][0]) == 2 for w in found)
    types = dict(windows.dtypes)
    assert types["target"] == "float" and types["window"] == "array<array<float>>"


@settings(max_examples=10, deadline=None)
@given(
    lengths=st.lists(st.integers(1, 20), min_size=1, max_size=3),
    size=st.integers(1, 7),
    stride=st.integers(1, 6),
    rows_per_task=st.sampled_from([None, 2, 5, 11]),
    gap=st.integers(1, 3),
)
def test_windows_match_a_plain_loop(spark, lengths, size, stride, rows_per_task, gap):
    rows = [(e, c * gap, float(e * 100 + c), float(-c), n - c) for e, n in enumerate(lengths, 1) for c in range(1, n + 1)]
    df = spark.createDataFrame(rows, "engine_id int, cycle int, a double, b double, rul int")
    extra = {"rows_per_task": rows_per_task} if rows_per_task else {}
    found = rows_of(make_windows(df, ["a", "b"], size=size, stride=stride, **extra))
    assert found == by_hand(df.toPandas(), ["a", "b"], size, stride)
    assert len(found) == sum(max(0, (n - size) // stride + 1) for n in lengths)


def test_short_engines_and_bad_sizes(tiny):
    labelled = add_train_rul(tiny)
    assert make_windows(labelled, ["s_2"], size=6).count() == 0
    assert last_windows(labelled, ["s_2"], size=6).count() == 0
    for size, stride in ((0, 1), (3, 0), (-1, 2)):
        with pytest.raises(ValueError, match="at least one row"):
            make_windows(labelled, ["s_2"], size=size, stride=stride)


def test_last_window_agrees_with_all_windows(tiny):
    labelled = add_train_rul(tiny)
    every = latest_window(make_windows(labelled, ["s_2", "s_3"], size=3))
    assert rows_of(last_windows(labelled, ["s_2", "s_3"], size=3)) == rows_of(every)


def test_latest_window_per_engine(spark):
    ends = [(1, 1, 3, 50.0), (1, 2, 4, 40.0), (2, 1, 3, 30.0), (2, 2, 4, 20.0), (2, 3, 5, 10.0)]
    df = spark.createDataFrame(ends, "engine_id int, start_cycle int, end_cycle int, target double")
    assert [r["target"] for r in latest_window(df).orderBy("engine_id").collect()] == [40.0, 10.0]


def test_snapshot_limits_before_the_shuffle(tiny):
    snapshot = last_cycle_snapshot(tiny.repartition(2))
    assert sorted((r["engine_id"], r["cycle"]) for r in snapshot.collect()) == [(1, 5), (2, 5)]
    plan = snapshot._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_instance_normalisation(spark):
    series = [[1.0, 2.0, 3.0, 4.0], [5.0, 5.0, 5.0, 5.0]]
    df = spark.createDataFrame([(s,) for s in series], "x array<double>")
    got = [r[0] for r in df.select(instance_normalize(F.col("x"), scale=2.0, shift=1.0)).collect()]
    z = (np.array(series[0]) - 2.5) / np.std(series[0])
    np.testing.assert_allclose(got[0], z * 2 + 1)
    np.testing.assert_allclose(got[1], [1.0] * 4)


def test_patches_and_channels(spark):
    df = spark.createDataFrame([([[float(t), float(-t)] for t in range(8)],)], "w array<array<double>>")
    turned = df.select(channels(F.col("w"), 2).alias("c")).first()[0]
    assert turned == [[float(t) for t in range(8)], [float(-t) for t in range(8)]]
    cut = df.select(patches(channels(F.col("w"), 2)[0], 8, 4, 3)).first()[0]
    assert cut == [[0.0, 1.0, 2.0, 3.0], [3.0, 4.0, 5.0, 6.0]]
    assert patch_count(30, 10, 5) == 5
    for size, length, stride, word in ((8, 10, 5, "longer"), (30, 0, 5, "at least"), (30, 10, 0, "stride")):
        with pytest.raises(ValueError, match=word):
            patch_count(size, length, stride)
