import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wearspan.operators.rolling import add_rolling, lookback
from wearspan.operators.skew import profile_key, rank_within, split_panel, with_position
from pyspark.sql import functions as F


def expected(pdf, sensors, windows):
    out = pdf.sort_values(["engine_id", "cycle"]).copy()
    for n in windows:
        for s in sensors:
            frame = out.groupby("engine_id")[s].rolling(n, min_periods=1)
            out[f"{s}_roll{n}_mean"] = frame.mean().reset_index(level=0, drop=True)
            out[f"{s}_roll{n}_std"] = frame.std().reset_index(level=0, drop=True).fillna(0.0)
    return out.reset_index(drop=True)


def check(spark, pdf, windows, rows_per_task=None):
    options = {"rows_per_task": rows_per_task} if rows_per_task else {}
    made = add_rolling(spark.createDataFrame(pdf), ["s_2", "s_3"], windows, **options).toPandas()
    want = expected(pdf, ["s_2", "s_3"], windows)
    made = made.sort_values(["engine_id", "cycle"]).reset_index(drop=True)
    assert set(made.columns) == set(want.columns)
    np.testing.assert_allclose(made[want.columns], want, atol=1e-7)


def random_panel(seed, lengths, gaps):
    rng = np.random.default_rng(seed)
    parts = []
    for engine, n in enumerate(lengths, 1):
        cycles = np.cumsum(rng.integers(1, 4, n)) if gaps else np.arange(1, n + 1)
        parts.append(
            pd.DataFrame({"engine_id": engine, "cycle": cycles, "s_2": rng.normal(500, 3, n), "s_3": rng.integers(0, 3, n) * 1.0})
        )
    return pd.concat(parts).sample(frac=1, random_state=seed).reset_index(drop=True)


def test_rolling_matches_pandas(spark):
    check(spark, random_panel(1, [12, 1, 30], False), (3, 5, 10))


@settings(max_examples=8, deadline=None)
@given(
    seed=st.integers(0, 10**6),
    lengths=st.lists(st.integers(1, 25), min_size=1, max_size=3),
    gaps=st.booleans(),
    rows_per_task=st.integers(1, 12),
    window=st.integers(1, 9),
)
def test_split_engines_roll_the_same(spark, seed, lengths, gaps, rows_per_task, window):
    check(spark, random_panel(seed, lengths, gaps), (window,), rows_per_task)


def test_constant_sensor_and_bad_windows(spark, tiny):
    flat = tiny.withColumn("s_1", F.lit(518.67))
    spreads = add_rolling(flat, ["s_1"], (4,)).select("s_1_roll4_std").distinct().collect()
    assert [r[0] for r in spreads] == [0.0]
    with pytest.raises(ValueError, match="at least one row"):
        add_rolling(tiny, ["s_2"], (5, 0))
    assert add_rolling(tiny, ["s_2"], ()).columns == tiny.columns
    assert lookback((5, 10)) == 9 and lookback(()) == 0


def test_one_exchange_for_all_frames(tiny):
    plan = add_rolling(tiny, ["s_2", "s_3"], (5, 10))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_heavy_engine_is_cut_and_others_are_not(spark):
    pdf = random_panel(3, [40, 5], False)
    df = spark.createDataFrame(pdf)
    profile = profile_key(df, rows_per_task=10)
    assert [r["engine_id"] for r in profile.heavy.collect()] == [1] and profile.dense
    panel = split_panel(df, 3, profile, 10)
    sizes = {(r[0], r[1]): r[2] for r in panel.rows.groupBy("engine_id", "_segment").count().collect()}
    assert sizes[(2, 0)] == 5
    assert max(n for (e, _), n in sizes.items() if e == 1) == 13
    assert panel.frame().count() == 45


def test_positions_by_bucket(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 1000).alias("v"))
    placed = with_position(df, ["k"], [F.col("v")], [F.floor(F.col("v") / 10)]).toPandas()
    want = placed.sort_values(["k", "v"]).groupby("k").cumcount() + 1
    assert (placed.loc[want.index, "_pos"] == want).all()
    everywhere = with_position(df, [], [F.col("v")], [F.floor(F.col("v") / 50)]).toPandas().sort_values("v")
    assert list(everywhere["_pos"]) == list(range(1, 1001))
    profile = profile_key(df, "k", None, 10)
    ranked = rank_within(df, "k", [F.col("v")], [F.floor(F.col("v") / 10)], "_pos", profile).toPandas()
    assert ranked.sort_values(["k", "v"]).reset_index(drop=True).equals(placed.sort_values(["k", "v"]).reset_index(drop=True)[ranked.columns])
