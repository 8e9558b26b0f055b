import pytest
from pyspark.sql import functions as F

from conftest import keyed
from wearspan.functions.rul import cap_rul
from wearspan.operators import skew
from wearspan.operators.labels import add_test_rul, add_train_rul, join_last_cycle, label_breaks, missing_final_rul


def test_train_label_falls_to_zero_and_is_capped(tiny):
    labelled = add_train_rul(tiny, cap=3)
    assert keyed(labelled, "rul") == {(e, c): min(5 - c, 3) for e in (1, 2) for c in range(1, 6)}
    assert dict(labelled.dtypes)["rul"] == "int"
    checks = label_breaks(labelled).collect()
    assert all(r["violations"] == 0 and r["last_rul"] == 0 and r["top_rul"] <= 3 for r in checks)


def test_no_cap_and_bad_cap(tiny):
    assert keyed(add_train_rul(tiny, cap=None), "rul")[(1, 1)] == 4
    for cap in (0, -5):
        with pytest.raises(ValueError, match="above zero"):
            cap_rul(F.lit(1), cap)


def test_test_label_counts_on_from_the_official_value(spark, tiny):
    final = spark.createDataFrame([(1, 10), (2, 20)], "engine_id int, final_rul int")
    labels = keyed(add_test_rul(tiny, final, cap=None), "rul")
    assert labels[(1, 5)] == 10 and labels[(1, 1)] == 14
    assert labels[(2, 5)] == 20 and labels[(2, 1)] == 24
    assert keyed(add_test_rul(tiny, final, cap=12), "rul")[(2, 5)] == 12


def test_missing_official_value_is_an_error(spark, tiny):
    final = spark.createDataFrame([(1, 10)], "engine_id int, final_rul int")
    assert [r[0] for r in missing_final_rul(tiny, final).collect()] == [2]
    with pytest.raises(ValueError, match=r"\[2\]"):
        add_test_rul(tiny, final)


def test_other_key_names(tiny):
    renamed = tiny.withColumnsRenamed({"engine_id": "unit_nr", "cycle": "time_cycles"})
    out = add_train_rul(renamed, engine="unit_nr", cycle="time_cycles")
    assert out.where("rul = 0").count() == 2


@pytest.mark.parametrize("rows_per_task", [1, 2, 3, 100])
def test_split_engines_get_the_same_labels(spark, tiny, rows_per_task):
    final = spark.createDataFrame([(1, 10), (2, 20)], "engine_id int, final_rul int")
    assert keyed(add_train_rul(tiny, 3, rows_per_task=rows_per_task), "rul") == keyed(add_train_rul(tiny, 3), "rul")
    split = add_test_rul(tiny, final, 12, rows_per_task=rows_per_task)
    assert keyed(split, "rul") == keyed(add_test_rul(tiny, final, 12), "rul")


@pytest.mark.parametrize("limit", [0, 1, 1000])
def test_lookup_join_is_the_same_with_and_without_broadcast(tiny, monkeypatch, limit):
    profile = skew.profile_key(tiny, rows_per_task=3)
    assert profile.heavy.count() == 2 and profile.dense
    monkeypatch.setattr(skew, "BROADCAST_KEYS", limit)
    joined = join_last_cycle(tiny, profile)
    assert keyed(joined, "max_cycle") == {(e, c): 5 for e in (1, 2) for c in range(1, 6)}
    assert keyed(join_last_cycle(tiny, skew.KeyProfile(10)), "max_cycle") == keyed(joined, "max_cycle")


def test_missing_life_is_no_label(spark, tiny):
    final = spark.createDataFrame([(1, 10), (2, None)], "engine_id int, final_rul int")
    assert [r[0] for r in missing_final_rul(tiny, final).collect()] == [2]
    with pytest.raises(ValueError, match="1 engines"):
        add_test_rul(tiny, final)
    labels = keyed(add_test_rul(tiny, final, check=False), "rul")
    assert all(v is None for (e, _), v in labels.items() if e == 2)
    assert labels[(1, 5)] == 10
