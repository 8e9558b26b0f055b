from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from wearspan.operators.skew import profile_key
from wearspan.schema import TELEMETRY
from wearspan.session import work_folder
from wearspan.sources.telemetry import load_subset, load_subsets, read_final_rul, read_sensor_log, with_notebook_names, write_sensor_log


def line(engine, cycle):
    return f"{engine} {cycle} 0.0023 0.0003 100.0 " + "  ".join(str(500 + i + 0.25) for i in range(21)) + "  "


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for name in ("FD001", "FD002"):
        (root / f"train_{name}.txt").write_text("\n".join(line(e, c) for e in (1, 2) for c in (1, 2, 3)) + "\n\n")
        (root / f"test_{name}.txt").write_text("\n".join(line(e, c) for e in (1, 2) for c in (1, 2)) + "\n")
        (root / f"RUL_{name}.txt").write_text("112 \n98\n")
    return str(root)


def test_sensor_log(spark, raw):
    df = read_sensor_log(spark, f"{raw}/train_FD001.txt")
    assert df.count() == 6
    assert [f.dataType for f in df.schema] == [f.dataType for f in TELEMETRY]
    row = df.where("engine_id = 2 and cycle = 3").first()
    assert row["setting_1"] == 0.0023 and row["s_1"] == 500.25 and row["s_21"] == 520.25


def test_tabs_and_short_lines(spark, tmp_path):
    (tmp_path / "log.txt").write_text("1\t1   0.5\n   \n2 1 0.25 0.5\n")
    rows = read_sensor_log(spark, str(tmp_path / "log.txt")).orderBy("engine_id").collect()
    assert [(r["engine_id"], r["setting_1"], r["setting_2"], r["s_1"]) for r in rows] == [(1, 0.5, None, None), (2, 0.25, 0.5, None)]


def test_missing_file(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_sensor_log(spark, str(tmp_path / "absent.txt"))


def test_final_rul_is_keyed_by_line(spark, raw, tmp_path):
    got = {r["engine_id"]: r["final_rul"] for r in read_final_rul(spark, f"{raw}/RUL_FD001.txt").collect()}
    assert got == {1: 112, 2: 98}
    values = list(range(1000, 4000))
    (tmp_path / "rul.txt").write_text("".join(f"{v}\n" for v in values))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        frame = read_final_rul(spark, str(tmp_path / "rul.txt"))
        rows = sorted((r["engine_id"], r["final_rul"]) for r in frame.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rows == list(enumerate(values, 1))


def test_load_subset(spark, raw):
    triple = load_subset(spark, "fd001", raw)
    assert (triple.train.count(), triple.test.count(), triple.final_rul.count()) == (6, 4, 2)
    with pytest.raises(ValueError, match="FD009"):
        load_subset(spark, "FD009", raw)
    both = load_subsets(spark, ["FD001", "fd002"], raw)
    assert {r["dataset"]: r["count"] for r in both.train.groupBy("dataset").count().collect()} == {"FD001": 6, "FD002": 6}
    with pytest.raises(ValueError, match="at least one"):
        load_subsets(spark, [], raw)


def test_text_roundtrip(spark, tiny, tmp_path):
    path = str(tmp_path / "out")
    write_sensor_log(tiny, path)
    assert read_sensor_log(spark, path).exceptAll(tiny).count() == 0
    assert with_notebook_names(tiny).columns[:2] == ["unit_nr", "time_cycles"]


def session_like(master, folder):
    settings = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": "hdfs://shared/warehouse"}
    conf = SimpleNamespace(get=lambda name, default=None: settings[name] or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_work_folder_follows_the_session():
    named = session_like("yarn", "hdfs://shared/work/")
    first, second = work_folder(named, "x"), work_folder(named, "x")
    assert first.startswith("hdfs://shared/work/x-") and first != second
    for master in ("local[2]", "yarn"):  # without the setting, the other folder that driver and executors share
        assert work_folder(session_like(master, None), "x").startswith("hdfs://shared/warehouse/_work/x-")


def test_key_profile(tiny):
    assert profile_key(tiny).heavy is None
    cut = profile_key(tiny.where("cycle <> 3"), rows_per_task=3)
    assert cut.rows == 8 and not cut.dense
    assert sorted((r[0], r[1], r[2]) for r in cut.heavy.collect()) == [(1, 1, 5), (2, 1, 5)]
