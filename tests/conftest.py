import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wearspan.schema import SENSORS, TELEMETRY
from wearspan.session import local_session

os.environ.setdefault("PYARROW_IGNORE_TIMEZONE", "1")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", partitions=4, work=str(tmp_path_factory.mktemp("work")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def panel_rows(engines, cycles, shift=0.0):
    """Small panel: sensors rise with engine, cycle and sensor number."""
    rows = []
    for e in engines:
        for c in range(1, cycles + 1):
            settings = (float(e) + shift, float(c % 2), 100.0)
            rows.append((e, c, *settings, *[float(e * 100 + c + i) for i in range(len(SENSORS))]))
    return rows


@pytest.fixture(scope="session")
def tiny(spark):
    return spark.createDataFrame(panel_rows([1, 2], 5), TELEMETRY).cache()


def keyed(df, *columns):
    """Rows as a dictionary from (engine, cycle) to a value or tuple of values."""
    out = {}
    for r in df.select("engine_id", "cycle", *columns).collect():
        out[(r[0], r[1])] = r[2] if len(columns) == 1 else tuple(r[2:])
    return out
