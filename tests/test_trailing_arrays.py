"""A machine's batch is advanced with arrays: pandas sorts and joins cost more than the numbers of a small group."""

import numpy as np
import pandas as pd

from wearspan.streaming.trailing import advance


def test_no_pandas_operation_per_machine(monkeypatch):
    rows = pd.DataFrame({"engine_id": [7] * 5, "cycle": [4, 2, 3, 3, 1], "s_2": [8.0, 2.0, np.nan, 9.0, 5.0]})

    def refuse(*_, **__):
        raise AssertionError("a pandas operation per machine")

    for name in ("sort_values", "assign", "duplicated"):
        monkeypatch.setattr(pd.DataFrame, name, refuse)
    monkeypatch.setattr(pd, "concat", refuse)
    out, last, ring = advance(rows, 1, np.array([[1.0]]), ["s_2"], (2,))
    assert out["cycle"].tolist() == [2, 3, 4, 1, 3] and out["late"].tolist() == [False, False, False, True, True]
    assert out["s_2_roll2_mean"].tolist()[:3] == [1.5, 2.0, 8.0] and out["s_2_roll2_mean"].isna().tolist() == [False] * 3 + [True] * 2
    assert last == 4 and ring.tolist() == [[8.0]]
