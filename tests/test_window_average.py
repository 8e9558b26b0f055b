"""The mean of one regression per cell: windows are read once, and batches and tasks merge to the same fit."""

from __future__ import annotations

import numpy as np
import pytest

from wearspan.operators import attribution as at
from wearspan.operators.attribution import fit_window_average

SCHEMA = "window ARRAY<ARRAY<DOUBLE>>, target DOUBLE"


def windows_of(spark, cells, labels, parts):
    rows = [([[float(v) for v in step] for step in w], float(y)) for w, y in zip(cells, labels)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def plain(cells, labels):
    flat = cells.reshape(len(cells), -1)
    off, up = flat - flat.mean(axis=0), labels - labels.mean()
    spread = (off**2).sum(axis=0)
    slopes = np.where(spread > 1e-6, (off * up[:, None]).sum(axis=0) / np.maximum(spread, 1e-6), 0) / flat.shape[1]
    return slopes, labels.mean() - (slopes * flat.mean(axis=0)).sum(), flat.mean(axis=0)


@pytest.mark.parametrize("parts", [1, 5])
def test_windows_are_read_once_and_not_kept(spark, monkeypatch, parts):
    def kept(self, *args):
        raise AssertionError("windows are kept")

    for name in ("persist", "cache"):
        monkeypatch.setattr(type(spark.range(1)), name, kept)
    rng = np.random.default_rng(5)
    cells = rng.normal(1e4, 3, (300, 3, 2))
    cells[:, :, 1] = [0.1, 518.67, 7.0]
    labels = cells[:, 0, 0] * 2 + rng.normal(0, 1, 300)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        fit = fit_window_average(windows_of(spark, cells, labels, parts), 3, ["a", "b"])
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    slopes, intercept, means = plain(cells, labels)
    assert fit.features == ("0:a", "0:b", "1:a", "1:b", "2:a", "2:b") and fit.coefficients[1::2] == (0.0,) * 3
    assert fit.coefficients == pytest.approx(slopes, rel=1e-9) and fit.means == pytest.approx(means, rel=1e-12)
    assert fit.intercept == pytest.approx(intercept, rel=1e-9)


def test_moments_of_parts_add_up():
    rng = np.random.default_rng(6)
    x, y = rng.normal(50, 2, (40, 4)), rng.normal(9, 1, 40)
    of = at.Moments.of
    whole, merged = of(x, y), of(x[:1], y[:1]).with_more(of(x[1:33], y[1:33])).with_more(of(x[33:], y[33:]))
    for name in ("n", "y", "x", "xx", "xy"):
        assert getattr(merged, name) == pytest.approx(getattr(whole, name))


def test_one_window_and_odd_ones(spark):
    fit = fit_window_average(windows_of(spark, [[[1, 2]]], [5], 1), 1, ["a", "b"])
    assert fit.coefficients == (0.0, 0.0) and fit.intercept == 5.0 and fit.means == (1.0, 2.0)
    no_number = fit_window_average(windows_of(spark, [[[float("nan"), 2]], [[1, 3]]], [5, 7], 1), 1, ["a", "b"])
    assert no_number.coefficients == (0.0, 1.0)


@pytest.mark.parametrize("row", [([[None, 1.0]], 2.0), ([[1.0, 1.0]], None), (None, 2.0), ([None], 2.0)])
def test_empty_cells_and_labels_are_errors(spark, row):
    windows = spark.createDataFrame([([[1.0, 2.0]], 3.0), row], SCHEMA).repartition(1)
    with pytest.raises(ValueError, match="no label or an empty cell"):
        fit_window_average(windows, 1, ["a", "b"])
