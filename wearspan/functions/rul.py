"""Scalar expressions on labels, features and prediction errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearspan.schema import RUL_CAP


def cap_rul(rul: Column, cap: int | None = RUL_CAP) -> Column:
    """Piecewise-linear label: remaining life, no larger than ``cap``."""
    if cap is None:
        return rul.cast("int")
    if cap <= 0:
        raise ValueError("the label cap has to be above zero")
    # least() would skip a missing life and answer with the cap
    return F.when(rul.isNotNull(), F.least(rul, F.lit(cap))).cast("int")


def present(value: Column) -> Column:
    """The value, or null where it is not a number, so that statistics skip it."""
    return F.when(~F.isnan(value), value)


def repair_std(std: Column) -> Column:
    """A spread that can be divided by: missing or exactly zero becomes one."""
    return F.when(std.isNull() | F.isnan(std) | (std == 0), 1.0).otherwise(std)


def clean(value: Column) -> Column:
    """Replace missing and infinite feature values by zero."""
    # NaN sorts above infinity, so one comparison rules out null, NaN and infinity.
    return F.when(F.abs(value) < float("inf"), value).otherwise(0.0)


def nasa_term(truth: Column, prediction: Column) -> Column:
    """One row's share of the asymmetric score: late errors cost more than early ones."""
    # Fixed values of the published score: 13 for early, 10 for late predictions.
    error = prediction - truth
    return F.when(error < 0, F.exp(-error / 13.0) - 1.0).otherwise(F.exp(error / 10.0) - 1.0)


def four_decimals(value: Column) -> Column:
    """Text form used in result tables."""
    return F.format_string("%.4f", value.cast("double"))


def version_of(created_at: Column) -> Column:
    """Run version of a UTC timestamp, such as 20260101T120000Z."""
    return F.date_format(created_at, "yyyyMMdd'T'HHmmss'Z'")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_path(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")
