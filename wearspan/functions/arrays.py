"""Expressions on sequence windows held as arrays.

A window is ``array<array<double>>`` with one inner array per time step; a
channel is the ``array<double>`` of one feature over the window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def channels(window: Column, n_features: int) -> Column:
    """Transpose a window from time-major to feature-major order."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(n_features)), lambda f: F.transform(window, lambda step: F.element_at(step, f))
    )


def flat(window: Column) -> Column:
    """All cells of a window in one array, step by step."""
    return F.flatten(window)


def last_step(window: Column) -> Column:
    return F.element_at(window, -1)


def channel_mean(channel: Column) -> Column:
    return F.aggregate(channel, F.lit(0.0), lambda acc, x: acc + x) / F.size(channel)


def _bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def instance_normalize(channel: Column, eps: float = 1e-5, scale: float = 1.0, shift: float = 0.0) -> Column:
    """Scale one channel by its own mean and population spread (floored at ``eps``)."""

    def centre(mean: Column) -> Column:
        return F.transform(channel, lambda x: x - mean)

    def rescale(centred: Column) -> Column:
        squares = F.aggregate(centred, F.lit(0.0), lambda acc, x: acc + x * x)
        spread = F.greatest(F.sqrt(squares / F.size(centred)), F.lit(eps))
        return _bind(spread, lambda sd: F.transform(centred, lambda x: x / sd * F.lit(scale) + F.lit(shift)))

    return _bind(_bind(channel_mean(channel), centre), rescale)


def patch_count(window_size: int, length: int, stride: int) -> int:
    """Number of patches a window is cut into; rejects impossible sizes."""
    if length <= 0:
        raise ValueError("a patch needs at least one step")
    if stride <= 0:
        raise ValueError("patches need a stride of at least one step")
    if length > window_size:
        raise ValueError("a patch cannot be longer than its window")
    return 1 + (window_size - length) // stride


def patches(channel: Column, window_size: int, length: int, stride: int) -> Column:
    """Cut one channel into overlapping sub-arrays of equal length."""
    count = patch_count(window_size, length, stride)
    return F.transform(
        F.sequence(F.lit(0), F.lit(count - 1)), lambda p: F.slice(channel, p * stride + 1, length)
    )
