"""Operating regimes: clusters of the setting columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.functions.rul import present
from wearspan.schema import N_REGIMES, REGIME, SEED, SETTINGS

MAX_ROUNDS = 100
#: Rounds end when the centres of a start moved, squared and summed, by less than this share of the mean variance.
TOLERANCE = 1e-4

Centre = tuple[float, ...]


def _complete(settings: Sequence[str]) -> Column:
    """True on rows whose settings are all finite numbers."""
    whole = F.lit(True)
    for s in settings:
        whole = whole & F.coalesce(F.abs(present(F.col(s))) < float("inf"), F.lit(False))
    return whole


def _nearest(centres: Sequence[Centre], settings: Sequence[str]) -> str:
    """SQL for a struct of the squared distance to the nearest centre and its number, the smallest on ties.

    As text, hundreds of operations are one call to the JVM.
    """
    options = []
    for number, centre in enumerate(centres):
        squares = " + ".join(f"(`{s}` - ({c!r}D)) * (`{s}` - ({c!r}D))" for s, c in zip(settings, centre))
        options.append(f"named_struct('squares', {squares}, 'cluster', {number})")
    return f"least({', '.join(options)})" if len(options) > 1 else options[0]


@dataclass(frozen=True)
class RegimeModel:
    """Fitted cluster centres, in sorted order, which numbers the clusters."""

    centres: tuple[Centre, ...]
    settings: tuple[str, ...]

    def assign(self, df: DataFrame, name: str = REGIME) -> DataFrame:
        """Add the regime id of every row; null where a setting is missing or no finite number."""
        nearest = F.expr(_nearest(self.centres, self.settings))["cluster"]
        return df.withColumn(name, F.when(_complete(self.settings), nearest))


def _draw(points: DataFrame, settings: Sequence[str], starts: Sequence[list[Centre]], seed: int, round_: int) -> list[Centre | None]:
    """One more centre for each start, drawn in proportion to weight times squared distance.

    Each point waits an exponential time at that rate, made from a hash of its settings; the
    shortest wait is drawn. That is one aggregation for all starts and, unlike a draw per
    partition, it does not depend on how the points are spread.
    """
    first = []
    names = ", ".join(f"`{s}`" for s in settings)
    pairs = ", ".join(f"'{s}', `{s}`" for s in settings)
    for number, centres in enumerate(starts):
        squares = f"{_nearest(centres, settings)}.squares" if centres else "1D"
        wait = f"-ln((shiftrightunsigned(xxhash64({seed + number}, {round_}, {names}), 12) + 0.5D) / {2.0**52!r}D)"
        option = f"named_struct('wait', {wait} / (`_weight` * {squares}), {pairs})"
        first.append(F.expr(f"min(if({squares} > 0, {option}, null))").alias(f"_{number}"))
    drawn = points.agg(*first).first()
    return [None if d is None else tuple(d[s] for s in settings) for d in drawn]


def _move(points: DataFrame, settings: Sequence[str], starts: Sequence[tuple[Centre, ...]]) -> list[tuple[tuple[Centre, ...], float]]:
    """For each start the means of its clusters and the cost before the move; empty clusters stay."""
    found = F.expr(f"array({', '.join(_nearest(centres, settings) for centres in starts)})")
    each = points.select(*settings, "_weight", F.posexplode(found).alias("_start", "_found"))
    sums = [F.sum(F.col("_weight") * F.col(s)).alias(s) for s in settings]
    cells = each.groupBy("_start", F.col("_found.cluster").alias("_cluster")).agg(
        F.sum("_weight").alias("_n"), F.sum(F.col("_weight") * F.col("_found.squares")).alias("_cost"), *sums
    )
    moved, cost = [list(centres) for centres in starts], [0.0] * len(starts)
    for r in sorted(cells.collect(), key=lambda r: (r["_start"], r["_cluster"])):  # starts times clusters
        moved[r["_start"]][r["_cluster"]] = tuple(r[s] / r["_n"] for s in settings)
        cost[r["_start"]] += r["_cost"]
    return [(tuple(m), c) for m, c in zip(moved, cost)]


def fit_regimes(
    train: DataFrame,
    n_regimes: int = N_REGIMES,
    seed: int = SEED,
    n_init: int = 10,
    settings: Sequence[str] = SETTINGS,
) -> RegimeModel:
    """Cluster the training settings; the cheapest of ``n_init`` starts wins.

    Equal settings are merged into one weighted point first, so repeated operating points
    cost one row instead of one per cycle; rows without finite settings take no part. Each
    draw and each move is one aggregation over all partitions for all starts together, and what
    returns is one row per start and cluster. Fewer different settings than regimes give
    as many regimes as settings; none at all is an error.
    """
    values = [F.col(s).cast("double").alias(s) for s in settings]
    points = train.where(_complete(settings)).select(*values).groupBy(*settings).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    points = points.persist()
    try:
        starts: list[list[Centre]] = [[] for _ in range(n_init)]
        for round_ in range(n_regimes):
            for centres, drawn in zip(starts, _draw(points, settings, starts, seed, round_)):
                if drawn is not None:
                    centres.append(drawn)
        if not starts[0]:
            raise ValueError("no row has finite settings to cluster")
        fitted = _lloyd(points, settings, [tuple(s) for s in starts])
    finally:
        points.unpersist()
    return RegimeModel(tuple(sorted(fitted)), tuple(settings))


def _lloyd(points: DataFrame, settings: Sequence[str], starts: list[tuple[Centre, ...]]) -> tuple[Centre, ...]:
    """Move all starts until they settle; the centres of the cheapest."""
    total = F.sum("_weight")
    spread = [F.sum(F.col("_weight") * F.col(s) * F.col(s)) / total - F.pow(F.sum(F.col("_weight") * F.col(s)) / total, 2) for s in settings]
    variance = points.agg(sum(spread[1:], spread[0]) / len(settings)).first()[0]
    enough = TOLERANCE * max(variance, 0.0)
    live, centres, cost = list(range(len(starts))), list(starts), [float("inf")] * len(starts)
    for _ in range(MAX_ROUNDS):
        moves = _move(points, settings, [centres[i] for i in live])
        still = []
        for i, (moved, before) in zip(live, moves):
            shift = sum((a - b) ** 2 for old, new in zip(centres[i], moved) for a, b in zip(old, new))
            centres[i], cost[i] = moved, before
            if shift > enough:
                still.append(i)
        live = still
        if not live:
            break
    return centres[min(range(len(starts)), key=lambda i: (cost[i], i))]
