"""Regression metrics for remaining life, overall or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.functions.rul import nasa_term
from wearspan.schema import RUL


def mse(truth: Column, prediction: Column) -> Column:
    return F.avg((prediction - truth) * (prediction - truth))


def r_squared(truth: Column, prediction: Column) -> Column:
    """1 − SSE/SST; a constant truth scores 1 when met exactly and 0 otherwise."""
    sse = F.sum((truth - prediction) * (truth - prediction))
    sst = F.var_pop(truth) * F.count(truth)
    flat = F.when(sse == 0, 1.0).otherwise(0.0)
    score = F.when(F.min(truth) == F.max(truth), flat).otherwise(F.lit(1.0) - F.try_divide(sse, sst))
    return F.when(F.count(truth) >= 2, score)


def metric_columns(truth: str | Column = RUL, prediction: str | Column = "prediction") -> list[Column]:
    """The four metrics as aggregates over one pass."""
    y = (F.col(truth) if isinstance(truth, str) else truth).cast("double")
    p = (F.col(prediction) if isinstance(prediction, str) else prediction).cast("double")
    return [
        F.sqrt(mse(y, p)).alias("rmse"),
        F.avg(F.abs(p - y)).alias("mae"),
        r_squared(y, p).alias("r2"),
        F.sum(nasa_term(y, p)).alias("nasa_score"),
    ]


def evaluate(df: DataFrame, by: Sequence[str] = (), truth: str = RUL, prediction: str = "prediction") -> DataFrame:
    """Row count and metrics of a scored frame, one row per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *metric_columns(truth, prediction))


def metrics_dict(df: DataFrame, truth: str = RUL, prediction: str = "prediction") -> dict[str, float]:
    """The four metrics of a scored frame as numbers."""
    row = evaluate(df, (), truth, prediction).first()
    return {name: row[name] for name in ("rmse", "mae", "r2", "nasa_score")}


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of batch values weighted by batch size; an empty input gives zero."""
    total = F.coalesce(F.sum(value * weight), F.lit(0.0))
    return total / F.greatest(F.coalesce(F.sum(weight), F.lit(0)), F.lit(1))


def ranked_leaderboard(runs: DataFrame, within: Sequence[str] = ("dataset",)) -> DataFrame:
    """Rank runs per metric: small is good for rmse, mae and nasa_score, large for r2."""
    low = {name: F.col(name).asc() for name in ("rmse", "mae", "nasa_score")}
    order = {**low, "r2": F.col("r2").desc()}
    group = Window.partitionBy(*within)
    return runs.withColumns({f"{name}_rank": F.rank().over(group.orderBy(o)) for name, o in order.items()})


def early_stopping(
    history: DataFrame, run: Sequence[str], epoch: str = "epoch", loss: str = "validation_loss", patience: int = 10
) -> DataFrame:
    """Follow a loss history: best value so far, epochs since it, and where training would stop.

    A history has one row per epoch of a run, so its windows are small.
    """
    order = Window.partitionBy(*run).orderBy(epoch)
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.min(loss).over(past)
    improved = best_before.isNull() | (F.col(loss) < best_before)
    ranked = history.withColumns({"_n": F.row_number().over(order), "improved": improved})
    last_best = F.max(F.when(F.col("improved"), F.col("_n"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    followed = ranked.withColumns(
        {
            "best_loss": F.min(loss).over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "epochs_since_best": (F.col("_n") - last_best).cast("int"),
        }
    )
    reached = F.max((F.col("epochs_since_best") >= patience).cast("int")).over(past)
    return followed.withColumn("stopped_before", F.coalesce(reached, F.lit(0)) == 1).drop("_n")
