"""Additive feature attributions as long tables.

A table has one row per (sample, feature) or (sample, timestep, feature) with the
signed contribution ``value``. For a linear model the contribution
``coefficient · (x − mean)`` is the exact Shapley value, and contributions plus
the base value add up to the prediction.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.operators.metrics import mse
from wearspan.operators.skew import ROWS_PER_TASK
from wearspan.operators.splits import FINE, scrambled_hash
from wearspan.schema import CYCLE, ENGINE, RUL


@dataclass(frozen=True)
class LinearFit:
    """Coefficients, intercept and training means of an ordinary least-squares fit."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    means: tuple[float, ...]

    @property
    def base(self) -> float:
        """Prediction at the training means."""
        return self.intercept + sum(c * m for c, m in zip(self.coefficients, self.means))

    def predict(self) -> Column:
        """Prediction as a plain expression, without leaving the JVM."""
        out = F.lit(self.intercept)
        for name, c in zip(self.features, self.coefficients):
            out = out + F.lit(c) * F.col(name)
        return out


def fit_linear(train: DataFrame, features: Sequence[str], target: str = RUL) -> LinearFit:
    """Least squares and feature means; the assembled columns are computed once and shared."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="_x").transform(train)
    return _least_squares(assembled.select("_x", F.col(target).cast("double").alias("_y")), features, 0.0)


def _least_squares(vectors: DataFrame, names: Sequence[str], ridge: float) -> LinearFit:
    shared = vectors.persist()
    try:
        means = shared.select(Summarizer.mean(F.col("_x")).alias("m")).first()["m"]
        model = LinearRegression(featuresCol="_x", labelCol="_y", solver="normal", regParam=ridge).fit(shared)
    finally:
        shared.unpersist()
    return LinearFit(
        tuple(names), tuple(float(c) for c in model.coefficients), float(model.intercept), tuple(float(m) for m in means)
    )


def _ranked_parts(fit: LinearFit) -> Column:
    """A row's contributions as an array, largest absolute value first (last feature on ties)."""
    parts = []
    for i, (name, c, m) in enumerate(zip(fit.features, fit.coefficients, fit.means)):
        value = F.lit(c) * (F.col(name) - F.lit(m))
        parts.append(
            F.struct(
                (-F.abs(value)).alias("size"),
                F.lit(-i).alias("place"),
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("feature"),
                value.alias("value"),
            )
        )
    return F.array_sort(F.array(*parts))


def linear_attribution(df: DataFrame, fit: LinearFit, keys: Sequence[str]) -> DataFrame:
    """Ranked contribution of every feature to every sample's prediction.

    ``running`` is the prediction built up from the base value in rank order. A
    sample's features are ranked inside its row, so no data is shuffled.
    """
    ranked = df.select(*keys, _ranked_parts(fit).alias("_parts"))
    none = F.array().cast("array<struct<ordinal:int,feature:string,value:double,rank:int,running:double>>")

    def step(state: Column, part: Column) -> Column:
        total = state["total"] + part["value"]
        place = (F.size(state["rows"]) + 1).alias("rank")
        row = F.struct(part["ordinal"], part["feature"], part["value"], place, total.alias("running"))
        return F.struct(total.alias("total"), F.concat(state["rows"], F.array(row)).alias("rows"))

    built = F.aggregate("_parts", F.struct(F.lit(fit.base).alias("total"), none.alias("rows")), step, lambda s: s["rows"])
    return ranked.select(*keys, F.inline(built))


def fit_window_linear(windows: DataFrame, size: int, features: Sequence[str], target: str = "target") -> LinearFit:
    """Ridge-stabilised linear model on flattened windows; cell t·F+f is named ``t:feature``."""
    names = [f"{t}:{f}" for t in range(size) for f in features]
    cells = F.flatten(F.col("window")).cast("array<double>")
    vectors = windows.select(array_to_vector(cells).alias("_x"), F.col(target).cast("double").alias("_y"))
    return _least_squares(vectors, names, 1e-6)


MOMENTS = "n BIGINT, missing BIGINT, y DOUBLE, x ARRAY<DOUBLE>, xx ARRAY<DOUBLE>, xy ARRAY<DOUBLE>"


@dataclass(frozen=True)
class Moments:
    """Count and means of cells and label, with sums of squares (xx) and of products with the label (xy) about the means."""

    n: int
    y: float
    x: np.ndarray
    xx: np.ndarray
    xy: np.ndarray

    @staticmethod
    def of(x: np.ndarray, y: np.ndarray) -> Moments:
        # from the first row, so that a cell that never varies has a spread of exactly nothing
        off = x - x[0]
        centre = off.mean(axis=0)
        off -= centre
        return Moments(len(x), float(y.mean()), x[0] + centre, np.einsum("ij,ij->j", off, off), (y - y.mean()) @ off)

    def with_more(self, more: Moments) -> Moments:
        n = self.n + more.n
        step, rise, share = more.x - self.x, more.y - self.y, more.n / n
        return Moments(
            n,
            self.y + rise * share,
            self.x + step * share,
            self.xx + more.xx + step * step * (self.n * share),
            self.xy + more.xy + step * (rise * self.n * share),
        )


def _window_moments(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, missing = None, 0
        with np.errstate(invalid="ignore", over="ignore"):  # as in Spark, a cell that is no number gives no number
            for batch in batches:
                cells, labels = batch.columns
                missing += cells.null_count + labels.null_count + cells.flatten().null_count
                if missing or not len(batch):
                    continue
                if not pc.all(pc.equal(pc.list_value_length(cells), width)).as_py():
                    raise ValueError(f"a window doesn't have {width} cells")
                x = cells.flatten().to_numpy().astype(float).reshape(-1, width)
                found = Moments.of(x, labels.to_numpy())
                total = found if total is None else total.with_more(found)
        if total is not None or missing:
            t = total or Moments(0, 0.0, *(np.zeros(width),) * 3)
            row = {"n": t.n, "missing": missing, "y": t.y, "x": t.x.tolist(), "xx": t.xx.tolist(), "xy": t.xy.tolist()}
            yield pa.RecordBatch.from_pylist([row])

    return run


def fit_window_average(windows: DataFrame, size: int, features: Sequence[str], target: str = "target") -> LinearFit:
    """The mean of one simple regression per cell of the flattened windows.

    Unlike least squares over all cells it stays stable when neighbouring cells say the same. Windows
    are read once and not kept: a task merges the moments of its batches to one row, and those rows are
    merged here. A cell that never varies has slope 0; a window without label or with an empty cell is an error.
    """
    names = [f"{t}:{f}" for t in range(size) for f in features]
    cells = windows.select(F.flatten("window").alias("_x"), F.col(target).cast("double").alias("_y"))
    rows = cells.mapInArrow(_window_moments(len(names)), MOMENTS).collect()
    if any(r["missing"] for r in rows):
        raise ValueError("a window has no label or an empty cell")
    if not rows:
        raise ValueError("no window to fit on")
    with np.errstate(invalid="ignore", over="ignore"):
        found = reduce(Moments.with_more, (Moments(r["n"], r["y"], *(np.array(r[c]) for c in ("x", "xx", "xy"))) for r in rows))
    slopes = tuple(float(c / v) / len(names) if v > 0 else 0.0 for c, v in zip(found.xy, found.xx))
    means = tuple(map(float, found.x))
    return LinearFit(tuple(names), slopes, found.y - sum(c * m for c, m in zip(slopes, means)), means)


def score_windows(windows: DataFrame, fit: LinearFit) -> DataFrame:
    """Add the linear prediction of every window."""
    weights = F.lit(list(fit.coefficients))
    products = F.zip_with(F.flatten("window"), weights, lambda x, c: x.cast("double") * c)
    total = F.aggregate(products, F.lit(fit.intercept), lambda acc, v: acc + v)
    return windows.withColumn("prediction", total)


def window_attribution(windows: DataFrame, fit: LinearFit, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Contribution of every cell: one row per (sample, timestep, feature)."""
    model = F.arrays_zip(
        F.flatten("window").alias("x"), F.lit(list(fit.coefficients)).alias("c"), F.lit(list(fit.means)).alias("m")
    )
    width = len(features)
    names = F.array(*[F.lit(f) for f in features])
    cells = windows.select(*keys, F.posexplode(model).alias("_cell", "_part"))
    part = F.col("_part")
    return cells.select(
        *keys,
        F.floor(F.col("_cell") / F.lit(width)).cast("int").alias("timestep"),
        F.element_at(names, F.col("_cell") % width + 1).alias("feature"),
        (part["c"] * (part["x"].cast("double") - part["m"])).alias("value"),
    )


def mean_importance(attributions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute contribution per feature, per sample (``by``) or over all of them."""
    return attributions.groupBy(*by, "feature").agg(F.avg(F.abs("value")).alias("importance"))


def rank_attributions(attributions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number the features of each sample by falling absolute contribution, for any long table.

    A sample has as many rows as the model has features, so the window is small.
    """
    order = Window.partitionBy(*keys).orderBy(F.abs("value").desc(), F.col("ordinal").desc())
    return attributions.withColumn("rank", F.row_number().over(order))


def waterfall(ranked: DataFrame, keys: Sequence[str], base: float) -> DataFrame:
    """Running prediction from the base value, feature by feature in rank order."""
    frame = Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("running", F.lit(base) + F.sum("value").over(frame))


def top_features(importance: DataFrame, k: int) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(k)


def worst_sample(scored: DataFrame, keys: Sequence[str], truth: str = RUL, prediction: str = "prediction") -> DataFrame:
    """The sample with the largest absolute error (first key on ties)."""
    error = F.abs(F.col(prediction) - F.col(truth))
    return scored.withColumn("abs_error", error).orderBy(F.col("abs_error").desc(), *keys).limit(1)


def explanation_records(
    df: DataFrame,
    fit: LinearFit,
    keys: Sequence[str],
    model_name: str,
    dataset: str,
    explainer_type: str = "LinearExplainer",
    background_n: int = 0,
) -> DataFrame:
    """One nested record per sample: prediction, sorted importances and provenance."""
    parts = df.select(*keys, fit.predict().alias("_prediction"), _ranked_parts(fit).alias("_parts"))
    in_order = F.array_sort(F.transform("_parts", lambda p: F.struct(p["ordinal"], p["value"])))
    return parts.select(
        *keys,
        F.lit(model_name).alias("model_name"),
        F.lit(dataset).alias("dataset"),
        F.col("_prediction").alias("rul_prediction"),
        F.map_from_arrays(F.col("_parts.feature"), F.transform("_parts", lambda p: F.abs(p["value"]))).alias(
            "feature_importances"
        ),
        F.lit(None).cast("array<array<double>>").alias("shap_values_full"),
        F.struct(
            F.lit(explainer_type).alias("explainer_type"),
            F.lit(background_n).alias("background_n"),
            F.transform(in_order, lambda p: p["value"]).alias("shap_values_1d"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("explained_at"),
        ).alias("explanation_metadata"),
    )


def sequence_explanation_records(
    windows: DataFrame,
    fit: LinearFit,
    features: Sequence[str],
    keys: Sequence[str],
    model_name: str,
    dataset: str | None,
    explainer_type: str = "LinearExplainer",
    background_n: int = 0,
) -> DataFrame:
    """One nested record per window, made within its row: no cell is exploded or shuffled.

    ``shap_values_full`` has one array per time step with a value per feature; the importance of a
    feature is its mean absolute value over the steps, largest first (the last feature on ties).
    With the base value all cells add up to the prediction. ``dataset`` is None where the keys name it.
    """
    width, steps = len(features), len(fit.features) // len(features)
    model = F.arrays_zip(F.flatten("window").alias("x"), F.lit(list(fit.coefficients)).alias("c"), F.lit(list(fit.means)).alias("m"))
    cells = F.transform(model, lambda p: p["c"] * (p["x"].cast("double") - p["m"]))
    matrix = F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda t: F.slice("_cells", t * width + 1, F.lit(width)))
    names = F.array(*[F.lit(f) for f in features])

    def size_of(f: Column) -> Column:
        return F.aggregate("_matrix", F.lit(0.0), lambda total, row: total + F.abs(F.get(row, f))) / steps

    sizes = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda f: F.struct((-size_of(f)).alias("low"), (-f).alias("back")))
    ranked = windows.select(*keys, cells.alias("_cells")).withColumn("_matrix", matrix).withColumn("_ranked", F.array_sort(sizes))
    return ranked.select(
        *keys,
        F.lit(model_name).alias("model_name"),
        *([] if dataset is None else [F.lit(dataset).alias("dataset")]),
        F.aggregate("_cells", F.lit(fit.base), lambda total, v: total + v).alias("rul_prediction"),
        F.map_from_arrays(
            F.transform("_ranked", lambda r: F.element_at(names, 1 - r["back"])), F.transform("_ranked", lambda r: -r["low"])
        ).alias("feature_importances"),
        F.col("_matrix").alias("shap_values_full"),
        F.struct(
            F.lit(explainer_type).alias("explainer_type"),
            F.lit(background_n).alias("background_n"),
            F.lit(fit.base).alias("base_value"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("explained_at"),
        ).alias("explanation_metadata"),
    )


def explanation_json(records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Records as JSON text, one per sample."""
    body = [c for c in records.columns if c not in keys]
    return records.select(*keys, F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("json"))


def shuffled_values(
    df: DataFrame,
    features: Sequence[str],
    engine: str = ENGINE,
    cycle: str = CYCLE,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Give every row the feature values of another row, under ``<name>_shuffled``.

    All rows form one ring in the order of a scrambled hash, and each takes the values
    of the next. Cells of neighbouring hashes, as many as the row count needs, are
    ordered apart; the last row of a cell takes those of the next cell's first, so the
    permutation does not depend on the number of cells.
    """
    cells = max(1, -(-df.count() // rows_per_task))
    hashed = df.withColumn("_hash", scrambled_hash(engine, cycle))
    hashed = hashed.withColumn("_cell", F.floor(F.col("_hash") * cells / F.lit(FINE)))
    values = F.struct(*features)
    # one row per cell
    firsts = hashed.groupBy("_cell").agg(F.min_by(values, F.struct("_hash", engine, cycle)).alias("_first"))
    around = Window.orderBy("_cell")
    nexts = firsts.select(
        F.col("_cell").alias("_of"), F.coalesce(F.lead("_first").over(around), F.first("_first").over(around)).alias("_next")
    )
    inside = hashed.withColumn("_other", F.lead(values).over(Window.partitionBy("_cell").orderBy("_hash", engine, cycle)))
    taken = inside.join(nexts, F.col("_cell") == F.col("_of")).withColumn("_other", F.coalesce("_other", "_next"))
    return taken.select(*df.columns, *[F.col("_other")[c].alias(f"{c}_shuffled") for c in features])


def permutation_importance(
    df: DataFrame,
    features: Sequence[str],
    predict,
    truth: str = RUL,
    engine: str = ENGINE,
    cycle: str = CYCLE,
) -> DataFrame:
    """Rise of the RMSE when one feature is shuffled.

    ``predict`` maps a frame with the feature columns to one with ``prediction``.
    Every row is scored once as it is and once per feature, in a single job.
    """
    paired = shuffled_values(df, features, engine, cycle)
    variants = paired.withColumn("feature", F.explode(F.array(F.lit(""), *[F.lit(f) for f in features])))
    swapped = variants.withColumns(
        {f: F.when(F.col("feature") == f, F.col(f"{f}_shuffled")).otherwise(F.col(f)) for f in features}
    )
    y, p = F.col(truth).cast("double"), F.col("prediction").cast("double")
    scores = predict(swapped).groupBy("feature").agg(F.sqrt(mse(y, p)).alias("rmse"))
    plain = F.max(F.when(F.col("feature") == "", F.col("rmse"))).over(Window.partitionBy())
    return (
        scores.withColumn("base_rmse", plain)
        .where(F.col("feature") != "")
        .select("feature", "base_rmse", "rmse", (F.col("rmse") - F.col("base_rmse")).alias("importance"))
    )
