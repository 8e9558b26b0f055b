"""Batch scoring with a registered model and its feature contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.sources.catalog import RunCatalog

# Fixed value: model families that score feature tables.
TABULAR_FAMILIES = ("gradient_boosting", "random_forest", "linear")
PREVIEW = 8


class UnsupportedModelError(RuntimeError):
    """The model family cannot score feature tables."""


class FeatureContractError(ValueError):
    """The input does not have exactly the registered features."""


def contract_problem(given: Column, contract: Sequence[str]) -> Column:
    """How an array of feature names departs from the contract, or null if it does not."""
    wanted = F.array(*[F.lit(name) for name in contract]).cast("array<string>")

    def told(label: str, names: Column) -> Column:
        shown = F.array_join(F.slice(names, 1, PREVIEW), ", ")
        return F.when(F.size(names) > 0, F.concat(F.lit(f"{label} ("), F.size(names).cast("string"), F.lit("): "), shown))

    lacking, surplus = F.array_except(wanted, given), F.array_sort(F.array_except(given, wanted))
    return F.nullif(F.concat_ws("; ", told("Missing features", lacking), told("features not registered", surplus)), F.lit(""))


def check_features(spark: SparkSession, given: Sequence[str], contract: Sequence[str]) -> None:
    """Raise if the names are not those of the contract; the same test as for streamed requests."""
    names = F.array(*[F.lit(name) for name in given]).cast("array<string>")
    problem = spark.range(1).select(contract_problem(names, contract)).first()[0]
    if problem:
        raise FeatureContractError(problem)


def check_family(model_name: str) -> None:
    if model_name not in TABULAR_FAMILIES:
        raise UnsupportedModelError(f"model family '{model_name}' does not score feature tables")


def apply_contract(df: DataFrame, contract: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Keys, then the registered features in their order as doubles."""
    check_features(df.sparkSession, [c for c in df.columns if c not in keys], contract)
    return df.select(*keys, *[F.col(name).cast("double") for name in contract])


def contract_from_map(df: DataFrame, contract: Sequence[str], column: str = "features", keys: Sequence[str] = ()) -> DataFrame:
    """Spread a map of feature values into the registered columns; absent features are null."""
    return df.select(*keys, *[F.try_element_at(column, F.lit(name)).cast("double").alias(name) for name in contract])


def score_with(model: PipelineModel, contract: Sequence[str], df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return model.transform(apply_contract(df, contract, keys)).select(*keys, "prediction")


def score(
    catalog: RunCatalog,
    df: DataFrame,
    model_name: str,
    dataset: str,
    version: str = "latest",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Score a feature table with a registered run."""
    check_family(model_name)
    record, model = catalog.load(model_name, dataset, version)
    scored = score_with(model, record["feature_columns"], df, keys)
    return scored.select(
        *keys,
        F.lit(record["model_name"]).alias("model_name"),
        F.lit(record["dataset"]).alias("dataset"),
        F.lit(record["version"]).alias("model_version"),
        F.col("prediction").alias("rul_prediction"),
    )
