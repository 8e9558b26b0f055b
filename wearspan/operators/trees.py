"""Additive attributions of tree models, and their nodes as a table.

A prediction of a tree is the mean label at its root plus, for each split on the row's path,
the step from the node's mean to the child's. The steps are summed per feature, so the
contributions and the base value add up to the prediction exactly, for forests and for
boosted trees.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.operators.skew import attach
from wearspan.session import work_folder

NODES = "tree int, id int, prediction double, left int, right int, feature int"
PARTS = "tree int, leaf int, parts array<struct<feature: int, value: double>>"


def tree_nodes(spark: SparkSession, model) -> DataFrame:
    """The nodes of a fitted MLlib forest or boosted model, as it stores them itself."""
    folder = work_folder(spark, "trees")
    model.save(folder)
    node = F.col("nodeData")
    return spark.read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["prediction"].alias("prediction"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
    )


def _leaf_parts(nodes: pd.DataFrame) -> pd.DataFrame:
    """Steps per feature on the way to each leaf of one tree; leaves are numbered from left to right."""
    nodes = nodes.sort_values("id")
    by_id = {n.id: n for n in nodes.itertuples(index=False)}
    found, waiting = [], [(by_id[nodes["id"].iloc[0]], {})]
    while waiting:
        node, steps = waiting.pop()
        if node.left < 0:
            parts = [{"feature": f, "value": v} for f, v in sorted(steps.items())]
            found.append((node.tree, len(found), parts))
            continue
        for child in (by_id[node.right], by_id[node.left]):  # the left one is taken first
            step = child.prediction - node.prediction
            waiting.append((child, {**steps, node.feature: steps.get(node.feature, 0.0) + step}))
    return pd.DataFrame(found, columns=["tree", "leaf", "parts"])


@dataclass(frozen=True)
class TreeFit:
    """A tree model as tables: what each leaf adds per feature (weights included), and the base value."""

    model: object
    features: tuple[str, ...]
    leaves: DataFrame
    base: float

    def release(self) -> None:
        self.leaves.unpersist()


def tree_fit(spark: SparkSession, model, features: Sequence[str]) -> TreeFit:
    """Tables of a forest or a boosted model fitted on ``features`` in this order.

    The tree with the most nodes is one task's share. A fitted model is whole in the
    driver's memory already, and a leaf has at most as many parts as its path has splits.
    """
    boosted = hasattr(model, "evaluateEachIteration")
    weights = [w if boosted else w / len(model.treeWeights) for w in model.treeWeights]
    scale = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("tree") + 1)
    nodes = tree_nodes(spark, model)
    leaves = nodes.groupBy("tree").applyInPandas(_leaf_parts, PARTS).withColumn("_scale", scale)
    scaled = F.transform("parts", lambda p: F.struct(p["feature"].alias("feature"), (p["value"] * F.col("_scale")).alias("value")))
    # every row passes one leaf of the first tree, so it gets a value for each feature
    zeros = F.array(*[F.struct(F.lit(i).alias("feature"), F.lit(0.0).alias("value")) for i in range(len(features))])
    parts = F.when(F.col("tree") == 0, F.concat(scaled, zeros)).otherwise(scaled)
    table = leaves.select("tree", "leaf", parts.alias("parts")).persist()
    roots = nodes.groupBy("tree").agg(F.min_by("prediction", "id").alias("root")).select((F.col("root") * scale).alias("part"))
    base = roots.agg(F.sum("part")).first()[0]
    return TreeFit(model, tuple(features), table, base)


def tree_attribution(df: DataFrame, fit: TreeFit, keys: Sequence[str]) -> DataFrame:
    """Contributions per row and feature: ``keys``, prediction, feature, value (0 where no path asks for it).

    ``df`` has the model's vector column; ``keys`` name a row, so a repeated one must be made distinct
    before. A row meets one leaf per tree, found by the model itself. Its parts are added up before the
    shuffle, which carries one number per row and feature when the leaves are few enough to broadcast.
    """
    model = fit.model.copy()
    model.setLeafCol("_leaves")
    scored = model.transform(df).select(*keys, "prediction", F.posexplode(vector_to_array("_leaves")).alias("tree", "leaf"))
    met = attach(scored.withColumn("leaf", F.col("leaf").cast("int")), fit.leaves, ["tree", "leaf"], "inner")
    steps = met.select(*keys, "prediction", F.inline("parts"))
    names = F.array(*[F.lit(f) for f in fit.features])
    summed = steps.groupBy(*keys, "prediction", "feature").agg(F.sum("value").alias("value"))
    return summed.select(*keys, "prediction", F.element_at(names, F.col("feature") + 1).alias("feature"), "value")
