"""A file catalogue of model runs: saved models, their metadata, and lookups."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearspan.functions.rul import base_name, four_decimals, parent_path
from wearspan.schema import RUN_RECORD


class ModelNotFoundError(RuntimeError):
    """No run, or no saved model, matches the request."""


# Fixed value: timestamp layout of run versions.
VERSION_FORMAT = "%Y%m%dT%H%M%SZ"


def matching(runs: DataFrame, model_name: str | None = None, dataset: str | None = None) -> DataFrame:
    """Filter runs by model and dataset, where given."""
    for column, wanted in (("model_name", model_name), ("dataset", dataset)):
        if wanted is not None:
            runs = runs.where(F.col(column) == wanted)
    return runs


def list_runs(runs: DataFrame, model_name: str | None = None, dataset: str | None = None) -> DataFrame:
    """Matching runs, newest first."""
    newest = [F.to_timestamp("created_at").desc(), F.col("version").desc(), F.col("model_name"), F.col("dataset")]
    return matching(runs, model_name, dataset).orderBy(*newest)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of every (model, dataset)."""
    return _first_of(
        runs, ["model_name", "dataset"], [F.to_timestamp("created_at").desc(), F.col("version").desc()]
    )


def best_runs(runs: DataFrame, metric: str = "rmse") -> DataFrame:
    """The run with the smallest metric of every dataset (oldest on ties)."""
    return _first_of(runs, ["dataset"], [F.col(metric), F.to_timestamp("created_at"), F.col("model_name")])


def _first_of(runs: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return runs.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def coverage(runs: DataFrame, datasets: Sequence[str]) -> DataFrame:
    """Runs per model and dataset as a matrix."""
    counted = runs.groupBy("model_name").pivot("dataset", list(datasets)).agg(F.count(F.lit(1)))
    return counted.na.fill(0)


def result_rows(runs: DataFrame) -> DataFrame:
    """Leaderboard lines with four-decimal metrics."""
    cells = [F.col("model_name"), F.col("dataset"), *[four_decimals(F.col(m)) for m in ("rmse", "mae", "r2", "nasa_score")]]
    return runs.withColumn("line", F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")))


@dataclass(frozen=True)
class RunCatalog:
    """Runs under ``<root>/<model>/<dataset>/<version>/``: ``metadata.json`` beside the model."""

    spark: SparkSession
    root: str

    # --- storage -----------------------------------------------------------

    def _fs(self, path: str):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        target = hadoop.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def exists(self, path: str) -> bool:
        fs, target = self._fs(path)
        return fs.exists(target)

    def _write_text(self, path: str, text: str) -> None:
        fs, target = self._fs(path)
        out = fs.create(target, True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()

    # --- writing -----------------------------------------------------------

    def save(
        self,
        model: PipelineModel | None,
        model_name: str,
        dataset: str,
        metrics: dict[str, float],
        params: dict[str, Any],
        feature_columns: Sequence[str],
        description: str = "",
        input_size: int | None = None,
    ) -> dict[str, Any]:
        """Store a model with its metadata under a new UTC version.

        ``model=None`` records the metadata alone (models kept elsewhere).
        """
        place, created = self._claim(model_name, dataset)
        if model is not None:
            model.write().overwrite().save(f"{place}/model")
        values = {
            "artifact_path": f"{place}/model",
            "created_at": created.isoformat(timespec="microseconds"),
            "dataset": dataset,
            "description": description,
            "feature_columns": [*feature_columns],
            "input_size": input_size,
            "metadata_path": f"{place}/metadata.json",
            "metrics": metrics,
            "model_name": model_name,
            "params": params,
            "version": place.rpartition("/")[2],
        }
        record = {f.name: values[f.name] for f in RUN_RECORD if values.get(f.name) is not None}
        self._write_text(record["metadata_path"], json.dumps(record, sort_keys=True))
        return record

    def _claim(self, model_name: str, dataset: str) -> tuple[str, datetime]:
        """A version folder that no other saver has: the first second from now whose mark can be created."""
        created = datetime.now(timezone.utc)
        while True:
            place = self._home(model_name, dataset, created)
            fs, mark = self._fs(f"{place}/_claimed")
            if not fs.exists(mark) and fs.createNewFile(mark):
                return place, created
            created += timedelta(seconds=1)

    def _home(self, model_name: str, dataset: str, created: datetime) -> str:
        return f"{self.root.rstrip('/')}/{model_name}/{dataset}/{created.strftime(VERSION_FORMAT)}"

    def append_results(self, path: str, results: Sequence[tuple[str, str, dict[str, float], str | None]]) -> None:
        """Append leaderboard rows to a results table."""
        rows = [(n, d, m["rmse"], m["mae"], m["r2"], m["nasa_score"], v) for n, d, m, v in results]
        frame = self.spark.createDataFrame(
            rows, "model_name string, dataset string, rmse double, mae double, r2 double, nasa_score double, version string"
        )
        result_rows(frame).write.mode("append").json(path)

    # --- reading -----------------------------------------------------------

    def runs(self) -> DataFrame:
        """Every ``metadata.json`` below the root, as one table."""
        if not self.exists(self.root):
            return self.spark.createDataFrame([], RUN_RECORD)
        return (
            self.spark.read.schema(RUN_RECORD)
            .option("multiLine", True)
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "metadata.json")
            .json(self.root)
            .withColumn("_found_at", parent_path(F.col("_metadata.file_path")))
        )

    def artifacts(self) -> DataFrame:
        """Folders and files that may hold a saved model, from a recursive listing."""
        files = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(self.root)
            .select(F.col("path"))
        )
        folder = F.regexp_extract("path", r"^(.*/[^/]+/[^/]+/[^/]+/model)/", 1)
        return files.select(F.when(folder == "", F.col("path")).otherwise(folder).alias("artifact")).distinct()

    def list_models(self, model_name: str | None = None, dataset: str | None = None) -> DataFrame:
        """Matching runs, newest first, with the usable artefact path and whether it exists.

        The recorded path wins; otherwise the artefact is looked for beside its
        metadata, so a catalogue that was moved still resolves.
        """
        runs = self.runs()
        if "_found_at" not in runs.columns:
            return runs.withColumns({"resolved_path": F.lit(None).cast("string"), "artifact_available": F.lit(False)})
        present = self.artifacts()
        plain = F.regexp_replace(F.col("artifact"), r"^file:/+", "/")
        beside = F.concat_ws("/", F.regexp_replace("_found_at", r"^file:/+", "/"), base_name(F.col("artifact_path")))
        at_record = present.select(plain.alias("_recorded"))
        at_home = present.select(plain.alias("_beside"))
        recorded = F.regexp_replace("artifact_path", r"^file:/+", "/")
        found = (
            matching(runs, model_name, dataset)
            .withColumns({"_want": recorded, "_near": beside})
            .join(at_record, F.col("_want") == F.col("_recorded"), "left")
            .join(at_home, F.col("_near") == F.col("_beside"), "left")
        )
        resolved = found.withColumns(
            {
                "resolved_path": F.coalesce("_recorded", "_beside"),
                "artifact_available": F.coalesce("_recorded", "_beside").isNotNull(),
            }
        )
        return list_runs(resolved.select(*RUN_RECORD.names, "resolved_path", "artifact_available"))

    def resolve(self, model_name: str, dataset: str, version: str = "latest") -> dict[str, Any]:
        """Metadata of one run; ``latest`` is the newest one, which need not be the best."""
        found = matching(self.runs(), model_name, dataset)
        found = latest_runs(found) if version == "latest" else found.where(F.col("version") == version)
        row = found.select(*RUN_RECORD.names).first()
        if row is None:
            raise ModelNotFoundError(f"no run {model_name}/{dataset}/{version} under {self.root}")
        return row.asDict(recursive=True)

    def load(self, model_name: str, dataset: str, version: str = "latest") -> tuple[dict[str, Any], PipelineModel]:
        """Metadata and fitted model of one run."""
        record = self.resolve(model_name, dataset, version)
        near = f"{self.root.rstrip('/')}/{model_name}/{dataset}/{record['version']}/{record['artifact_path'].rsplit('/', 1)[-1]}"
        for path in (record["artifact_path"], near):
            if self.exists(path):
                return record, PipelineModel.load(path)
        raise ModelNotFoundError(f"run {model_name}/{dataset}/{version} has no saved model at {near}")
