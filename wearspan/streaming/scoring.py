"""Scoring requests as they arrive: the batch scorer on a stream.

A request carries an id and a map of feature values. Valid requests are scored;
others leave with the reason instead of a prediction, so none is lost.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wearspan.plans.scoring import check_family, contract_from_map, contract_problem
from wearspan.sources.catalog import RunCatalog

REQUEST = "request_id string, features map<string,double>"


def score_requests(requests: DataFrame, model: PipelineModel, contract: list[str]) -> DataFrame:
    """Stateless, so it serves batch and streaming frames alike."""
    checked = requests.withColumn(
        "error",
        F.when(F.col("features").isNull(), "the request has no features").otherwise(
            contract_problem(F.map_keys("features"), contract)
        ),
    )
    columns = contract_from_map(checked, contract, keys=["request_id", "error"])
    filled = columns.na.fill(0.0, contract)
    scored = model.transform(filled)
    return scored.select("request_id", "error", F.when(F.col("error").isNull(), F.col("prediction")).alias("rul_prediction"))


def start_scoring(
    spark: SparkSession,
    catalog: RunCatalog,
    request_path: str,
    output_path: str,
    checkpoint_path: str,
    model_name: str,
    dataset: str,
    version: str = "latest",
    once: bool = False,
) -> StreamingQuery:
    """Score JSON requests landing in a folder and append the answers as Parquet."""
    check_family(model_name)
    record, model = catalog.load(model_name, dataset, version)
    requests = spark.readStream.schema(REQUEST).json(request_path)
    answers = score_requests(requests, model, record["feature_columns"]).withColumn("model_version", F.lit(record["version"]))
    writer = answers.writeStream.format("parquet").option("checkpointLocation", checkpoint_path).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(output_path)
