"""What the corpus operators share: text measures, written intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.session import work_folder

#: A word: a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_of(df: DataFrame) -> Column:
    """The text column as a string; null is the empty text."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def without_spaces(text: Column) -> Column:
    return F.translate(text, SPACES, "")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings within this block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def released_shuffles(spark: SparkSession, **more: str):
    """Within this block Spark removes a query's shuffle files as soon as the query ends."""
    return _settings(spark, {RELEASE: "true", **more})


def settled(df: DataFrame, purpose: str, settings: dict[str, str] | None = None) -> DataFrame:
    """The frame, written to the shared checkpoint folder and read back.

    Cuts the lineage: later reads give the same rows whatever executors are lost.
    ``settings`` hold while it is written.
    """
    spark = df.sparkSession
    path = work_folder(spark, f"llm-{purpose}")
    with released_shuffles(spark, **(settings or {})):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def settled_buckets(df: DataFrame, purpose: str, key: str, settings: dict[str, str] | None = None) -> DataFrame:
    """Like ``settled``, in as many buckets by key as the session has shuffle partitions: a join on the key leaves it in place."""
    spark = df.sparkSession
    path, table = work_folder(spark, f"llm-{purpose}"), f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    with released_shuffles(spark, **(settings or {})):
        df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.settled_at, out.settled_as = path, table
    return out


def dropped(df: DataFrame) -> None:
    """Removes the folder of a settled frame that nothing reads any more: what was made from it is written itself."""
    spark = df.sparkSession
    if hasattr(df, "settled_as"):
        spark.sql(f"DROP TABLE IF EXISTS {df.settled_as}")
    target = spark._jvm.org.apache.hadoop.fs.Path(df.settled_at)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
