"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: str = "*", partitions: int = 8, memory: str = "12g", name: str = "wearspan", work: str | None = None
) -> SparkSession:
    """Single-machine session for tests and benchmarks; ``work`` is the checkpoint folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        # Wide feature projections compile to methods HotSpot would only interpret (over 8000
        # bytes of code); below that limit Spark splits them into small methods instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return (builder.config("spark.checkpoint.dir", work) if work else builder).getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, or where none is set, of the warehouse.

    Both are folders that the driver and all executors share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
