"""Tables that a query reads several times, written once to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the session's spark.checkpoint.dir. A temporary folder stands in only where the setting is absent on a single machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="screenlake-")
        spark.sparkContext.setCheckpointDir(folder)
    return f"{folder.rstrip('/')}/screenlake/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the session's spark.checkpoint.dir.

    Frames that are joined with numbers derived from themselves would be computed once for each use, and plans that do so in a row grow with
    the product of the uses. A written table ends that, has a known size, and outlives lost executors.
    """
    path = scratch(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
