"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and the whole text (null reads as empty)."""
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is the session's spark.checkpoint.dir. A temporary folder stands in only where that setting is
    absent, which is right for a single machine (tests) and for nothing else.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="screenlake-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/screenlake/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


_SCOPES: list[dict[str, DataFrame]] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: the lineage ends there and its size is known to the planner."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if _SCOPES:
        _SCOPES[-1][path] = table
    return table


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Tables that are written inside are deleted at the end, but for those given to keep(), which go to the scope around it. What is kept must not read any other of them: it is a written table itself."""
    own: dict[str, DataFrame] = {}
    kept: list[DataFrame] = []
    _SCOPES.append(own)
    try:
        yield lambda *tables: kept.extend(tables)
    finally:
        _SCOPES.pop()
        for path, table in own.items():
            if not any(table is k for k in kept):
                dropped(spark, path)
            elif _SCOPES:
                _SCOPES[-1][path] = table


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


BATCH_BYTES = 4 << 20


def small_batches(batches: Iterable[pa.RecordBatch], most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about that many bytes (a longer row is a slice of its own), so that a worker's memory doesn't follow Spark's batches. What Arrow no longer uses goes back to the system at the end, as workers stay."""
    for batch in batches:
        rows = max(1, int(len(batch) * most / max(1, batch.nbytes)))
        for k in range(0, len(batch), rows):
            yield batch.slice(k, rows)
    pa.default_memory_pool().release_unused()
