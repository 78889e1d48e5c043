"""Counts of decoded reads as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def running_cells(stream: DataFrame) -> DataFrame:
    """n by lib_id, id and sample so far; for output mode complete or update."""
    return stream.filter("lib_id is not null and id is not null").groupBy("lib_id", "id", "sample").agg(F.count(F.lit(1)).alias("n"))


def windowed(stream: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """n by time window and key; windows close when the watermark has passed them."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
