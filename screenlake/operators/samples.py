"""Samples of fixed size by group, without ordering a group whole."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.staging import staged

DIGITS = 13  # hexadecimal digits of a hash that are read as a number


def bottom_k(df: DataFrame, by: tuple[str, ...], n: int, seed: int, *identity: str) -> DataFrame:
    """The n rows of each group with the smallest seeded hashes of what identifies them, ties by that: a uniform sample that doesn't depend on order or partitions.

    Counts by group give each one a bound under which somewhat more than n hashes lie; only those few rows are shuffled and ordered. Should a group have fewer under its
    bound than it is due, which the counts tell, all of its rows are looked at. Groups with n rows or fewer come whole. df is read twice: stage it if it is costly.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity])
    hashed = df.withColumn("_h", F.md5(text.cast("binary")))
    key = F.struct(*by)
    share = F.conv(F.substring("_h", 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)
    sizes = df.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    bounds = staged(sizes.withColumn("_most", F.lit(n + 8 * math.sqrt(n) + 24) / F.col("_n")))  # a row for each group, so small ones are broadcast
    near = staged(hashed.withColumn("_k", key).join(bounds, "_k").filter(share <= F.col("_most")))
    short = near.groupBy("_k").agg(F.count(F.lit(1)).alias("_got"), F.first("_n").alias("_n"))
    short = staged(bounds.select("_k", "_n").join(short.select("_k", "_got"), "_k", "left").filter(F.coalesce("_got", F.lit(0)) < F.least("_n", F.lit(n))).select("_k"))
    near = near.select(*df.columns, "_h")
    if not short.isEmpty():
        all_rows = hashed.withColumn("_k", key)
        near = near.withColumn("_k", key).join(short, "_k", "left_anti").drop("_k").unionByName(all_rows.join(short, "_k", "left_semi").drop("_k"))
    return _first(near, by, n, F.col("_h"), *map(F.col, identity)).drop("_h")


def head(df: DataFrame, by: tuple[str, ...], n: int, *order: Column) -> DataFrame:
    """The first n rows of each group. Every task keeps its own first n before rows are shuffled."""
    return _first(df, by, n, *order)


def _first(df: DataFrame, by: tuple[str, ...], n: int, *order: Column) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")
