"""Screens made from the driver's tables: a count cube from lineitem, reads and tags from events.

The same definitions exist as SQL for DuckDB (queries.py), so that every operator has an oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

R1 = [f"r1c{i}" for i in range(1, 5)]
R2 = [f"r2c{i}" for i in range(1, 5)]
SAMPLES = [*R1, *R2, "neg_r1", "neg_r2", "del2"]


def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each decoded read: lib_id, id, bb1 to bb4, sample, run."""
    l = spark.read.parquet(f"{sf_dir}/lineitem.parquet")  # noqa: E741
    s = F.col("l_orderkey") % 11
    blocks = [F.concat(F.lit("B"), c.cast("string")) for c in (F.col("l_partkey") % 20, F.col("l_suppkey") % 10, F.col("l_linenumber"))]
    sample = F.element_at(F.array(*map(F.lit, SAMPLES)), (s + 1).cast("int"))
    return l.select(
        F.col("l_returnflag").alias("lib_id"),
        F.concat_ws("_", F.lit("3"), *blocks, F.lit("NA")).alias("id"),
        *[b.alias(f"bb{i + 1}") for i, b in enumerate(blocks)],
        F.lit("NA").alias("bb4"),
        sample.alias("sample"),
        F.when(F.col("l_linestatus") == "O", "A").otherwise("I").alias("run"),
    )


CUBE_SQL = """cube AS (
  SELECT l_returnflag AS lib_id, '3_B' || (l_partkey % 20) || '_B' || (l_suppkey % 10) || '_B' || l_linenumber || '_NA' AS id,
    'B' || (l_partkey % 20) AS bb1, 'B' || (l_suppkey % 10) AS bb2, 'B' || l_linenumber AS bb3, 'NA' AS bb4,
    (['r1c1','r1c2','r1c3','r1c4','r2c1','r2c2','r2c3','r2c4','neg_r1','neg_r2','del2'])[(l_orderkey % 11 + 1)::INT] AS sample,
    CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'I' END AS run
  FROM lineitem)"""

MATRIX_SQL = (
    CUBE_SQL
    + ", m AS (SELECT lib_id, id, min(bb1) AS bb1, min(bb2) AS bb2, min(bb3) AS bb3, min(bb4) AS bb4, "
    + ", ".join(f"count(*) FILTER (sample = '{s}')::DOUBLE AS {s}" for s in SAMPLES)
    + " FROM cube GROUP BY lib_id, id)"
)
