"""Filling of values from lookup tables, by the first of several keys that knows one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids


def dictionary(blocks: DataFrame, values: list[str]) -> DataFrame:
    """bb_id, exact (whether a row has this id itself, or another with a number behind it, X.2 for X), and values, each the first that isn't missing, by line. blocks: line, bb_id, values."""
    own = blocks.select("line", "bb_id", F.lit(True).alias("exact"), *values)
    base = blocks.filter(F.col("bb_id").contains(".")).select("line", F.substring_index("bb_id", ".", 1).alias("bb_id"), F.lit(False).alias("exact"), *values)
    first = [F.min_by(v, F.when(ids.present(F.col(v)).isNotNull(), F.col("line"))).alias(v) for v in values]
    return own.unionByName(base).groupBy("bb_id", "exact").agg(*first)


def filled(rows: DataFrame, key: list[str], positions: list[str], known: DataFrame, target: str, value: str) -> DataFrame:
    """rows with target filled where it is missing: the value of the first position whose block has one, of the block's own id before that of a numbered one; NA where none has.

    All positions are looked up in one join of (position, block) rows, and the first is taken by one aggregation; rows that need nothing aren't joined. key: what identifies a row.
    """
    there = ids.present(F.col(target))
    blocks = F.array(*[F.struct(F.lit(k).alias("place"), F.col(p).alias("bb_id")) for k, p in enumerate(positions)])
    long = rows.filter(there.isNull()).select(*key, F.explode(blocks).alias("b")).select(*key, "b.place", "b.bb_id").filter(ids.present(F.col("bb_id")).isNotNull())
    found = long.join(known.filter(ids.present(F.col(value)).isNotNull()).select("bb_id", "exact", F.col(value).alias("_v")), "bb_id")
    best = found.groupBy(*key).agg(F.min_by("_v", F.struct("place", F.when(F.col("exact"), 0).otherwise(1).alias("by"))).alias("_found"))
    others = [c for c in rows.columns if c != target]
    return rows.join(best, key, "left").select(*others, F.coalesce(there, F.col("_found"), F.lit("NA")).alias(target))


def passing(rows: DataFrame, score: str) -> DataFrame:
    """Rows that pass every gate whose column exists, with a finite score."""
    for gate in ("glm_hit", "rs_pass", "consensus"):
        if gate in rows.columns:
            rows = rows.filter(F.coalesce(F.col(gate), F.lit(False)))
    return rows.filter(F.col(score).isNotNull() & ~F.isnan(score) & (F.abs(F.col(score)) < float("inf")))


def suffix_counts(rows: DataFrame, positions: list[str]) -> DataFrame:
    """By sample: reads, and how many name a library by a suffix in their id, in any block, in neither or one of both, or have a library of their own; and the percentage without one in the id."""
    in_id = ids.has_library(F.col("id"))
    in_block = F.exists(F.array(*positions), lambda b: ids.has_library(b))
    own = F.coalesce(F.trim("lib_id"), F.lit("")) != ""
    checks: dict[str, Column] = {
        "id_has_lib": in_id, "id_missing_lib": ~in_id, "bb_has_lib": in_block, "bb_missing_lib": ~in_block, "id_missing_bb_has_lib": ~in_id & in_block, "id_missing_bb_missing_lib": ~in_id & ~in_block,
        "id_has_lib_bb_missing_lib": in_id & ~in_block, "lib_id_present": own, "id_missing_lib_with_lib_id": ~in_id & own,
    }
    out = rows.groupBy("sample").agg(F.count(F.lit(1)).alias("total_reads"), *[F.count_if(c).alias(k) for k, c in checks.items()])
    return out.withColumn("id_missing_lib_pct", F.round(100.0 * F.col("id_missing_lib") / F.col("total_reads"), 6))
