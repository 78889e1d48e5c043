"""Building-block tables: validity, resolution of ids and duplicates. Columns: line, type, seq, bb_id, lib_id, smiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dna

TYPES = ("HP", "OP", "CP", "CODON")


def cleaned(rows: DataFrame) -> DataFrame:
    """Valid rows with upper-case types, normalised sequences and SMILES without blanks; anchors of no library get an empty one."""
    lib = F.when(F.upper("lib_id").isin("HP", "OP", "CP", "NA", "NONE"), "").otherwise(F.coalesce("lib_id", F.lit("")))
    out = rows.withColumn("type", F.upper(F.trim("type"))).withColumn("seq", dna.normalised(F.col("seq"))).withColumn("smiles", F.regexp_replace("smiles", r"\s+", ""))
    return out.filter(F.col("type").isin(*TYPES) & (F.col("bb_id") != "") & (F.col("seq") != "")).withColumn("lib_id", lib)


def resolved(rows: DataFrame) -> DataFrame:
    """Adds fixed_id: the id, .k for the k-th structure under that id in its library if it has several, and _LIB<lib> if libraries share the id."""
    known = rows.filter("smiles is not null and smiles != '' and bb_id != ''")
    seen = known.groupBy("bb_id", "lib_id", "smiles").agg(F.min("line").alias("_line"))
    each = Window.partitionBy("bb_id", "lib_id")
    index = seen.select("bb_id", "lib_id", "smiles", F.row_number().over(each.orderBy("_line")).alias("smiles_index"), F.count(F.lit(1)).over(each).alias("_several"))
    several = index.groupBy("bb_id", "lib_id").agg(F.max("_several").alias("_several"))
    reused = known.groupBy("bb_id").agg(F.countDistinct("lib_id").alias("_libs"))
    out = rows.join(index.drop("_several"), ["bb_id", "lib_id", "smiles"], "left").join(several, ["bb_id", "lib_id"], "left").join(reused, "bb_id", "left")
    suffix = F.when(F.col("_several") > 1, F.concat(F.lit("."), F.coalesce("smiles_index", F.lit(1)).cast("string"))).otherwise("")
    lib = F.when(F.col("_libs") > 1, F.concat(F.lit("_LIB"), F.regexp_replace("lib_id", "[^A-Za-z0-9_.-]", "_"))).otherwise("")
    return out.withColumn("fixed_id", F.concat("bb_id", suffix, lib)).drop("_several", "_libs")


def duplicates(rows: DataFrame) -> DataFrame:
    """Rows whose tag an earlier row of the library and type has under another id."""
    key = Window.partitionBy("type", "lib_id", "seq").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = rows.withColumn("first_id", F.first("bb_id").over(key))
    return first.filter("bb_id != first_id").select(F.concat(F.lit("DUP_"), "type").alias("kind"), "lib_id", "seq", "first_id", F.col("bb_id").alias("conflict_id"), "line")


def collisions(variants: DataFrame) -> DataFrame:
    """Closing-primer variants that several libraries claim. columns: seq, lib_id."""
    return variants.groupBy("seq").agg(F.countDistinct("lib_id").alias("libs")).filter("libs > 1")
