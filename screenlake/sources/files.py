"""Readers and writers of screening files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import samples

READ_NAME = r"(?:\.fpmerged\.fq|_merged\.(?:fq|fastq))(?:\.gz)?$"


def header(name: str) -> str:
    """A column name without byte-order mark, quotes and blanks, with underscores for dashes and dots, in upper case."""
    return re.sub("_+", "_", re.sub(r"[-.]", "_", re.sub(r"\s+", "", name.replace("﻿", "").strip("\"'")))).upper()


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text under normalised names; short rows are filled up, long ones cut."""
    df = spark.read.option("sep", "\t").option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.toDF(*map(header, df.columns))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.option("sep", "\t").option("header", True).option("nullValue", "NA").mode("overwrite").csv(path)


def resolve(names: list[str], aliases: dict[str, list[str]]) -> dict[str, str]:
    """Canonical names by the first alias found; what is missing is named in the error."""
    found = {c: next((n for a in options for n in names if header(n) == header(a)), None) for c, options in aliases.items()}
    if missing := [c for c, n in found.items() if n is None]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return found


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """sample, read_no, read_id, read_seq, read_len. A record that isn't complete at a file's end is left out.

    Lines are numbered within their file by the file block that Spark read and the place in it, so records are put together by a shuffle on (file, record) without ordering the whole input.
    """
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.expr("input_file_block_start()").alias("block"), "value", F.monotonically_increasing_id().alias("at"))
    part = F.shiftright("at", 33)
    lines = lines.withColumn("part", part).withColumn("k", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    first = lines.groupBy("file", "part", "block").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("k0"))
    offset = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    first = first.withColumn("offset", F.coalesce(offset, F.lit(0))).drop("n")
    numbered = lines.join(first, ["file", "part", "block"]).withColumn("line", F.col("offset") + F.col("k") - F.col("k0"))
    records = numbered.groupBy("file", F.floor(F.col("line") / 4).alias("read_no")).agg(*[F.max(F.when(F.col("line") % 4 == i, F.col("value"))).alias(f"l{i}") for i in range(4)])
    name = F.regexp_replace(F.regexp_extract("file", r"([^/]+)$", 1), READ_NAME, "")
    return records.filter("l0 is not null and l1 is not null and l2 is not null and l3 is not null").select(
        name.alias("sample"), "read_no", F.regexp_replace("l0", "^@", "").alias("read_id"), F.col("l1").alias("read_seq"), F.length("l1").alias("read_len")
    )


def pair_files(names: list[str]) -> tuple[list[tuple[str, str, str]], list[str]]:
    """(sample, first, second) of paired read files, and samples with one side only. Two files for a side are an error."""
    sides: dict[str, dict[str, str]] = {}
    for n in sorted(names):
        m = re.match(r"(.+?)_(?:R)?([12])(?:_\d+)?\.(?:fastq|fq)(?:\.gz)?$", n.rsplit("/", 1)[-1])
        if m:
            side = sides.setdefault(m[1], {})
            if m[2] in side:
                raise ValueError(f"two files for side {m[2]} of {m[1]}")
            side[m[2]] = n
    return [(s, x["1"], x["2"]) for s, x in sides.items() if len(x) == 2], [s for s, x in sides.items() if len(x) == 1]


INSERT_KEYS = ("insert_size", "insertSize", "insert-size")
PEAK_KEYS, HISTOGRAM_KEYS = ("peak", "mode", "peak_insert_size"), ("histogram", "hist", "distribution")


def insert_reports(spark: SparkSession, path: str) -> DataFrame:
    """sample, peak, width and histogram (lengths and numbers, by length) of the trimming tool's JSON reports.

    The histogram may be a list by length, a list of pairs, an object by length, or an object with lists x and y, under any of the names above; what isn't a number is left out, and numbers of one
    length add up. Without a peak the fullest length stands for it, the shortest of equal ones. A report without any of it, or that isn't JSON, has nulls and an empty histogram.
    """
    rows = spark.read.text(path, wholetext=True)
    sample = F.regexp_replace(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1), r"\.json$", "")
    rows = rows.select(sample.alias("sample"), F.try_parse_json("value").alias("v"))
    at = lambda names, kind: F.coalesce(*[F.try_variant_get("v", f"$['{k}']['{n}']", kind) for k in INSERT_KEYS for n in names])
    rows = rows.select("sample", at(PEAK_KEYS, "double").alias("peak"), at(("width",), "double").alias("width"), at(HISTOGRAM_KEYS, "variant").alias("h"))
    number = lambda x: F.try_variant_get(x, "$", "double")
    of = lambda path, kind: F.try_variant_get("h", path, kind)
    pair = lambda x, n: F.struct(x.cast("long").alias("length"), n.alias("n"))
    items, x, y = of("$", "array<variant>"), of("$.x", "array<variant>"), of("$.y", "array<variant>")
    as_pairs = F.transform(items, lambda e: pair(F.try_variant_get(e, "$[0]", "double"), F.try_variant_get(e, "$[1]", "double")))
    as_list = F.transform(items, lambda e, i: pair(i, number(e)))
    by_length = F.transform(F.map_entries(of("$", "map<string,variant>")), lambda e: pair(e["key"].try_cast("double"), number(e["value"])))
    of_lists = F.transform(F.arrays_zip(x.alias("x"), y.alias("y")), lambda e: pair(number(e["x"]), number(e["y"])))
    sound = lambda a: F.filter(a, lambda e: e["length"].isNotNull() & e["n"].isNotNull())
    nested = F.try_variant_get(F.get(items, F.lit(0)), "$", "array<variant>").isNotNull()
    shape = F.when(items.isNotNull(), F.when(nested, sound(as_pairs)).otherwise(sound(as_list))).otherwise(F.when(F.size(sound(by_length)) > 0, sound(by_length)).otherwise(sound(of_lists)))
    rows = rows.select("sample", "peak", "width", F.coalesce(shape, F.array().cast("array<struct<length:bigint,n:double>>")).alias("e"))
    bins = rows.select("sample", F.explode("e").alias("e")).groupBy("sample", "e.length").agg(F.sum("e.n").alias("n"))
    bins = bins.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("length", "n"))).alias("histogram"))
    fullest = F.array_max(F.transform("histogram", lambda e: F.struct(e["n"].alias("n"), (-e["length"]).alias("m"))))
    out = rows.select("sample", "peak", "width").join(bins, "sample", "left")
    none = F.array().cast("array<struct<length:bigint,n:double>>")
    return out.select("sample", F.coalesce("peak", (-fullest["m"]).cast("double")).alias("peak"), "width", F.coalesce("histogram", none).alias("histogram"))


def insert_histogram(spark: SparkSession, path: str) -> DataFrame:
    """sample, length, n of the trimming tool's JSON reports, where n is above 0."""
    rows = insert_reports(spark, path).select("sample", F.explode("histogram").alias("e"))
    return rows.select("sample", F.col("e.length").alias("length"), F.col("e.n").cast("long").alias("n")).filter("n > 0")


def subsample(reads: DataFrame, n: int, seed: int, mode: str = "random") -> DataFrame:
    """n reads of each sample, by a seeded hash or, in the mode head, the first ones. reads: sample, read_no."""
    if mode == "head":
        return samples.head(reads, ("sample",), n, F.col("read_no"))
    return samples.bottom_k(reads, ("sample",), n, seed, "sample", "read_no")


DECODED, UNDECODED = "decoded", "undecoded"


def write_reads(decoded: DataFrame, undecoded: DataFrame, path: str, most_undecoded: int | None = None) -> None:
    """Decoded and undecoded reads below path, a folder for each kind and sample. most_undecoded: keep the first ones of each sample only, by read_id; all by default."""
    decoded.write.partitionBy("sample").mode("overwrite").parquet(f"{path}/{DECODED}")
    if most_undecoded is not None:
        undecoded = samples.head(undecoded, ("sample",), most_undecoded, F.col("read_id"))
    undecoded.write.partitionBy("sample").mode("overwrite").parquet(f"{path}/{UNDECODED}")


def read_reads(spark: SparkSession, path: str, kind: str, columns: StructType) -> DataFrame:
    """What write_reads() has written; a filter on sample reads that sample's folder only."""
    return spark.read.schema(columns).parquet(f"{path}/{kind}").select(*columns.names)


def numeric_columns(df: DataFrame, columns: list[str], share: float = 0.9) -> list[str]:
    """Text columns of which at least this share of the values that aren't missing parse as numbers, found in one pass."""
    there = lambda c: ~F.coalesce(F.trim(F.col(c)), F.lit("")).isin("", "NA", "nan", "None")
    rows = df.agg(*[(F.count_if(there(c) & F.col(c).try_cast("double").isNotNull()) / F.nullif(F.count_if(there(c)), F.lit(0))).alias(c) for c in columns]).first()
    return [c for c in columns if rows[c] is not None and rows[c] >= share]


def with_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})
