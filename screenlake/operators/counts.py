"""Counting and scaling of decoded reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..plans.staging import staged

DENOMINATORS = ("sample_decoded", "sample_length_passed", "sample_total_raw", "library_decoded")


def cells(reads: DataFrame) -> DataFrame:
    """n reads by lib_id, id and sample; rows without a library or an id are left out."""
    return reads.filter("lib_id is not null and id is not null").groupBy("lib_id", "id", "sample").agg(F.count(F.lit(1)).alias("n"))


def matrix(reads: DataFrame, samples: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each lib_id and id, one zero-filled column for each sample. One pass: the samples are named, so no job looks for them."""
    one = lambda s: F.count(F.when(F.col("sample") == s, 1)).cast("double").alias(s)
    rows = reads.filter("lib_id is not null and id is not null")
    return rows.groupBy("lib_id", "id").agg(*[F.min(k).alias(k) for k in keep], *map(one, samples))


def shares(reads: DataFrame, libraries: DataFrame, samples: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """lib_id, sample, n, ratio (of the sample's decoded reads) and ratio_raw (of all its reads: raw has sample, total), zeros included; six places, 0 of nothing.

    Both lists are a screen's own, a few rows each.
    """
    grid = library_totals(reads, libraries, samples)
    whole = grid.groupBy("sample").agg(F.sum("n").alias("_all"))
    part = lambda total: F.coalesce(F.round(F.col("n") / F.nullif(total, F.lit(0)), 6), F.lit(0.0))
    out = grid.join(F.broadcast(whole), "sample").withColumn("ratio", part(F.col("_all"))).drop("_all")  # a row for each sample
    if raw is not None:
        out = out.join(F.broadcast(raw.select("sample", F.col("total").alias("_raw"))), "sample", "left").withColumn("ratio_raw", part(F.col("_raw"))).drop("_raw")  # a row for each sample
    return out


def summed(m: DataFrame, samples: list[str], key: tuple[str, ...] = ("lib_id", "id")) -> DataFrame:
    """Rows of equal keys added up; text that is no number counts as 0."""
    number = lambda s: F.coalesce(F.col(s).try_cast("double"), F.lit(0.0))
    return m.filter(" and ".join(f"{k} is not null" for k in key)).groupBy(*key).agg(*[F.sum(number(s)).alias(s) for s in samples])


def library_totals(reads: DataFrame, libraries: DataFrame, samples: DataFrame) -> DataFrame:
    """Reads of every library in every sample, zeros included. Both lists are a screen's own, a few rows each."""
    found = reads.groupBy("lib_id", "sample").agg(F.count(F.lit(1)).alias("n"))
    grid = libraries.crossJoin(F.broadcast(samples))
    return grid.join(found, ["lib_id", "sample"], "left").na.fill(0, ["n"])


def cpm(counts: DataFrame, denominators: DataFrame, keys: list[str]) -> DataFrame:
    """cpm: n per million of the denominator of the same keys, 0 where that is 0, to six places."""
    joined = counts.join(denominators, keys, "left")
    value = F.when(F.coalesce("denominator", F.lit(0)) > 0, F.col("n") * 1e6 / F.col("denominator")).otherwise(F.lit(0.0))
    return joined.select(*counts.columns, F.round(value, 6).alias("cpm"))


def size_factors(m: DataFrame, samples: list[str]) -> DataFrame:
    """lib_id and sf_<sample>: the library's total in a sample over its median total; 1 where that median isn't positive."""
    totals = m.groupBy("lib_id").agg(*[F.sum(s).alias(s) for s in samples])
    s = F.sort_array(F.array(*samples))
    k = len(samples)
    middle = (F.get(s, F.lit((k - 1) // 2)) + F.get(s, F.lit(k // 2))) / 2.0
    return totals.select("lib_id", *[F.when(middle > 0, F.col(x) / middle).otherwise(F.lit(1.0)).alias(f"sf_{x}") for x in samples])


def prefiltered(m: DataFrame, samples: list[str], control: str = "del2", quantile: float = 0.5, least: float = 0.0, least_total: float = 0.0) -> DataFrame:
    """Rows whose control reaches the quantile of all rows and least, and whose sum reaches least_total."""
    total: Column = sum((F.col(s) for s in samples), F.lit(0.0))
    m = staged(m) if 0 < quantile < 1 else m
    bound = stats.quantiles(m, {"_q": (control, quantile)}) if 0 < quantile < 1 else m.agg(F.lit(0.0).alias("_q"))
    return m.crossJoin(F.broadcast(bound)).filter((F.col(control) >= F.greatest("_q", F.lit(least))) & (total >= least_total)).drop("_q")  # one row


def peaks(histogram: DataFrame, most: int = 5, apart: int = 2, share: float = 0.01) -> DataFrame:
    """sample and centers: up to most bins, the fullest first, each at least apart from those before it and holding at least share of the reads."""
    bins = F.array_sort(
        F.collect_list(F.struct("length", "n")),
        lambda a, b: F.when(a["n"] > b["n"], -1).when(a["n"] < b["n"], 1).when(a["length"] < b["length"], -1).when(a["length"] > b["length"], 1).otherwise(0),
    )
    rows = histogram.groupBy("sample").agg(bins.alias("bins"), F.sum("n").alias("all"))
    fits = lambda acc, b: (b["n"] >= share * F.col("all")) & F.forall(acc, lambda c: F.abs(c - b["length"]) >= apart) & (F.size(acc) < most)
    chosen = F.aggregate("bins", F.array().cast("array<int>"), lambda acc, b: F.when(fits(acc, b), F.concat(acc, F.array(b["length"].cast("int")))).otherwise(acc))
    return rows.select("sample", chosen.alias("centers"))


def length_class(length: Column, three: int, four: int, tolerance: int, centers: Column | None = None, mode: str = "both") -> Column:
    """within_3, within_4 or within_both, else outside; modes 3 and 4 look at one of the two only.

    With centers (the longest peaks of a sample) a length that is near none of them is outside, and one that is near a center only is within_multi.
    """
    a = F.abs(length - three) <= tolerance if mode != "4" else F.lit(False)
    b = F.abs(length - four) <= tolerance if mode != "3" else F.lit(False)
    inside = F.when(a & b, "within_both").when(a, "within_3").when(b, "within_4")
    if centers is None:
        return F.coalesce(inside, F.lit("outside"))
    return F.when(F.exists(centers, lambda c: F.abs(length - c) <= tolerance), F.coalesce(inside, F.lit("within_multi"))).otherwise("outside")


def length_passes(kind: Column, policy: str = "reject_outside") -> Column:
    """Whether the length filter lets a read of this class through; unknown policies count as reject_outside."""
    return kind == "outside" if policy == "reject_inside" else kind != "outside"
