"""Comparison of runs: ranks, set patterns, selectivity tiers, block frequencies, shifts and quality flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import stats
from ..plans.staging import staged


def ordered(score: str, *ties: str) -> list[Column]:
    return [F.desc_nulls_last(score), *[F.asc(t) for t in ties]]


def top(df: DataFrame, n: int, score: str, *ties: str) -> DataFrame:
    """The n best rows; ties by the given columns."""
    return df.orderBy(*ordered(score, *ties)).limit(n)


def best_per_key(df: DataFrame, key: str, score: str, *ties: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*ordered(score, *ties))
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def rank_map(df: DataFrame, key: str, score: str) -> DataFrame:
    """key, score, rank (1 is best, ties by key), rank_pct (100 is best) and score_z, over keys with a finite score."""
    rows = df.filter(F.col(score).isNotNull() & ~F.isnan(score) & (F.abs(F.col(score)) < float("inf"))).select(key, score)
    within = F.row_number().over(Window.partitionBy(score).orderBy(key))  # ties are ordered by key
    out = stats.counted(rows, score).withColumn("rank", (F.col("rows") - F.col("below") - F.col("ties") + within).cast("long"))
    moments = rows.agg(F.avg(score).alias("_m"), F.stddev_pop(score).alias("_s"))
    pct = F.when(F.col("rows") > 1, 100.0 * (1 - (F.col("rank") - 1) / (F.col("rows") - 1))).otherwise(100.0)
    z = (F.col(score) - F.col("_m")) / F.when(F.col("_s") > 0, F.col("_s")).otherwise(1.0)
    return out.crossJoin(F.broadcast(moments)).select(key, score, "rank", pct.alias("rank_pct"), z.alias("score_z"))  # one row of moments


def patterns(runs: dict[str, DataFrame], key: str, score: str) -> DataFrame:
    """key, pattern (labels joined by +, in the order given), n_runs and score_<label>, for every key of any run."""
    tables = [df.groupBy(key).agg(F.max(score).alias(f"score_{label}"), F.lit(True).alias(f"_in_{label}")) for label, df in runs.items()]
    out = reduce(lambda a, b: a.join(b, key, "full"), tables)
    there = [F.when(F.col(f"_in_{label}"), label) for label in runs]
    count = reduce(lambda a, b: a + b, [F.when(F.col(f"_in_{label}"), 1).otherwise(0) for label in runs])
    return out.select(key, F.concat_ws("+", *there).alias("pattern"), count.alias("n_runs"), *[f"score_{label}" for label in runs])


def pattern_counts(found: DataFrame) -> DataFrame:
    counts = found.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))  # seven patterns of three runs at most


def below_controls(df: DataFrame, controls: list[str], percent: float) -> DataFrame:
    """Rows whose controls all lie strictly below the percentile of that control."""
    df = staged(df)
    bounds = stats.quantiles(df, {f"_b_{c}": (c, percent / 100.0) for c in controls})
    keep = reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(0.0)) < F.col(f"_b_{c}") for c in controls])
    return df.crossJoin(F.broadcast(bounds)).filter(keep).drop(*[f"_b_{c}" for c in controls])  # one row


def tiers(active: DataFrame, inactive: DataFrame, key: str, high: float = 99.0, low: float = 50.0, both_least: float = 90.0) -> DataFrame:
    """Groups by rank percentiles of two rank maps (missing: 0), with selectivity scores."""
    a = active.select(key, F.col("rank_pct").alias("active_pct"), F.col("score_z").alias("active_z"))
    i = inactive.select(key, F.col("rank_pct").alias("inactive_pct"), F.col("score_z").alias("inactive_z"))
    df = a.join(i, key, "full").na.fill(0.0, ["active_pct", "inactive_pct"])
    both = max(high, both_least)
    group = (
        F.when((F.col("active_pct") >= high) & (F.col("inactive_pct") <= low), "active")
        .when((F.col("inactive_pct") >= high) & (F.col("active_pct") <= low), "inactive")
        .when((F.col("active_pct") >= both) & (F.col("inactive_pct") >= both), "both")
        .otherwise("Other")
    )
    s = F.col("active_pct") - F.col("inactive_pct")
    specific = F.when(group == "active", s).when(group == "inactive", -s).when(group == "both", F.least("active_pct", "inactive_pct"))
    return df.select("*", s.alias("selectivity"), F.least("active_pct", "inactive_pct").alias("both_specific"), group.alias("tier"), specific.alias("specificity"))


def group_ranks(df: DataFrame, group: str, *order: Column) -> DataFrame:
    return df.withColumn("group_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def picks(df: DataFrame, group: str, n: int, first: Column, *order: Column) -> DataFrame:
    """n rows of each group: those marked first, then the others, each in order."""
    w = Window.partitionBy(group).orderBy(F.when(first, 0).otherwise(1), *order)
    return df.withColumn("pick", F.row_number().over(w)).filter(F.col("pick") <= n)


def picks_filled(rows: DataFrame, preferred: DataFrame, key: str, group: str, n: int | dict[str, int], *order: Column) -> DataFrame:
    """n rows of each group, or as many as n says for it: of the preferred ones first, then of the others, each in order. Adds pick, from 1, and stage (1: preferred, 2: filled).

    preferred: the keys of, say, cluster representatives. The second stage takes what is left of a group's number among rows that weren't taken; every task keeps its own best before rows are
    shuffled, so a large group isn't ordered whole.
    """
    most = F.lit(n) if isinstance(n, int) else F.coalesce(F.create_map(*[F.lit(v) for kv in n.items() for v in kv])[F.col(group)], F.lit(0))
    limit = n if isinstance(n, int) else max(n.values(), default=0)
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    best = lambda df: df.withColumn("pick", place).filter(F.col("pick") <= limit).filter(F.col("pick") <= most)
    one = staged(best(rows.join(preferred.select(key).distinct(), key, "left_semi")).withColumn("stage", F.lit(1)))
    taken = one.groupBy(group).agg(F.max("pick").alias("_taken"))
    two = best(rows.join(one.select(key), key, "left_anti")).join(taken, group, "left").withColumn("pick", F.col("pick") + F.coalesce("_taken", F.lit(0)))
    return one.unionByName(two.filter(F.col("pick") <= most).drop("_taken").withColumn("stage", F.lit(2)))


def recommended(df: DataFrame) -> DataFrame:
    """Rows that pass every filter whose column exists."""
    for c, want in (("consensus", True), ("glm_hit", True), ("rs_pass", True), ("neg_hard_fail", False)):
        if c in df.columns:
            df = df.filter(F.col(c) == want)
    return df


def block_frequency(df: DataFrame, blocks: list[str], most: int) -> DataFrame:
    """The most frequent blocks of each position, with their share of the position's blocks, the libraries they come from, and each library's count."""
    long = df.select("lib_id", F.explode(F.array(*[F.struct(F.lit(b).alias("position"), F.col(b).alias("block")) for b in blocks])).alias("x")).select("lib_id", "x.position", "x.block")
    by_lib = long.filter("block != 'NA'").groupBy("position", "block", "lib_id").agg(F.count(F.lit(1)).alias("n"))
    each = F.sort_array(F.collect_list(F.concat_ws(":", "lib_id", F.col("n").cast("string"))))
    rows = by_lib.groupBy("position", "block").agg(F.sum("n").alias("n"), F.concat_ws(",", F.sort_array(F.collect_set("lib_id"))).alias("libs"), F.concat_ws(",", each).alias("lib_counts"))
    rows = rows.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("position")))  # a row for each block of a design
    w = Window.partitionBy("position").orderBy(F.desc("n"), "block")
    return rows.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most)


def enrichment(samples: list[str], how: str = "median") -> Column:
    """Of the samples that have a value: their median, mean or greatest."""
    there = F.filter(F.array(*samples), lambda x: x.isNotNull())
    if how == "median":
        return stats.median_of([F.col(s) for s in samples])
    if how == "mean":
        return F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda a, x: a + x) / F.size(there))
    return F.array_max(there)


def common(a: Column, b: Column, how: str = "min") -> Column:
    return {"min": F.least(a, b), "mean": (a + b) / 2.0, "gmean": F.sqrt(a * b)}[how]


def shift(current: DataFrame, previous: DataFrame, key: str, score: str, n: int) -> DataFrame:
    """Scores of two runs for keys in the best n of either one, with their difference and which list has them."""
    c, p = top(current, n, score, key).select(key, F.lit(True).alias("_c")), top(previous, n, score, key).select(key, F.lit(True).alias("_p"))
    keys = c.join(p, key, "full")
    both = current.select(key, F.col(score).alias("current")).join(previous.select(key, F.col(score).alias("previous")), key)
    status = F.when(F.col("_c") & F.col("_p"), "both").when(F.col("_c"), "only_current").otherwise("only_previous")
    return both.join(keys, key).select(key, "current", "previous", (F.col("current") - F.col("previous")).alias("diff"), status.alias("status"))


def merged_runs(a: DataFrame, b: DataFrame, key: str, shared: list[str], score: str) -> DataFrame:
    """Full outer merge of the best row of each key, shared columns from the first that has them."""
    a, b = best_per_key(a, key, score, "lib_id"), best_per_key(b, key, score, "lib_id")
    rename = lambda df, s: df.select(key, *[F.col(c).alias(f"{c}_{s}") for c in [*shared, score]])
    return rename(a, "a").join(rename(b, "b"), key, "full").select(key, *[F.coalesce(f"{c}_a", f"{c}_b").alias(c) for c in shared], f"{score}_a", f"{score}_b")


def quality_flags(df: DataFrame, control: str, negatives: list[str], quantile: float = 0.9, least: float = 10.0) -> DataFrame:
    """Adds flags: what is odd about a row, joined by semicolons, or OK."""
    df = staged(df)
    bounds = stats.quantiles(df, {f"_b_{c}": (c, quantile) for c in negatives})
    df = df.crossJoin(F.broadcast(bounds)).withColumns({f"_b_{c}": F.greatest(F.lit(0.0), f"_b_{c}") for c in negatives})  # one row
    high = [F.when((F.col(c) >= F.col(f"_b_{c}")) & (F.col(f"_b_{c}") > 0), f"{c.upper()}_HIGH") for c in negatives]
    flags = F.concat_ws(
        ";", F.when(F.col(control) < least, "LOW_DEL2"), *high, F.when(F.col("lfc_r2") < F.col("lfc_r1") - 1, "R2_DROP"),
        F.when(reduce(lambda a, b: a | b, [F.coalesce(b, F.lit("NA")) == "NA" for b in map(F.col, ("bb1", "bb2", "bb3"))]), "BB_MISSING"), F.when(F.col("neg_hard_fail"), "NEG_HARD_FAIL"),
    )
    return df.withColumn("flags", F.when(flags == "", "OK").otherwise(flags)).drop(*[f"_b_{c}" for c in negatives])


def quality_tiers(df: DataFrame) -> DataFrame:
    """Adds tier: A for consensus without flags, B for any hit, else Other."""
    return df.withColumn("tier", F.when(F.col("consensus") & (F.col("flags") == "OK"), "A").when(F.col("glm_hit") | F.col("rs_pass"), "B").otherwise("Other"))


def pooled(runs: dict[str, DataFrame], key: str, n: int, score: str) -> DataFrame:
    """The best n rows of every run, one row for each key: that of the first run, in the order given, that has it. Adds run."""
    tops = [top(df, n, score, key).withColumn("run", F.lit(label)).withColumn("_order", F.lit(i)) for i, (label, df) in enumerate(runs.items())]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tops)
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("_order"))).filter("_r = 1").drop("_r", "_order")


def with_sample_blocks(base: DataFrame, blocks: dict[str, DataFrame], key: str, samples: list[str]) -> DataFrame:
    """Adds each run's samples as <prefix><sample>, and <sample> itself: the first value in the order of the runs. Blocks have one row for each key."""
    for prefix, block in blocks.items():
        base = base.join(block.select(key, *[F.col(s).alias(f"{prefix}{s}") for s in samples if s in block.columns]), key, "left")
    there = lambda s: [F.col(f"{p}{s}") for p in blocks if f"{p}{s}" in base.columns]
    return base.withColumns({s: F.coalesce(*([F.col(s)] if s in base.columns else []), *there(s)) for s in samples if there(s)})


def same_columns(df: DataFrame, samples: list[str], prefixes: list[str]) -> list[str]:
    """Prefixed sample columns whose values equal those of the first prefix everywhere: one pass over the table tells."""
    pairs = {}
    for s in samples:
        there = [f"{p}{s}" for p in prefixes if f"{p}{s}" in df.columns]
        pairs |= {other: there[0] for other in there[1:]}
    if not pairs:
        return []
    found = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(a) for a, b in pairs.items()]).first()
    return [a for a in pairs if found[a]]


def filled(found: DataFrame, whole: dict[str, DataFrame], key: str) -> DataFrame:
    """Adds filled_<label>: the score in the list of bests, else that in the whole run (key, score)."""
    for label, df in whole.items():
        found = found.join(df.select(key, F.col("score").alias("_all")), key, "left").withColumn(f"filled_{label}", F.coalesce(f"score_{label}", "_all")).drop("_all")
    return found


def diverse(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """The n best rows in this order, no two of them with equal keys."""
    first = df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")
    return first.orderBy(*order).limit(n)


def flag_totals(df: DataFrame, flags: str = "flags") -> DataFrame:
    """How many rows have each flag."""
    return df.select(F.explode(F.split(flags, ";")).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def natural_order(block: Column) -> list[Column]:
    """Sort keys of building blocks: letters in front, the number after them, the rest; NA last."""
    missing = F.coalesce(block, F.lit("NA")) == "NA"
    return [F.when(missing, 1).otherwise(0), F.upper(F.regexp_extract(block, "^([A-Za-z]*)", 1)), F.regexp_extract(block, "^[A-Za-z]*([0-9]*)", 1).try_cast("long").asc_nulls_last(), F.asc(block)]
