"""Hit calling: from a count matrix to scored, gated and annotated molecules.

Everything that belongs to one row is one chain of projections. Numbers that depend on all rows (quantiles, medians) come as frames of one row
that are joined back; tables that are read several times for this are staged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import stats
from ..plans.config import HitConfig
from ..plans.staging import staged
from .counts import size_factors

LN2 = math.log(2.0)
BLOCKS = ("bb1", "bb2", "bb3", "bb4")


def clip(c: Column, low: float | Column, high: float | Column) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.least(F.greatest(F.coalesce(c, as_col(low)), as_col(low)), as_col(high))


def interpolate(c: Column, x0: float, x1: float, y0: float, y1: float) -> Column:
    return F.when(c <= x0, y0).when(c >= x1, y1).otherwise(y0 + (c - x0) * ((y1 - y0) / (x1 - x0)))


def baseline(m: DataFrame, groups: dict[str, list[str]], control: str = "del2", k: float = 0.5) -> DataFrame:
    """Adds for each group g: n_<s> scaled counts, mean_g, cv_g and base_g, the log ratio to the control with a pseudo-count that follows it."""
    samples = [s for cols in groups.values() for s in cols] + [control]
    m = m.join(F.broadcast(size_factors(m, samples)), "lib_id")  # a row for each library
    m = m.select("*", *[(F.col(s) / F.greatest(f"sf_{s}", F.lit(1e-12))).alias(f"n_{s}") for s in samples])
    m = m.withColumn("pc", k * F.greatest(F.lit(1.0), f"n_{control}"))
    for g, cols in groups.items():
        scaled = [F.col(f"n_{s}") for s in cols]
        average = stats.mean(scaled)
        m = m.select(
            "*",
            average.alias(f"mean_{g}"),
            F.when(average > 0, stats.deviation(scaled) / average).alias(f"cv_{g}"),
            F.log2((average + F.col("pc")) / (F.col(f"n_{control}") + F.col("pc"))).alias(f"base_{g}"),
        )
    return m


def glm(m: DataFrame, groups: dict[str, list[str]], control: str = "del2", fixed: tuple[str, ...] = ()) -> DataFrame:
    """Adds for each group g: lfc_g, the closed-form log fold change, and alpha_g, its dispersion by moments (0 for fixed groups)."""
    level = F.col(f"n_{control}") + F.col("pc")
    for g, cols in groups.items():
        seen, scale = [F.col(s) for s in cols], [F.greatest(F.col(f"sf_{s}"), F.lit(1e-12)) for s in cols]
        delta = F.log((stats.total(seen) + 1e-12) / (stats.total([level * f for f in scale]) + 1e-12))
        m = m.withColumn(f"_d_{g}", delta)
        expected = [level * f * F.exp(f"_d_{g}") for f in scale]
        squares = stats.mean([e * e for e in expected])
        alpha = F.greatest(F.lit(0.0), (stats.variance(seen) - stats.mean(expected) - stats.variance(expected)) / F.greatest(squares, F.lit(1e-12)))
        m = m.select("*", (F.col(f"_d_{g}") / LN2).alias(f"lfc_{g}"), (F.lit(0.0) if g in fixed or len(cols) < 2 else alpha).alias(f"alpha_{g}")).drop(f"_d_{g}")
    arms = [g for g in groups if g not in fixed]
    return m.withColumn("alpha", stats.mean([F.col(f"alpha_{g}") for g in arms]))


def fano(m: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """One row: the median over rows of variance / mean of each group, for rows with a positive mean."""
    one = lambda cols: F.when(stats.mean(cols) > 0, stats.variance(cols) / stats.mean(cols))
    rows = staged(m.select(*[one([F.col(f"n_{s}") for s in cols]).alias(f"fano_{g}") for g, cols in groups.items() if len(cols) > 1]))
    return stats.quantiles(rows, {c: (c, 0.5) for c in rows.columns})


SHARES = (0.5, None, 0.4)  # weights of the rounds; the second follows the data
BLOCK_SHARES = (0.5, 1.0, 0.25)


def _depth(arms: tuple[str, ...]) -> Column:
    return F.log10(stats.total([F.coalesce(f"mean_{g}", F.lit(0.0)) for g in arms]) + 1)


def tuned(m: DataFrame, arms: tuple[str, ...] = ("r1", "r2")) -> DataFrame:
    """One row of parameters from quantiles over all rows, for two or three rounds: t0, slope, a cap c<k> and a weight w<k> for each round, l_alpha, l_cv, cap."""
    rows = m.select(_depth(arms).alias("depth"), *[F.col(f"lfc_{g}").alias(f"lfc{k}") for k, g in enumerate(arms, 1)], "alpha", F.col(f"cv_{arms[0]}").alias("cv"))
    for g in arms[1:]:
        rows = rows.unionByName(m.select(F.col(f"cv_{g}").alias("cv")), allowMissingColumns=True)
    shares = {"d60": ("depth", 0.6), "d75": ("depth", 0.75), "d25": ("depth", 0.25), "a75": ("alpha", 0.75), "cv75": ("cv", 0.75), "cv90": ("cv", 0.9)} | {f"l{k}": (f"lfc{k}", 0.9) for k in range(1, len(arms) + 1)}
    up = m.agg(F.avg(F.when(F.col(f"lfc_{arms[1]}") > 0, 1.0).otherwise(0.0)).alias("up"))
    weights = [F.lit(w).alias(f"w{k}") if w else clip(interpolate(F.col("up"), 0.3, 0.9, 0.3, 0.9), 0.3, 0.9).alias(f"w{k}") for k, w in enumerate(SHARES[: len(arms)], 1)]
    return stats.quantiles(rows, shares).crossJoin(up).select(  # one row each
        F.col("d60").alias("t0"),
        clip((F.col("d75") - F.col("d25")) / 2.772, 0.2, 1.0).alias("slope"),
        *[clip(F.col(f"l{k}"), 2.0, 5.0).alias(f"c{k}") for k in range(1, len(arms) + 1)],
        *weights,
        clip(0.3 + 0.6 * F.least(F.col("a75"), F.lit(1.0)), 0.3, 1.0).alias("l_alpha"),
        clip(0.3 + 0.7 * F.col("cv75"), 0.3, 1.0).alias("l_cv"),
        clip(F.col("cv90"), 0.6, 1.2).alias("cap"),
    )


def shrinkage(f: DataFrame, strict: bool = False) -> DataFrame:
    """One row of dispersion weights from the medians of fano: w_r1, w_r2, w_neg and, with a third round, w_r3 by linear interpolation, and whether controls count as Poisson.

    Controls have a median only with replicates, each group its own; the greatest counts.
    """
    column = lambda name: F.col(name) if name in f.columns else F.lit(None).cast("double")
    one, two, neg = F.coalesce(column("fano_r1"), F.lit(1.5)), F.coalesce(column("fano_r2"), F.lit(2.0)), F.greatest(column("fano_neg1"), column("fano_neg2"))
    poisson = F.coalesce(neg <= 1.3, F.lit(True))
    w_neg = F.when(poisson, 0.0).otherwise(clip(interpolate(neg, 1.3, 3.0, 0.2, 0.6), 0.0, 0.8))
    later = lambda c: clip(interpolate(c, 1.0, 3.0, 0.3, 0.95), 0.1, 0.98)
    third = [F.coalesce(F.when(F.col("fano_r3").isNotNull(), later(F.col("fano_r3"))), later(two)).alias("w_r3")] if "fano_r3" in f.columns else []
    rows = f.select(clip(interpolate(one, 1.0, 3.0, 0.1, 0.9), 0.0, 0.95).alias("w_r1"), later(two).alias("w_r2"), *third, w_neg.alias("w_neg"), poisson.alias("fix_neg_poisson"))
    return rows.withColumns({"w_neg": F.greatest("w_neg", F.lit(0.6)), "fix_neg_poisson": F.lit(False)}) if strict else rows


def components(m: DataFrame, parameters: DataFrame, arms: tuple[str, ...] = ("r1", "r2")) -> DataFrame:
    """Adds w_count, e (for the score) and e_syn (for the blocks), of two or three rounds."""
    m = m.crossJoin(F.broadcast(parameters))  # one row
    each = [clip(F.col(f"lfc_{g}"), 0.0, F.col(f"c{k}")) for k, g in enumerate(arms, 1)]
    w_count = 1 / (1 + F.exp(-(_depth(arms) - F.col("t0")) / F.col("slope")))
    e, e_syn = stats.total([F.col(f"w{k}") * x for k, x in enumerate(each, 1)]), stats.total([w * x for w, x in zip(BLOCK_SHARES, each, strict=False)])
    return m.select("*", w_count.alias("w_count"), e.alias("e"), e_syn.alias("e_syn"))


def negative_controls(first: str | None, second: str | None) -> tuple[str | None, dict[str, float]]:
    """Which control rows are centred on, the second round's before the first's, and the controls' weights in the penalty: halves, or all of the only one; none without controls."""
    there = [c for c in (first, second) if c]
    return second or first, {c: 1.0 / len(there) for c in there}


def synthons(m: DataFrame, blocks: tuple[str, ...] = BLOCKS) -> DataFrame:
    """Adds syn: over positions, the robust z of the block's median of e_syn, clipped at 3. All positions are counted in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("_at"), F.col(b).alias("_block")) for b in blocks])).alias("_x")
    long = staged(m.select("e_syn", each).select("e_syn", "_x._at", "_x._block"))
    by = staged(stats.quantiles(long, {"_v": ("e_syn", 0.5)}, ("_at", "_block")))
    middle = stats.quantiles(by, {"_m": ("_v", 0.5)}, ("_at",)).join(by.groupBy("_at").agg(F.avg("_v").alias("_a"), F.stddev_pop("_v").alias("_s")), "_at")
    by = by.join(F.broadcast(middle), "_at")  # a row for each position
    spread = stats.quantiles(by.select("_at", F.abs(F.col("_v") - F.col("_m")).alias("_away")), {"_d": ("_away", 0.5)}, ("_at",))
    by = by.join(F.broadcast(spread), "_at")  # a row for each position
    z = F.when(F.col("_d") > 1e-12, 0.6745 * (F.col("_v") - F.col("_m")) / F.col("_d")).otherwise((F.col("_v") - F.col("_a")) / (F.col("_s") + 1e-12))
    scores = staged(by.select("_at", "_block", clip(z, -3.0, 3.0).alias("_z")))
    for b in blocks:
        m = m.join(scores.filter(F.col("_at") == b).select(F.col("_block").alias(b), F.col("_z").alias(f"_z_{b}")), b, "left")
    total = stats.total([F.coalesce(f"_z_{b}", F.lit(0.0)) for b in blocks])
    return m.withColumn("syn", total).drop(*[f"_z_{b}" for b in blocks])


def hit_score(m: DataFrame, config: HitConfig, arms: tuple[str, ...] = ("r1", "r2"), controls: dict[str, float] | None = None) -> DataFrame:
    """Adds rho, penalty, hit_score and hit_pct. controls: the controls' groups and weights, halves of neg1 and neg2 by default."""
    m = staged(m)
    ends = stats.quantiles(m, {"_hi": ("syn", 0.95), "_lo": ("syn", 0.05)})
    m = m.crossJoin(F.broadcast(ends))  # one row
    m = m.withColumn("rho", clip(0.2 / F.greatest(F.abs("_hi"), F.abs("_lo"), F.lit(1e-6)), 0.05, 0.35)).drop("_hi", "_lo")
    cv = stats.mean([F.least(F.coalesce(f"cv_{g}", "cap"), F.col("cap")) / F.col("cap") for g in arms])
    controls = negative_controls("neg1", "neg2")[1] if controls is None else controls
    neg = stats.total([w * F.greatest(F.lit(0.0), F.coalesce(f"lfc_{g}", F.lit(0.0)) - config.tau_neg) for g, w in controls.items()] or [F.lit(0.0)])
    m = m.withColumn("penalty", F.col("l_alpha") * F.least("alpha", F.lit(1.0)) + F.col("l_cv") * cv + config.lambda_neg * neg)
    m = m.withColumn("hit_score", F.col("e") * F.col("w_count") * (1 + F.col("rho") * F.col("syn")) - F.col("penalty"))
    return stats.percent_of_rank(m, "hit_score", "hit_pct")


def read_scaler(m: DataFrame, r1: list[str], r2: list[str], control: str = "del2", bead: str = "neg_r1", bead2: str = "neg_r2", eps: float = 0.5) -> DataFrame:
    """Adds statistics of log ratios of raw counts: replicates against the control and the beads, and the second round against the first."""
    ratio = lambda a, b: F.log2((F.col(a) + eps) / (F.col(b) + eps))
    sets = {
        "del2": [ratio(s, control) for s in r1], "bead": [ratio(s, bead) for s in r1], "bead_r2": [ratio(s, bead2) for s in r2],
        "paired": [ratio(b, a) for a, b in zip(r1, r2, strict=False)],
    }
    averages = [stats.mean([F.col(s) for s in cols]).alias(f"avg_{g}") for g, cols in (("r1", r1), ("r2", r2))]
    m = m.select("*", *averages, *[stats.mean(c).alias(f"mean_{k}") for k, c in sets.items()], *[stats.deviation(c).alias(f"sd_{k}") for k, c in sets.items()], *[stats.mad(c).alias(f"mad_{k}") for k, c in sets.items()])
    m = m.withColumn("boost", F.log2((F.col("avg_r2") + eps) / (F.col("avg_r1") + eps)))
    return m.select("*", stats.deviation([F.col(s) for s in r1]).alias("sd_r1"), *[stats.t_test(F.col(f"mean_{k}"), F.col(f"sd_{k}"), len(c)).alias(f"p_{k}") for k, c in sets.items()])


def standardised(m: DataFrame, value: str, name: str) -> DataFrame:
    """Adds name: the value's distance from the mean of all rows in population deviations; null if they don't vary."""
    moments = m.agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd"))
    return m.crossJoin(F.broadcast(moments)).withColumn(name, F.when(F.col("_sd") > 0, (F.col(value) - F.col("_mu")) / F.col("_sd"))).drop("_mu", "_sd")  # one row


def rs_score(m: DataFrame, config: HitConfig) -> DataFrame:
    """Adds var_penalty and rs_score."""
    parts = F.filter(F.array(*[F.when((F.col(f"mad_{k}") > 0) & (F.col(f"sd_{k}") > 0), F.col(f"sd_{k}") / F.col(f"mad_{k}")) for k in ("del2", "bead", "paired")]), lambda x: x.isNotNull())
    average = F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / F.size(parts)).otherwise(F.lit(0.0))
    m = m.withColumn("var_penalty", config.lambda_var * average)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return m.withColumn("rs_score", config.alpha_boost * zero("boost") + config.beta_bead2 * zero("mean_bead_r2") + config.gamma_paired * zero("mean_paired") - F.col("var_penalty"))


def fail_reasons(m: DataFrame, config: HitConfig, least_avg: float = 1.0) -> Column:
    """The checks that a row fails, in order, joined by semicolons; a null never fails."""
    low = lambda c, bound, name: None if bound is None else F.when(F.col(c) < bound, name)
    high = lambda c, bound, name: None if bound is None else F.when(F.col(c) > bound, name)
    checks = [
        low("avg_r1", least_avg, "avg_R1"), low("avg_r2", least_avg, "avg_R2"), low("mean_del2", 0.0, "log2FC_DEL2"), low("mean_bead", config.least_bead, "log2FC_BEAD"),
        low("mean_bead_r2", config.least_bead_r2, "log2FC_BEAD_R2"), low("boost", config.least_boost, "boost"), high("q_bead", config.most_q_bead, "q_BEAD"), high("q_bead_r2", config.most_q_bead_r2, "q_BEAD_R2"),
    ]
    return F.concat_ws(";", *[c for c in checks if c is not None])


def gates(config: HitConfig) -> Column:
    """All gates that a row fails, in order, joined by semicolons. A bound of none isn't asked, a null or infinite value never fails.

    Columns: those of read_scaler(), q_bead, q_bead_r2, q_paired and z_r1.
    """
    checks = [
        ("avg_r1", "avg_R1", config.least_avg_r1, False), ("sd_r1", "sd_R1", config.most_sd_r1, True), ("mean_del2", "DEL2", config.least_del2, False), ("mean_bead", "BEAD_R1", config.least_bead, False),
        ("mean_bead_r2", "BEAD_R2", config.least_bead_r2, False), ("q_bead", "BEAD_R1_q", config.most_q_bead, True), ("q_bead_r2", "BEAD_R2_q", config.most_q_bead_r2, True), ("boost", "R2Boost_avg", config.least_boost, False),
        ("mean_paired", "R2Boost_paired_mean", config.least_paired, False), ("q_paired", "R2Boost_paired_q", config.most_q_paired, True), ("z_r1", "zscore", config.least_z, False),
    ]
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    out = [F.when(finite(c) & (F.col(c) > bound if above else F.col(c) < bound), name) for c, name, bound, above in checks if bound is not None]
    return F.concat_ws(";", *out)


def neg_hard_fail(config: HitConfig) -> Column:
    """Whether a bead ratio is below its bound or a bead q above it; nulls pass."""
    out = F.lit(False)
    for c, bound, above in (("mean_bead", config.least_bead, False), ("mean_bead_r2", config.least_bead_r2, False), ("q_bead", config.most_q_bead, True), ("q_bead_r2", config.most_q_bead_r2, True)):
        if bound is not None:
            out = out | F.coalesce(F.col(c) > bound if above else F.col(c) < bound, F.lit(False))
    return out


def centered(m: DataFrame, lfc: str, quantile: float, r2_most: float, most: float | None) -> DataFrame:
    """Adds <lfc>_centered: less its median over rows that look like nothing (low e, low second-round ratio), and <lfc>_fail."""
    m = staged(m)
    bound = stats.quantiles(m, {"_q": ("e", min(0.95, max(0.05, quantile)))})
    m = m.crossJoin(F.broadcast(bound))  # one row
    shift = stats.quantiles(m.filter((F.col("e") <= F.col("_q")) & (F.col("lfc_r2") <= r2_most)), {"_s": (lfc, 0.5)})
    m = m.crossJoin(F.broadcast(shift)).withColumn(f"{lfc}_centered", F.col(lfc) - F.coalesce("_s", F.lit(0.0))).drop("_q", "_s")  # one row
    return m.withColumn(f"{lfc}_fail", F.coalesce(F.col(f"{lfc}_centered") > most, F.lit(False)) if most is not None else F.lit(False))


def called(m: DataFrame, config: HitConfig) -> DataFrame:
    """Adds rs_fail, rs_pass, neg_hard_fail, glm_hit and consensus."""
    m = m.withColumn("rs_fail", fail_reasons(m, config)).withColumn("rs_pass", F.col("rs_fail") == "").withColumn("neg_hard_fail", neg_hard_fail(config))
    hit = (F.col("hit_pct") >= config.pct_cut) & (F.col("w_count") >= config.least_w) & (F.col("lfc_r2") >= config.least_r2)
    if config.gate == "hard":
        hit = hit & ~F.col("neg_hard_fail")
    return m.withColumn("glm_hit", hit).withColumn("consensus", F.col("glm_hit") & F.col("rs_pass"))


def annotated(m: DataFrame, blocks: DataFrame, positions: tuple[str, ...] = BLOCKS) -> DataFrame:
    """Adds smiles_<position>, by library and block or else by block alone (each the first by line), and smiles, those present joined by dots."""
    by_lib = blocks.groupBy("lib_id", "bb_id").agg(F.min_by("smiles", "line").alias("_a"))
    by_id = blocks.groupBy("bb_id").agg(F.min_by("smiles", "line").alias("_b"))
    for p in positions:
        a = by_lib.select("lib_id", F.col("bb_id").alias(p), "_a")
        m = m.join(a, ["lib_id", p], "left").join(by_id.select(F.col("bb_id").alias(p), "_b"), p, "left").withColumn(f"smiles_{p}", F.coalesce("_a", "_b")).drop("_a", "_b")
    whole = F.concat_ws(".", *[f"smiles_{p}" for p in positions])
    return m.withColumn("smiles", F.when(whole != "", whole).otherwise("NA"))


def rows_to_fit(m: DataFrame, mode: str, percent: float, cap: int | None = None) -> DataFrame:
    """Adds fit: all rows, none, or the best by baseline enrichment times depth."""
    if mode != "top":
        return m.withColumn("fit", F.lit(mode == "full"))
    score = (F.greatest("base_r1", F.lit(0.0)) * 0.5 + F.greatest("base_r2", F.lit(0.0))) * F.log10(F.col("mean_r1") + F.col("mean_r2") + 1)
    m = stats.counted(m.withColumn("_base", F.round(score, 9)), "_base")
    k = F.least(F.round(F.col("rows") * percent / 100.0), F.lit(cap if cap else 1 << 62))
    return m.withColumn("fit", F.col("rows") - F.col("below") - F.col("ties") < k).drop("_base", "below", "ties", "rows")
