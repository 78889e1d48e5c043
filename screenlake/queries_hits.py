"""Queries of hit calling beyond the closed form: the iterative fit, spreads and ranges of metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import stats
from .operators import compare, fit, hits
from .plans.config import preset
from .plans.staging import staged
from .plans.testbed import MATRIX_SQL, R1, R2, SAMPLES
from .queries import _NORM, _RS0, _TOTALS, BBS, FIXED, GROUPS, _base_frame, _clip, _m, _p, _query, _read_scaler, _syn, _v, matrix

METRICS = ("mean_del2", "mean_bead", "mean_paired")


@_query()
def glm_iterative(spark, sf_dir):
    """Log fold changes and dispersions by the iterative fit, with the weights that the groups' scatter asks for."""
    m = staged(_base_frame(spark, sf_dir))
    weights = hits.shrinkage(hits.fano(m, GROUPS))
    share = {"r1": "w_r1", "r2": "w_r2", "neg1": "w_neg", "neg2": "w_neg"}
    out = fit.fitted(m.crossJoin(F.broadcast(weights)), GROUPS, share, fixed=FIXED)  # one row
    return out.select("lib_id", "id", *[F.col(f"fit_{g}").alias(f"lfc_{g}") for g in GROUPS], "dispersion", "fit_steps")


@_query(f"WITH {MATRIX_SQL}, {_RS0}, d AS (SELECT " + ", ".join(f"median({c}) AS m_{c}" for c in METRICS) + " FROM r) SELECT " + ", ".join(f"round(median(abs({c} - m_{c})), 6) AS mad_{c}" for c in METRICS) + " FROM r, d")
def mad_scalar(spark, sf_dir):
    r = staged(_read_scaler(spark, sf_dir).select(*METRICS))
    return stats.absolute_deviation(r, list(METRICS)).select(*[F.round(f"mad_{c}", 6).alias(f"mad_{c}") for c in METRICS])


_RANGE = " UNION ALL ".join(f"SELECT lib_id, '{c}' AS metric, round(quantile_cont({c}, 0.01), 6) AS low, round(quantile_cont({c}, 0.99), 6) AS high FROM r GROUP BY lib_id" for c in (*METRICS, "boost"))


@_query(f"WITH {MATRIX_SQL}, {_RS0} {_RANGE}")
def metric_range(spark, sf_dir):
    """What a scale for colours spans: the 1st and 99th percentile of each metric by library, all in one selection."""
    r = staged(_read_scaler(spark, sf_dir).select("lib_id", *METRICS, "boost"))
    metrics = (*METRICS, "boost")
    wide = stats.quantiles(r, {f"{c}_{w}": (c, p) for c in metrics for w, p in (("low", 0.01), ("high", 0.99))}, ("lib_id",))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.round(f"{c}_low", 6).alias("low"), F.round(f"{c}_high", 6).alias("high")) for c in metrics])).alias("x")
    return wide.select("lib_id", each).select("lib_id", "x.metric", "x.low", "x.high")


# Three rounds and one control ------------------------------------------------------------------------------------------

THREE = {"r1": R1[:3], "r2": R2[:3], "r3": [R1[3], R2[3]], "neg2": ["neg_r2"]}
ARMS = ("r1", "r2", "r3")


_THREE_SAMPLES = [x for cols in THREE.values() for x in cols] + ["del2"]
# Size factors are relative to the median of the samples that are compared.
_THREE_TOTALS = _TOTALS.replace("list_aggregate([" + ", ".join(SAMPLES) + "]", "list_aggregate([" + ", ".join(_THREE_SAMPLES) + "]")


def _three_sql() -> str:
    base = ", ".join(f"{_m(c, 'n_')} AS mean_{g}, " + (f"CASE WHEN {_m(c, 'n_')} > 0 THEN sqrt({_v(['n_' + x for x in c])}) / {_m(c, 'n_')} END AS cv_{g}" if len(c) > 1 else f"NULL AS cv_{g}") for g, c in THREE.items())
    delta = ", ".join(f"ln(({' + '.join(c)} + 1e-12) / ({' + '.join(f'(n_del2 + pc) * greatest(sf_{s}, 1e-12)' for s in c)} + 1e-12)) AS d_{g}" for g, c in THREE.items())

    def alpha(g: str) -> str:
        e = [f"((n_del2 + pc) * greatest(sf_{s}, 1e-12) * exp(d_{g}))" for s in THREE[g]]
        mean, squares = f"(({' + '.join(e)}) / {float(len(e))})", f"(({' + '.join(f'{x} * {x}' for x in e)}) / {float(len(e))})"
        return f"greatest(0.0, ({_v(THREE[g])} - {mean} - {_v(e)}) / greatest({squares}, 1e-12))"

    return (
        f"WITH {MATRIX_SQL}, {_THREE_TOTALS}, {_NORM}, b AS (SELECT *, {base} FROM np), gd AS (SELECT *, {delta} FROM b), ga AS (SELECT *, {', '.join(f'd_{g} / ln(2.0) AS lfc_{g}' for g in THREE)}, {', '.join(f'{alpha(g)} AS alpha_{g}' for g in ARMS)} FROM gd), "
        "g AS (SELECT *, (alpha_r1 + alpha_r2 + alpha_r3) / 3.0 AS alpha, log10(mean_r1 + mean_r2 + mean_r3 + 1) AS depth FROM ga), "
        "cv AS (SELECT quantile_cont(cv, 0.75) AS cv75, quantile_cont(cv, 0.9) AS cv90 FROM (SELECT cv_r1 AS cv FROM g UNION ALL SELECT cv_r2 FROM g UNION ALL SELECT cv_r3 FROM g)), "
        "tu AS (SELECT quantile_cont(depth, 0.6) AS t0, " + _clip("(quantile_cont(depth, 0.75) - quantile_cont(depth, 0.25)) / 2.772", 0.2, 1.0) + " AS slope, " + ", ".join(f"{_clip(f'quantile_cont(lfc_r{k}, 0.9)', 2.0, 5.0)} AS c{k}" for k in (1, 2, 3)) + ", 0.5 AS w1, "
        + _clip("avg(CASE WHEN lfc_r2 > 0 THEN 1.0 ELSE 0.0 END)", 0.3, 0.9) + " AS w2, 0.4 AS w3, " + _clip("0.3 + 0.6 * least(quantile_cont(alpha, 0.75), 1.0)", 0.3, 1.0) + " AS l_alpha FROM g), "
        "p AS (SELECT tu.*, " + _clip("0.3 + 0.7 * cv75", 0.3, 1.0) + " AS l_cv, " + _clip("cv90", 0.6, 1.2) + " AS cap FROM tu, cv), "
        f"e0 AS (SELECT g.*, p.*, {', '.join(f'least(greatest(lfc_r{k}, 0.0), c{k}) AS e{k}' for k in (1, 2, 3))} FROM g, p), ec AS (SELECT *, 1 / (1 + exp(-(depth - t0) / slope)) AS w_count, w1 * e1 + w2 * e2 + w3 * e3 AS e, 0.5 * e1 + e2 + 0.25 * e3 AS e_syn FROM e0), "
        + ", ".join(map(_syn, BBS)) + ", sy AS (SELECT ec.*, " + " + ".join(f"z_{b}.z" for b in BBS) + " AS syn FROM ec " + " ".join(f"JOIN z_{b} ON z_{b}.k = ec.{b}" for b in BBS) + "), "
        "rh AS (SELECT " + _clip("0.2 / greatest(abs(quantile_cont(syn, 0.95)), abs(quantile_cont(syn, 0.05)), 1e-6)", 0.05, 0.35) + " AS rho FROM sy), "
        "h0 AS (SELECT sy.*, rho, l_alpha * least(alpha, 1.0) + l_cv * (" + " + ".join(f"least(coalesce(cv_{g}, cap), cap) / cap" for g in ARMS) + ") / 3.0 + 0.7 * greatest(0.0, lfc_neg2 - 0.05) AS penalty FROM sy, rh), h AS (SELECT *, e * w_count * (1 + rho * syn) - penalty AS hit_score FROM h0)"
    )


@_query(f"{_three_sql()} SELECT lib_id, id, round(e, 4) AS e, round(w_count, 4) AS w_count, round(penalty, 4) AS penalty, round(hit_score, 4) AS hit_score FROM h")
def hitscore_three_rounds(spark, sf_dir):
    """A screen of three rounds whose only control is the second round's, with the knobs of the medium preset."""
    g = staged(hits.glm(hits.baseline(matrix(spark, sf_dir), THREE), THREE, fixed=("neg2",)))
    _, weights = hits.negative_controls(None, "neg2")
    m = hits.synthons(hits.components(g, hits.tuned(g, ARMS), ARMS), BBS)
    out = hits.hit_score(m, preset("medium"), ARMS, weights)
    return out.select("lib_id", "id", *[F.round(c, 4).alias(c) for c in ("e", "w_count", "penalty", "hit_score")])


_F3 = ", ".join(f"median(CASE WHEN {_m(THREE[g], 'n_')} > 0 THEN {_v(['n_' + s for s in THREE[g]])} / {_m(THREE[g], 'n_')} END) AS f{g[1]}" for g in ARMS)
_LATER = "least(greatest(CASE WHEN {f} <= 1 THEN 0.3 WHEN {f} >= 3 THEN 0.95 ELSE 0.3 + ({f} - 1) * 0.325 END, 0.1), 0.98)"


@_query(f"WITH {MATRIX_SQL}, {_THREE_TOTALS}, {_NORM}, f AS (SELECT {_F3} FROM np) SELECT round(least(greatest(CASE WHEN f1 <= 1 THEN 0.1 WHEN f1 >= 3 THEN 0.9 ELSE 0.1 + (f1 - 1) * 0.4 END, 0.0), 0.95), 6) AS w_r1, round({_LATER.format(f='f2')}, 6) AS w_r2, round({_LATER.format(f='f3')}, 6) AS w_r3, 0.6::DOUBLE AS w_neg, false AS fix_neg_poisson FROM f")
def pre_tuned_three_rounds(spark, sf_dir):
    w = hits.shrinkage(hits.fano(hits.baseline(matrix(spark, sf_dir), THREE), THREE), strict=True)
    return w.withColumns({c: F.round(c, 6) for c in ("w_r1", "w_r2", "w_r3")})


# All gates, with q-values, under three presets -------------------------------------------------------------------------

_BH = lambda k: f"c_{k} AS (SELECT lib_id, id, p, p * count(*) OVER () / count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS raw FROM (SELECT lib_id, id, round(p_{k}, 9) AS p FROM rp)), q_{k} AS (SELECT lib_id, id, round(least(min(raw) OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1.0), 9) AS q FROM c_{k})"
PRESETS_ = {  # looser bounds on q than the presets' own, so that the gates part rows of small screens
    "medium": {"most_q_bead": 0.9, "most_q_bead_r2": 0.95, "most_sd_r1": 1.5, "least_paired": -0.5, "most_q_paired": 0.99, "least_z": -1.0}, "neg_heavy": {"most_q_bead": 0.97, "most_q_bead_r2": 0.97}, "very_hard": {"least_avg_r1": 0.5, "least_z": 0.5},
}


def _gate_sql(name: str) -> str:
    c = preset(name, **PRESETS_[name])
    checks = [
        ("avg_r1", "avg_R1", c.least_avg_r1, "<"), ("sd_r1", "sd_R1", c.most_sd_r1, ">"), ("mean_del2", "DEL2", c.least_del2, "<"), ("mean_bead", "BEAD_R1", c.least_bead, "<"), ("mean_bead_r2", "BEAD_R2", c.least_bead_r2, "<"), ("q_bead", "BEAD_R1_q", c.most_q_bead, ">"),
        ("q_bead_r2", "BEAD_R2_q", c.most_q_bead_r2, ">"), ("boost", "R2Boost_avg", c.least_boost, "<"), ("mean_paired", "R2Boost_paired_mean", c.least_paired, "<"), ("q_paired", "R2Boost_paired_q", c.most_q_paired, ">"), ("z_r1", "zscore", c.least_z, "<"),
    ]
    why = "concat_ws(';', " + ", ".join(f"CASE WHEN {col} {sign} {bound} THEN '{label}' END" for col, label, bound, sign in checks if bound is not None) + ")"
    hard = " OR ".join(f"coalesce({col} {sign} {bound}, false)" for col, _, bound, sign in checks if col in ("mean_bead", "mean_bead_r2", "q_bead", "q_bead_r2") and bound is not None)
    return f"SELECT '{name}' AS preset, lib_id, id, {why} AS fails, {hard} AS neg_hard_fail FROM x"


_ALL_GATES = (
    f"WITH {MATRIX_SQL}, {_RS0}, rp AS (SELECT *, sqrt({_v(R1)}) AS sd_r1, {_p('mean_paired', 'sd_paired')} AS p_paired FROM r), {', '.join(_BH(k) for k in ('bead', 'bead_r2', 'paired'))}, "
    "x AS (SELECT rp.lib_id, rp.id, avg_r1, round(sd_r1, 9) AS sd_r1, round(mean_del2, 9) AS mean_del2, round(mean_bead, 9) AS mean_bead, round(mean_bead_r2, 9) AS mean_bead_r2, round(boost, 9) AS boost, round(mean_paired, 9) AS mean_paired, "
    "round((avg_r1 - avg(avg_r1) OVER ()) / nullif(stddev_pop(avg_r1) OVER (), 0), 9) AS z_r1, a.q AS q_bead, b.q AS q_bead_r2, c.q AS q_paired FROM rp JOIN q_bead a USING (lib_id, id) JOIN q_bead_r2 b USING (lib_id, id) JOIN q_paired c USING (lib_id, id)) "
    + " UNION ALL ".join(map(_gate_sql, PRESETS_))
)


@_query(_ALL_GATES)
def all_gates(spark, sf_dir):
    """Every gate under three presets, with the controls' q-values and the hard gate."""
    r = _read_scaler(spark, sf_dir).withColumns({f"p_{k}": F.round(f"p_{k}", 9) for k in ("bead", "bead_r2", "paired")})
    for k in ("bead", "bead_r2", "paired"):
        r = staged(stats.false_discovery(r, f"p_{k}", f"q_{k}"))
    r = hits.standardised(r, "avg_r1", "z_r1").withColumns({c: F.round(c, 9) for c in ("sd_r1", "mean_del2", "mean_bead", "mean_bead_r2", "boost", "mean_paired", "z_r1", "q_bead", "q_bead_r2", "q_paired")})
    r = staged(r)
    parts = [r.select(F.lit(n).alias("preset"), "lib_id", "id", hits.gates(c := preset(n, **more)).alias("fails"), hits.neg_hard_fail(c).alias("neg_hard_fail")) for n, more in PRESETS_.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query(f"WITH {MATRIX_SQL}, x AS (SELECT lib_id, id, CASE WHEN bb1 = 'B3' THEN NULL ELSE bb1 END AS bb1, CASE WHEN bb2 = 'B4' THEN 'NA' ELSE bb2 END AS bb2, bb3, del2, neg_r1, neg_r2, r1c1 AS lfc_r1, r2c1 AS lfc_r2, r1c2 > 2 AS neg_hard_fail FROM m), b AS (SELECT greatest(0, quantile_cont(neg_r1, 0.8)) AS b1, greatest(0, quantile_cont(neg_r2, 0.8)) AS b2 FROM x), f AS (SELECT lib_id, id, concat_ws(';', CASE WHEN del2 < 2 THEN 'LOW_DEL2' END, CASE WHEN neg_r1 >= b1 AND b1 > 0 THEN 'NEG_R1_HIGH' END, CASE WHEN neg_r2 >= b2 AND b2 > 0 THEN 'NEG_R2_HIGH' END, CASE WHEN lfc_r2 < lfc_r1 - 1 THEN 'R2_DROP' END, CASE WHEN coalesce(bb1, 'NA') = 'NA' OR coalesce(bb2, 'NA') = 'NA' OR coalesce(bb3, 'NA') = 'NA' THEN 'BB_MISSING' END, CASE WHEN neg_hard_fail THEN 'NEG_HARD_FAIL' END) AS fl FROM x, b) SELECT lib_id, id, CASE WHEN fl = '' THEN 'OK' ELSE fl END AS flags FROM f")
def quality_flags_missing_blocks(spark, sf_dir):
    """Flags where blocks are missing and every other reason occurs."""
    m = matrix(spark, sf_dir).withColumns({"bb1": F.when(F.col("bb1") != "B3", F.col("bb1")), "bb2": F.when(F.col("bb2") == "B4", "NA").otherwise(F.col("bb2")), "lfc_r1": F.col("r1c1"), "lfc_r2": F.col("r2c1"), "neg_hard_fail": F.col("r1c2") > 2})
    return compare.quality_flags(m, "del2", ["neg_r1", "neg_r2"], 0.8, 2.0).select("lib_id", "id", "flags")
