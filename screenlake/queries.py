"""Queries over the driver's tables, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dna, ids, stats
from .operators import blocks, compare, counts, decode, hits, similarity
from .plans.config import preset
from .plans.staging import staged
from .plans.testbed import CUBE_SQL, MATRIX_SQL, R1, R2, SAMPLES, cube

GROUPS = {"r1": R1, "r2": R2, "neg1": ["neg_r1"], "neg2": ["neg_r2"]}
FIXED = ("neg1", "neg2")
CONFIG = preset("balanced")
BBS = ("bb1", "bb2", "bb3", "bb4")
Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def rounded9(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in cols})


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.matrix(cube(spark, sf_dir), SAMPLES, keep=BBS)


# Counts and scaling -----------------------------------------------------------------------------------------------


@_query(f"WITH {CUBE_SQL} SELECT lib_id, id, sample, count(*) AS n FROM cube GROUP BY ALL")
def count_cells(spark, sf_dir):
    return counts.cells(cube(spark, sf_dir))


@_query(f"WITH {MATRIX_SQL} SELECT lib_id, id, {', '.join(SAMPLES)} FROM m")
def count_matrix_pivot(spark, sf_dir):
    return counts.matrix(cube(spark, sf_dir), SAMPLES)


@_query(f"WITH {CUBE_SQL}, l AS (SELECT DISTINCT lib_id FROM cube UNION SELECT 'Z'), s AS (SELECT DISTINCT sample FROM cube), c AS (SELECT lib_id, sample, count(*) AS n FROM cube GROUP BY ALL) SELECT l.lib_id, s.sample, coalesce(n, 0) AS n FROM l CROSS JOIN s LEFT JOIN c ON c.lib_id = l.lib_id AND c.sample = s.sample")
def library_totals(spark, sf_dir):
    c = cube(spark, sf_dir)
    libs = c.select("lib_id").distinct().union(spark.createDataFrame([("Z",)], "lib_id string"))
    return counts.library_totals(c, libs, spark.createDataFrame([(s,) for s in SAMPLES], "sample string"))


@_query(f"WITH {CUBE_SQL}, c AS (SELECT lib_id, sample, count(*) AS n FROM cube GROUP BY ALL) SELECT lib_id, sample, n, round(n::DOUBLE / sum(n) OVER (PARTITION BY sample), 6) AS ratio FROM c")
def lib_sample_stats(spark, sf_dir):
    c = cube(spark, sf_dir).groupBy("lib_id", "sample").agg(F.count(F.lit(1)).alias("n"))
    total = c.groupBy("sample").agg(F.sum("n").alias("t"))
    return c.join(F.broadcast(total), "sample").select("lib_id", "sample", "n", F.round(F.col("n") / F.col("t"), 6).alias("ratio"))  # a row for each sample


_CPM = "WITH {cube}, c AS (SELECT lib_id, id, sample, count(*) AS n FROM cube GROUP BY ALL), d AS (SELECT {keys}, sum(n) AS denominator FROM c GROUP BY ALL) SELECT c.lib_id, c.id, c.sample, c.n, round(n * 1e6 / denominator, 6) AS cpm FROM c JOIN d USING ({keys})"


def _cpm(spark, sf_dir, keys):
    c = counts.cells(cube(spark, sf_dir))
    return counts.cpm(c, c.groupBy(*keys).agg(F.sum("n").alias("denominator")), keys)


@_query(_CPM.format(cube=CUBE_SQL, keys="sample"))
def cpm_sample_decoded(spark, sf_dir):
    return _cpm(spark, sf_dir, ["sample"])


@_query(_CPM.format(cube=CUBE_SQL, keys="lib_id, sample"))
def cpm_library_decoded(spark, sf_dir):
    return _cpm(spark, sf_dir, ["lib_id", "sample"])


@_query(f"WITH {CUBE_SQL}, c AS (SELECT lib_id, id, sample, count(*) AS n FROM cube GROUP BY ALL), d AS (SELECT ['r1c1','r1c2','r1c3','r1c4','r2c1','r2c2','r2c3','r2c4','neg_r1','neg_r2','del2'][(o_orderkey % 11 + 1)::INT] AS sample, count(*) AS denominator FROM orders GROUP BY ALL) SELECT lib_id, id, c.sample, n, round(CASE WHEN denominator > 0 THEN n * 1e6 / denominator ELSE 0 END, 6) AS cpm FROM c LEFT JOIN d ON c.sample = d.sample")
def cpm_sample_total_raw(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    sample = F.element_at(F.array(*map(F.lit, SAMPLES)), (F.col("o_orderkey") % 11 + 1).cast("int")).alias("sample")
    return counts.cpm(counts.cells(cube(spark, sf_dir)), o.groupBy(sample).agg(F.count(F.lit(1)).alias("denominator")), ["sample"])


_TOTALS = "t AS (SELECT lib_id, " + ", ".join(f"sum({s}) AS {s}" for s in SAMPLES) + " FROM m GROUP BY lib_id), tm AS (SELECT *, list_median AS md FROM (SELECT *, list_aggregate([" + ", ".join(SAMPLES) + "], 'median') AS list_median FROM t)), sf AS (SELECT lib_id, " + ", ".join(f"CASE WHEN md > 0 THEN {s} / md ELSE 1.0 END AS sf_{s}" for s in SAMPLES) + " FROM tm)"


@_query(f"WITH {MATRIX_SQL}, {_TOTALS} SELECT lib_id, " + ", ".join(f"round(sf_{s}, 6) AS sf_{s}" for s in SAMPLES) + " FROM sf")
def size_factors_per_lib(spark, sf_dir):
    return rounded(counts.size_factors(matrix(spark, sf_dir), SAMPLES), *[f"sf_{s}" for s in SAMPLES])


@_query(f"WITH {MATRIX_SQL}, q AS (SELECT quantile_cont(del2, 0.75) AS q FROM m) SELECT lib_id, id, del2 FROM m, q WHERE del2 >= greatest(q, 1) AND {' + '.join(SAMPLES)} >= 5")
def prefilter_quantile(spark, sf_dir):
    return counts.prefiltered(matrix(spark, sf_dir), SAMPLES, "del2", 0.75, 1, 5).select("lib_id", "id", "del2")


# Hit calling ------------------------------------------------------------------------------------------------------


def _m(cols: list[str], prefix: str = "") -> str:
    return "((" + " + ".join(prefix + c for c in cols) + f") / {float(len(cols))})"


def _v(exprs: list[str]) -> str:
    m = "((" + " + ".join(exprs) + f") / {float(len(exprs))})"
    return "((" + " + ".join(f"({e} - {m}) * ({e} - {m})" for e in exprs) + f") / {float(len(exprs) - 1)})"


def _clip(e: str, low, high) -> str:
    return f"least(greatest(coalesce({e}, {low}), {low}), {high})"


_NORM = "nm AS (SELECT m.*, sf.* EXCLUDE (lib_id), " + ", ".join(f"{s} / greatest(sf_{s}, 1e-12) AS n_{s}" for s in SAMPLES) + " FROM m JOIN sf USING (lib_id)), np AS (SELECT *, 0.5 * greatest(1.0, n_del2) AS pc FROM nm)"
_BASE = "b AS (SELECT *, " + ", ".join(
    f"{_m(c, 'n_')} AS mean_{g}, " + (f"CASE WHEN {_m(c, 'n_')} > 0 THEN sqrt({_v(['n_' + x for x in c])}) / {_m(c, 'n_')} END AS cv_{g}, " if len(c) > 1 else "") + f"log2(({_m(c, 'n_')} + pc) / (n_del2 + pc)) AS base_{g}"
    for g, c in GROUPS.items()
) + " FROM np)"
_DELTA = "gd AS (SELECT *, " + ", ".join(f"ln(({' + '.join(c)} + 1e-12) / ({' + '.join(f'(n_del2 + pc) * greatest(sf_{s}, 1e-12)' for s in c)} + 1e-12)) AS d_{g}" for g, c in GROUPS.items()) + " FROM b)"


def _alpha(g: str) -> str:
    e = [f"((n_del2 + pc) * greatest(sf_{s}, 1e-12) * exp(d_{g}))" for s in GROUPS[g]]
    mean = "((" + " + ".join(e) + f") / {float(len(e))})"
    squares = "((" + " + ".join(f"{x} * {x}" for x in e) + f") / {float(len(e))})"
    return f"greatest(0.0, ({_v(GROUPS[g])} - {mean} - {_v(e)}) / greatest({squares}, 1e-12))"


_GLM = "ga AS (SELECT *, " + ", ".join(f"d_{g} / ln(2.0) AS lfc_{g}" for g in GROUPS) + f", {_alpha('r1')} AS alpha_r1, {_alpha('r2')} AS alpha_r2 FROM gd), g AS (SELECT *, (alpha_r1 + alpha_r2) / 2.0 AS alpha, log10(mean_r1 + mean_r2 + 1) AS depth FROM ga)"
_TUNE = (
    "cv AS (SELECT quantile_cont(cv, 0.75) AS cv75, quantile_cont(cv, 0.9) AS cv90 FROM (SELECT cv_r1 AS cv FROM g UNION ALL SELECT cv_r2 FROM g)), "
    "tu AS (SELECT quantile_cont(depth, 0.6) AS t0, " + _clip("(quantile_cont(depth, 0.75) - quantile_cont(depth, 0.25)) / 2.772", 0.2, 1.0) + " AS slope, "
    + _clip("quantile_cont(lfc_r1, 0.9)", 2.0, 5.0) + " AS c1, " + _clip("quantile_cont(lfc_r2, 0.9)", 2.0, 5.0) + " AS c2, 0.5 AS w1, " + _clip("avg(CASE WHEN lfc_r2 > 0 THEN 1.0 ELSE 0.0 END)", 0.3, 0.9) + " AS w2, "
    + _clip("0.3 + 0.6 * least(quantile_cont(alpha, 0.75), 1.0)", 0.3, 1.0) + " AS l_alpha FROM g), "
    "p AS (SELECT tu.*, " + _clip("0.3 + 0.7 * cv75", 0.3, 1.0) + " AS l_cv, " + _clip("cv90", 0.6, 1.2) + " AS cap FROM tu, cv)"
)
_E = "e0 AS (SELECT g.*, p.*, least(greatest(lfc_r1, 0.0), c1) AS e1, least(greatest(lfc_r2, 0.0), c2) AS e2 FROM g, p), ec AS (SELECT *, 1 / (1 + exp(-(depth - t0) / slope)) AS w_count, w1 * e1 + w2 * e2 AS e, 0.5 * e1 + e2 AS e_syn FROM e0)"


def _syn(b: str) -> str:
    return (
        f"v_{b} AS (SELECT {b} AS k, median(e_syn) AS v FROM ec GROUP BY 1), m_{b} AS (SELECT median(v) AS m, avg(v) AS a, stddev_pop(v) AS s FROM v_{b}), "
        f"d_{b} AS (SELECT median(abs(v - m)) AS d FROM v_{b}, m_{b}), z_{b} AS (SELECT k, {_clip('CASE WHEN d > 1e-12 THEN 0.6745 * (v - m) / d ELSE (v - a) / (s + 1e-12) END', -3.0, 3.0)} AS z FROM v_{b}, m_{b}, d_{b})"
    )


_SYN = ", ".join(map(_syn, BBS)) + ", sy AS (SELECT ec.*, " + " + ".join(f"z_{b}.z" for b in BBS) + " AS syn FROM ec " + " ".join(f"JOIN z_{b} ON z_{b}.k = ec.{b}" for b in BBS) + ")"
_HIT = (
    "rh AS (SELECT " + _clip("0.2 / greatest(abs(quantile_cont(syn, 0.95)), abs(quantile_cont(syn, 0.05)), 1e-6)", 0.05, 0.35) + " AS rho FROM sy), "
    "h0 AS (SELECT sy.*, rho, l_alpha * least(alpha, 1.0) + l_cv * (least(coalesce(cv_r1, cap), cap) / cap + least(coalesce(cv_r2, cap), cap) / cap) / 2.0 + 0.5 * (greatest(0.0, lfc_neg1) + greatest(0.0, lfc_neg2)) / 2.0 AS penalty FROM sy, rh), "
    "h AS (SELECT *, e * w_count * (1 + rho * syn) - penalty AS hit_score FROM h0)"
)
_TO_GLM = f"WITH {MATRIX_SQL}, {_TOTALS}, {_NORM}, {_BASE}, {_DELTA}, {_GLM}"
_TO_HIT = f"{_TO_GLM}, {_TUNE}, {_E}, {_SYN}, {_HIT}"


def _base_frame(spark, sf_dir):
    return hits.baseline(matrix(spark, sf_dir), GROUPS)


def _glm_frame(spark, sf_dir):
    return staged(hits.glm(_base_frame(spark, sf_dir), GROUPS, fixed=FIXED))


def _scored(spark, sf_dir):
    g = _glm_frame(spark, sf_dir)
    return hits.hit_score(hits.synthons(hits.components(g, hits.tuned(g)), BBS), CONFIG)


@_query(f"WITH {MATRIX_SQL}, {_TOTALS}, {_NORM}, {_BASE} SELECT lib_id, id, round(base_r1, 6) AS base_r1, round(base_r2, 6) AS base_r2, round(cv_r1, 6) AS cv_r1, round(mean_r1, 6) AS mean_r1 FROM b")
def baseline_lfc(spark, sf_dir):
    return rounded(_base_frame(spark, sf_dir).select("lib_id", "id", "base_r1", "base_r2", "cv_r1", "mean_r1"), "base_r1", "base_r2", "cv_r1", "mean_r1")


@_query(f"{_TO_GLM} SELECT lib_id, id, round(lfc_r1, 5) AS lfc_r1, round(lfc_r2, 5) AS lfc_r2, round(lfc_neg1, 5) AS lfc_neg1, round(alpha, 5) AS alpha FROM g")
def glm_closed_form(spark, sf_dir):
    cols = ["lfc_r1", "lfc_r2", "lfc_neg1", "alpha"]
    return _glm_frame(spark, sf_dir).select("lib_id", "id", *[F.round(c, 5).alias(c) for c in cols])


@_query(f"{_TO_GLM} SELECT round(median(CASE WHEN {_m(R1, 'n_')} > 0 THEN {_v(['n_' + s for s in R1])} / {_m(R1, 'n_')} END), 6) AS fano_r1, round(median(CASE WHEN {_m(R2, 'n_')} > 0 THEN {_v(['n_' + s for s in R2])} / {_m(R2, 'n_')} END), 6) AS fano_r2 FROM g")
def fano_medians(spark, sf_dir):
    return rounded(hits.fano(_base_frame(spark, sf_dir), GROUPS), "fano_r1", "fano_r2")


@_query(f"{_TO_GLM}, {_TUNE} SELECT " + ", ".join(f"round({c}, 5) AS {c}" for c in ("t0", "slope", "c1", "c2", "w1", "w2", "l_alpha", "l_cv", "cap")) + " FROM p")
def tuned_parameters(spark, sf_dir):
    p = hits.tuned(_glm_frame(spark, sf_dir))
    return p.select(*[F.round(c, 5).alias(c) for c in ("t0", "slope", "c1", "c2", "w1", "w2", "l_alpha", "l_cv", "cap")])


@_query(f"{_TO_GLM}, {_TUNE}, {_E} SELECT lib_id, id, round(w_count, 5) AS w_count, round(e, 5) AS e, round(e_syn, 5) AS e_syn FROM ec")
def w_count_e_component(spark, sf_dir):
    g = _glm_frame(spark, sf_dir)
    return hits.components(g, hits.tuned(g)).select("lib_id", "id", *[F.round(c, 5).alias(c) for c in ("w_count", "e", "e_syn")])


@_query(f"{_TO_GLM}, {_TUNE}, {_E}, {_SYN} SELECT lib_id, id, round(syn, 4) AS syn FROM sy")
def synthon_scores(spark, sf_dir):
    g = _glm_frame(spark, sf_dir)
    return hits.synthons(hits.components(g, hits.tuned(g)), BBS).select("lib_id", "id", F.round("syn", 4).alias("syn"))


@_query(f"{_TO_HIT} SELECT lib_id, id, round(hit_score, 4) AS hit_score, round(penalty, 4) AS penalty FROM h")
def hitscore_glm(spark, sf_dir):
    return _scored(spark, sf_dir).select("lib_id", "id", F.round("hit_score", 4).alias("hit_score"), F.round("penalty", 4).alias("penalty"))


@_query(f"WITH {MATRIX_SQL}, x AS (SELECT lib_id, id, {' + '.join(R2)} AS v FROM m), r AS (SELECT *, rank() OVER (ORDER BY v) AS r, count(*) OVER (PARTITION BY v) AS t, count(*) OVER () AS n FROM x) SELECT lib_id, id, v, round(100.0 * (r + (t - 1) / 2.0) / n, 6) AS pct FROM r")
def rank_percent(spark, sf_dir):
    m = matrix(spark, sf_dir).select("lib_id", "id", stats.total([F.col(s) for s in R2]).alias("v"))
    return rounded(stats.percent_of_rank(m, "v", "pct"), "pct")


@_query(f"{_TO_HIT} SELECT lib_id, id, round(hit_score, 4) AS hit_score FROM h ORDER BY round(hit_score, 8) DESC, lib_id, id LIMIT 20")
def top_hits(spark, sf_dir):
    s = _scored(spark, sf_dir).withColumn("by", F.round("hit_score", 8))
    return compare.top(s, 20, "by", "lib_id", "id").select("lib_id", "id", F.round("hit_score", 4).alias("hit_score"))


def _ratio(a, b):
    return f"log2(({a} + 0.5) / ({b} + 0.5))"


def _p(mean: str, sd: str) -> str:
    t = f"atan(abs({mean} / ({sd} / 2.0)) / sqrt(3.0))"
    return f"CASE WHEN {sd} > 0 THEN greatest(1.0 - ({t} + sin({t}) * cos({t})) * (2.0 / pi()), 0.0) ELSE 1.0 END"


_SETS = {"del2": [_ratio(s, "del2") for s in R1], "bead": [_ratio(s, "neg_r1") for s in R1], "bead_r2": [_ratio(s, "neg_r2") for s in R2], "paired": [_ratio(b, a) for a, b in zip(R1, R2, strict=True)]}
_RS0 = (
    "r0 AS (SELECT *, " + ", ".join(f"[{', '.join(x)}] AS l_{k}" for k, x in _SETS.items()) + f", {_m(R1)} AS avg_r1, {_m(R2)} AS avg_r2 FROM m), "
    "r1 AS (SELECT *, " + ", ".join(f"(l_{k}[1] + l_{k}[2] + l_{k}[3] + l_{k}[4]) / 4.0 AS mean_{k}, list_aggregate(l_{k}, 'median') AS md_{k}" for k in _SETS) + ", log2((avg_r2 + 0.5) / (avg_r1 + 0.5)) AS boost FROM r0), "
    "r2 AS (SELECT *, " + ", ".join("sqrt((" + " + ".join(f"(l_{k}[{i}] - mean_{k}) * (l_{k}[{i}] - mean_{k})" for i in range(1, 5)) + f") / 3.0) AS sd_{k}, list_aggregate([" + ", ".join(f"abs(l_{k}[{i}] - md_{k})" for i in range(1, 5)) + f"], 'median') AS mad_{k}" for k in _SETS) + " FROM r1), "
    "r AS (SELECT *, " + ", ".join(f"{_p(f'mean_{k}', f'sd_{k}')} AS p_{k}" for k in ("del2", "bead", "bead_r2")) + " FROM r2)"
)


def _read_scaler(spark, sf_dir):
    return hits.read_scaler(matrix(spark, sf_dir), R1, R2)


@_query(f"WITH {MATRIX_SQL}, {_RS0} SELECT lib_id, id, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("mean_del2", "sd_del2", "mean_bead", "mad_bead", "mean_paired", "boost")) + " FROM r")
def readscaler_stats(spark, sf_dir):
    cols = ("mean_del2", "sd_del2", "mean_bead", "mad_bead", "mean_paired", "boost")
    return rounded(_read_scaler(spark, sf_dir).select("lib_id", "id", *cols), *cols)


@_query(f"WITH {MATRIX_SQL}, {_RS0} SELECT lib_id, id, round(p_del2, 6) AS p_del2, round(p_bead, 6) AS p_bead FROM r")
def t_pvalues(spark, sf_dir):
    return rounded(_read_scaler(spark, sf_dir).select("lib_id", "id", "p_del2", "p_bead"), "p_del2", "p_bead")


@_query(f"WITH {MATRIX_SQL}, {_RS0}, x AS (SELECT lib_id, id, round(p_bead, 9) AS p FROM r), c AS (SELECT *, p * count(*) OVER () / count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS raw FROM x) SELECT lib_id, id, round(least(min(raw) OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1.0), 6) AS q FROM c")
def bh_qvalues(spark, sf_dir):
    r = _read_scaler(spark, sf_dir).select("lib_id", "id", F.round("p_bead", 9).alias("p"))
    return rounded(stats.false_discovery(r, "p", "q").select("lib_id", "id", "q"), "q")


_RATIO3 = ", ".join(f"CASE WHEN round(mad_{k}, 9) > 0 AND round(sd_{k}, 9) > 0 THEN round(sd_{k}, 9) / round(mad_{k}, 9) END" for k in ("del2", "bead", "paired"))
_RS1 = f"rv AS (SELECT *, 0.3 * coalesce(list_avg([{_RATIO3}]), 0.0) AS var_penalty FROM r)"


@_query(f"WITH {MATRIX_SQL}, {_RS0}, {_RS1} SELECT lib_id, id, round(var_penalty, 4) AS var_penalty, round(0.5 * boost - var_penalty, 4) AS rs_score FROM rv")
def readscaler_score(spark, sf_dir):
    spreads = [f"{a}_{k}" for a in ("sd", "mad") for k in ("del2", "bead", "paired")]
    r = hits.rs_score(rounded9(_read_scaler(spark, sf_dir), *spreads), CONFIG)  # no noise of the last bit in a divisor
    return r.select("lib_id", "id", F.round("var_penalty", 4).alias("var_penalty"), F.round("rs_score", 4).alias("rs_score"))


_FAIL = "concat_ws(';', CASE WHEN avg_r1 < 1 THEN 'avg_R1' END, CASE WHEN avg_r2 < 1 THEN 'avg_R2' END, CASE WHEN round(mean_del2, 9) < 0 THEN 'log2FC_DEL2' END, CASE WHEN round(mean_bead, 9) < 0 THEN 'log2FC_BEAD' END, CASE WHEN round(boost, 9) < 0 THEN 'boost' END)"


@_query(f"WITH {MATRIX_SQL}, {_RS0} SELECT lib_id, id, {_FAIL} AS rs_fail, round(mean_bead, 9) < 0 AS neg_hard_fail FROM r")
def fail_reasons(spark, sf_dir):
    r = _read_scaler(spark, sf_dir).withColumns({c: F.round(c, 9) for c in ("mean_del2", "mean_bead", "boost")})
    return r.select("lib_id", "id", hits.fail_reasons(r, CONFIG).alias("rs_fail"), hits.neg_hard_fail(CONFIG).alias("neg_hard_fail"))


@_query(f"{_TO_GLM}, {_TUNE}, {_E}, er AS (SELECT * REPLACE (round(e, 8) AS e, round(lfc_r2, 8) AS lfc_r2, round(lfc_neg1, 8) AS lfc_neg1) FROM ec), q AS (SELECT quantile_cont(e, 0.5) AS q FROM er), s AS (SELECT median(lfc_neg1) AS s FROM er, q WHERE e <= q AND lfc_r2 <= 0.5) SELECT lib_id, id, round(lfc_neg1 - s, 5) AS lfc_neg1_centered FROM er, s")
def neg_centering(spark, sf_dir):
    g = _glm_frame(spark, sf_dir)
    m = hits.components(g, hits.tuned(g)).withColumns({c: F.round(c, 8) for c in ("e", "lfc_r2", "lfc_neg1")})
    return hits.centered(m, "lfc_neg1", 0.5, 0.5, None).select("lib_id", "id", F.round("lfc_neg1_centered", 5).alias("lfc_neg1_centered"))


_CALL = f"hr AS (SELECT h.*, r.* EXCLUDE (lib_id, id, {', '.join(BBS)}, {', '.join(SAMPLES)}) FROM h JOIN r USING (lib_id, id)), hk AS (SELECT * REPLACE (round(hit_score, 8) AS hit_score) FROM hr), hp AS (SELECT *, 100.0 * (rank() OVER (ORDER BY hit_score) + (count(*) OVER (PARTITION BY hit_score) - 1) / 2.0) / count(*) OVER () AS hit_pct FROM hk), hc AS (SELECT *, {_FAIL} AS rs_fail, round(mean_bead, 9) < 0 AS neg_hard_fail, hit_pct >= 95 AND w_count >= 0.5 AND lfc_r2 >= 0 AS glm_hit FROM hp)"


def _called(spark, sf_dir):
    s = _scored(spark, sf_dir).drop("hit_pct").withColumn("hit_score", F.round("hit_score", 8))
    s = hits.read_scaler(stats.percent_of_rank(s, "hit_score", "hit_pct"), R1, R2)
    return hits.called(s.withColumns({c: F.round(c, 9) for c in ("mean_del2", "mean_bead", "boost")}), CONFIG)


@_query(f"{_TO_HIT}, {_RS0}, {_CALL} SELECT lib_id, id, glm_hit, rs_fail = '' AS rs_pass, neg_hard_fail, glm_hit AND rs_fail = '' AS consensus FROM hc")
def consensus_hits(spark, sf_dir):
    return _called(spark, sf_dir).select("lib_id", "id", "glm_hit", "rs_pass", "neg_hard_fail", "consensus")


@_query(f"{_TO_HIT}, {_RS0}, {_CALL} SELECT lib_id, id FROM hc WHERE glm_hit AND rs_fail = '' AND NOT neg_hard_fail")
def recommended_hits(spark, sf_dir):
    return compare.recommended(_called(spark, sf_dir)).select("lib_id", "id")


@_query(f"{_TO_GLM}, x AS (SELECT lib_id, id, round((greatest(base_r1, 0) * 0.5 + greatest(base_r2, 0)) * depth, 9) AS s FROM g), r AS (SELECT *, rank() OVER (ORDER BY s DESC) AS r, count(*) OVER () AS n FROM x) SELECT lib_id, id, r - 1 < round(n * 0.02) AS fit FROM r")
def glm_top_select(spark, sf_dir):
    return hits.rows_to_fit(_base_frame(spark, sf_dir), "top", 2.0).select("lib_id", "id", "fit")


_PARTS = "bbt AS (SELECT p_partkey AS line, CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS lib_id, 'B' || (p_partkey % 23) AS bb_id, 'C' || p_name AS smiles FROM part)"


def _bbs(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    lib = F.when(F.col("p_partkey") % 3 == 0, "A").when(F.col("p_partkey") % 3 == 1, "N").otherwise("R")
    return p.select(F.col("p_partkey").alias("line"), lib.alias("lib_id"), F.concat(F.lit("B"), (F.col("p_partkey") % 23).cast("string")).alias("bb_id"), F.concat(F.lit("C"), "p_name").alias("smiles"))


@_query(
    f"WITH {MATRIX_SQL}, {_PARTS}, bl AS (SELECT lib_id, bb_id, arg_min(smiles, line) AS s FROM bbt GROUP BY ALL), bi AS (SELECT bb_id, arg_min(smiles, line) AS s FROM bbt GROUP BY ALL) SELECT m.lib_id, m.id, "
    + ", ".join(f"coalesce(l{i}.s, i{i}.s) AS smiles_bb{i}" for i in (1, 2, 3))
    + ", CASE WHEN concat_ws('.', coalesce(l1.s, i1.s), coalesce(l2.s, i2.s), coalesce(l3.s, i3.s)) = '' THEN 'NA' ELSE concat_ws('.', coalesce(l1.s, i1.s), coalesce(l2.s, i2.s), coalesce(l3.s, i3.s)) END AS smiles FROM m "
    + " ".join(f"LEFT JOIN bl l{i} ON l{i}.lib_id = m.lib_id AND l{i}.bb_id = m.bb{i} LEFT JOIN bi i{i} ON i{i}.bb_id = m.bb{i}" for i in (1, 2, 3))
)
def annotate_bb_pref_lib(spark, sf_dir):
    return hits.annotated(matrix(spark, sf_dir), _bbs(spark, sf_dir), ("bb1", "bb2", "bb3")).select("lib_id", "id", "smiles_bb1", "smiles_bb2", "smiles_bb3", "smiles")


# Building blocks and ids --------------------------------------------------------------------------------------------


@_query(f"WITH {_PARTS}, seen AS (SELECT bb_id, lib_id, smiles, min(line) AS l FROM bbt GROUP BY ALL), ix AS (SELECT *, row_number() OVER (PARTITION BY bb_id, lib_id ORDER BY l) AS k, count(*) OVER (PARTITION BY bb_id, lib_id) AS n FROM seen), u AS (SELECT bb_id, count(DISTINCT lib_id) AS libs FROM bbt GROUP BY 1) SELECT t.line, t.bb_id || CASE WHEN n > 1 THEN '.' || k ELSE '' END || CASE WHEN libs > 1 THEN '_LIB' || t.lib_id ELSE '' END AS fixed_id FROM bbt t JOIN ix USING (bb_id, lib_id, smiles) JOIN u USING (bb_id)")
def bb_id_resolution(spark, sf_dir):
    return blocks.resolved(_bbs(spark, sf_dir)).select("line", "fixed_id")


@_query("WITH t AS (SELECT p_partkey AS line, upper(CASE p_partkey % 2 WHEN 0 THEN 'codon' ELSE 'HP' END) AS type, p_brand AS lib_id, translate(substr(md5(p_type), 1, 9), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, p_name AS bb_id FROM part), f AS (SELECT *, first_value(bb_id) OVER (PARTITION BY type, lib_id, seq ORDER BY line) AS first_id FROM t) SELECT 'DUP_' || type AS kind, lib_id, seq, first_id, bb_id AS conflict_id, line FROM f WHERE bb_id <> first_id")
def duplicate_tags(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    seq = F.translate(F.substring(F.md5(F.col("p_type").cast("binary")), 1, 9), "0123456789abcdef", "ACGTACGTACGTACGT")
    rows = p.select(F.col("p_partkey").alias("line"), F.when(F.col("p_partkey") % 2 == 0, "codon").otherwise("HP").alias("type"), F.col("p_brand").alias("lib_id"), seq.alias("seq"), F.col("p_name").alias("bb_id"), F.lit("C").alias("smiles"))
    return blocks.duplicates(blocks.cleaned(rows))


_HARD = {  # forms of an id, by number, with what they mean
    0: ("concat_ws('_', '3', a, b, c)", "3", ("a", "b", "c", "'NA'"), "'NA'"), 1: ("concat_ws('|', a, b, c, d)", "4", ("a", "b", "c", "d"), "'NA'"),
    2: ("concat_ws('_', '3', a, 'LIBx1', b, c, 'NA')", "3", ("a || '_LIBx1'", "b", "c", "'NA'"), "'NA'"), 3: ("concat_ws('_', a, b, 'LIBx1', 'LIBy2', c)", "4", ("a", "b || '_LIBx1'", "'LIBy2'", "c"), "'NA'"),
    4: ("concat_ws('_', '4', a, 'NA', 'LIBz', c, d, 'zz', 'cpA7')", "4", ("a", "'NA'", "'LIBz'", "c"), "'cpA7'"), 5: ("concat_ws(';', a, b, c, 'NA', 'DEL12')", "3", ("a", "b", "c", "'NA'"), "'DEL12'"),
    6: ("concat_ws(' ', '3', a, b, c, 'NA', 'DEL12', 'x')", "3", ("a", "b", "c", "'NA'"), "'NA'"), 7: ("''", "3", ("'NA'",) * 4, "'NA'"),
}
_HARD_OF = lambda part: "CASE k " + " ".join(f"WHEN {k} THEN {part(v)}" for k, v in _HARD.items()) + " END"
_HARD_ROWS = "p_partkey % 8 AS k, 'B' || (p_partkey % 20) AS a, 'X' || (p_partkey % 7) AS b, 'B' || (p_partkey % 13) AS c, 'Q' || (p_partkey % 3) AS d"


@_query(
    f"WITH x AS (SELECT p_partkey, {_HARD_ROWS} FROM part) SELECT p_partkey, {_HARD_OF(lambda v: v[0])} AS id, {_HARD_OF(lambda v: v[1])} AS cycles, "
    + ", ".join(f"{_HARD_OF(lambda v, i=i: v[2][i])} AS bb{i + 1}" for i in range(4)) + f", {_HARD_OF(lambda v: v[3])} AS cp FROM x"
)
def parse_ids(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey", *_HARD_ROWS.split(", "))
    p = p.select("p_partkey", F.expr(_HARD_OF(lambda v: v[0])).alias("id")).withColumn("p", ids.parsed(F.col("id")))
    return p.select("p_partkey", "id", "p.cycles", "p.bb1", "p.bb2", "p.bb3", "p.bb4", "p.cp")


@_query(f"WITH {CUBE_SQL}, i AS (SELECT DISTINCT id FROM cube) SELECT id, split_part(id, '_', 2) || '|' || split_part(id, '_', 3) || '|' || split_part(id, '_', 4) || '|NA' AS compound_key FROM i")
def compound_keys(spark, sf_dir):
    p = cube(spark, sf_dir).select("id").distinct().withColumn("p", ids.parsed(F.col("id")))
    return p.select("id", ids.compound_key(*[F.col(f"p.bb{i}") for i in range(1, 5)]).alias("compound_key"))


@_query(f"WITH {CUBE_SQL} SELECT DISTINCT lib_id, id, concat_ws('_', lib_id, bb1, bb2, bb3) AS display_id FROM cube")
def display_ids(spark, sf_dir):
    return cube(spark, sf_dir).select("lib_id", "id", ids.display_id(F.col("lib_id"), *map(F.col, BBS)).alias("display_id")).distinct()


_DNA = "s AS (SELECT event_id, translate(md5(event_id::VARCHAR), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM events)"


def _sequences(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", F.translate(F.md5(F.col("event_id").cast("string").cast("binary")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("seq"))


@_query(f"WITH {_DNA} SELECT event_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc FROM s")
def revcomp(spark, sf_dir):
    return _sequences(spark, sf_dir).select("event_id", dna.reverse_complement(F.col("seq")).alias("rc"))


_VARIANTS = (
    "v AS (SELECT event_id, 'substitution' AS kind, substr(seq, 1, i - 1) || b || substr(seq, i + 1) AS variant FROM s, generate_series(1, 32) g(i), (VALUES ('A'), ('C'), ('G'), ('T')) v(b) WHERE b <> substr(seq, i, 1) "
    "UNION SELECT event_id, 'deletion', substr(seq, 1, i - 1) || substr(seq, i + 1) FROM s, generate_series(1, 32) g(i) "
    "UNION SELECT event_id, 'insertion', substr(seq, 1, i) || b || substr(seq, i + 1) FROM s, generate_series(1, 31) g(i), (VALUES ('A'), ('C'), ('G'), ('T')) v(b) WHERE NOT (i = 1 AND b = substr(seq, 1, 1)) AND NOT (i = 31 AND b = substr(seq, 32, 1)))"
)


@_query(f"WITH {_DNA}, {_VARIANTS} SELECT event_id, kind, count(*) AS n, md5(string_agg(variant, ',' ORDER BY variant)) AS digest FROM v GROUP BY ALL")
def one_bp_variants(spark, sf_dir):
    kinds = {"substitution": dna.substitutions, "deletion": dna.deletions, "insertion": dna.insertions}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.array_sort(F.array_distinct(f(F.col("seq")))).alias("list")) for k, f in kinds.items()])).alias("v")
    rows = _sequences(spark, sf_dir).select("event_id", each)
    return rows.select("event_id", "v.kind", F.size("v.list").cast("long").alias("n"), F.md5(F.concat_ws(",", "v.list").cast("binary")).alias("digest"))


@_query(f"WITH {_DNA}, k AS (SELECT event_id, (i - 1)::INTEGER AS pos, substr(seq, i, 4) AS kmer FROM s, generate_series(1, 29) g(i)) SELECT event_id, pos FROM k WHERE kmer = 'ACGT'")
def kmer_scan(spark, sf_dir):
    w = _sequences(spark, sf_dir).select("event_id", F.explode(dna.kmers(F.col("seq"), 4)).alias("w"))
    return w.filter("w.kmer = 'ACGT'").select("event_id", "w.pos")


# Decoding -----------------------------------------------------------------------------------------------------------

EVENTS_A_TASK = 1_000_000
CYCLES, SIZES = 3, {"HP": [7, 8, 9], "OP": [11, 12, 13], "CP": [15, 16, 17], "CODON": [9]}


def _design() -> list[tuple[str, str, int, str, str]]:
    """A library design of two libraries with six codons a cycle, made from hashes."""
    import hashlib

    seq = lambda name, n: hashlib.md5(name.encode()).hexdigest()[:n].translate(str.maketrans("0123456789abcdef", "ACGTACGTACGTACGT"))
    rows = [("HP", "", 0, "H1", seq("hp", 8)), ("OP", "", 0, "O1", seq("op", 12))]
    for lib in ("L1", "L2"):
        rows.append(("CP", lib, 0, f"C{lib}", seq(f"cp{lib}", 16)))
        rows += [("CODON", lib, c, f"{lib}B{c}{k}", seq(f"{lib}{c}{k}", 9)) for c in (1, 2, 3) for k in range(6)]
    return rows


def tags(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_design(), "type string, lib_id string, cycle int, bb_id string, seq string")


def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in as many parts as their number asks for: a row group in one file would be one task, and parts that only follow the cores grow with the input."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    return e.repartition(max(spark.sparkContext.defaultParallelism, -(-e.count() // EVENTS_A_TASK)), "event_id")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read for each event: a molecule of the design, changed by the class event_id % 8; in one of four samples."""
    e = event_ids(spark, sf_dir)
    t = {r[:4]: r[4] for r in _design()}
    pick = lambda lib, c: F.element_at(F.array(*[F.lit(t["CODON", lib, c, f"{lib}B{c}{k}"]) for k in range(6)]), (F.col("event_id") % (5 + c - 1) % 6 + 1).cast("int"))
    body = lambda lib: F.concat(F.lit(t["HP", "", 0, "H1"] + t["OP", "", 0, "O1"]), pick(lib, 1), pick(lib, 2), pick(lib, 3), F.lit(t["CP", lib, 0, f"C{lib}"]))
    whole = F.when(F.col("event_id") % 3 == 0, body("L2")).otherwise(body("L1"))
    c = F.col("event_id") % 8
    read = (
        F.when(c == 1, dna.reverse_complement(whole)).when(c == 2, F.concat(F.substring(whole, 1, 3), F.substring(whole, 5, 200))).when(c == 3, F.substring(whole, 9, 200))
        .when(c == 4, F.substring(whole, 1, 47)).when(c == 5, F.concat(F.lit("GATTACA"), whole)).when(c == 6, F.concat(F.substring(whole, 1, 20), F.lit("TTTTTTTT"), F.substring(whole, 21, 200))).otherwise(whole)
    )
    return e.select(F.concat(F.lit("S"), (F.floor(F.col("event_id") / 8) % 4).cast("string")).alias("sample"), F.col("event_id").alias("read_id"), read.alias("seq"))


def _decode_sql() -> str:
    """The reads, the patterns with their variants, all hits and the best candidate of each read, as table expressions."""

    def variants(s: str) -> set[str]:
        n = len(s)
        out = {s[:i] + b + s[i + 1 :] for i in range(n) for b in "ACGT"} | {s[:i] + s[i + 1 :] for i in range(n)}
        return (out | {s[:i] + b + s[i:] for i in range(1, n) for b in "ACGT" if not (i == 1 and b == s[0]) and not (i == n - 1 and b == s[-1])}) - {s}

    t, rows = {r[:4]: r[4] for r in _design()}, []
    for kind, lib, cycle, bb, seq in _design():
        rows += [(kind, lib, cycle, bb, k, m) for k, m in [(seq, 0), *[(v, 1) for v in sorted(variants(seq)) if kind != "CODON"]]]
    values = ", ".join(f"('{a}', '{b}', {c}, '{d}', '{e}', {f})" for a, b, c, d, e, f in rows)
    pick = lambda lib, c: "[" + ", ".join(f"'{t['CODON', lib, c, f'{lib}B{c}{k}']}'" for k in range(6)) + f"][(event_id % {5 + c - 1} % 6 + 1)::INT]"
    body = lambda lib: f"'{t['HP', '', 0, 'H1'] + t['OP', '', 0, 'O1']}' || {pick(lib, 1)} || {pick(lib, 2)} || {pick(lib, 3)} || '{t['CP', lib, 0, f'C{lib}']}'"
    best = "dir, cp_miss, cp_pos DESC, lib_id, cp_len, op_miss, op_pos DESC, CASE WHEN op_lib = lib_id THEN 0 ELSE 1 END, op_len, hp_miss, hp_pos DESC, CASE WHEN hp_lib = lib_id THEN 0 ELSE 1 END, hp_len, penalty, c1_pos, bb1, c2_pos, bb2, c3_pos, bb3"
    codon = lambda k, end: f"JOIN h c{k} ON c{k}.read_id = cp.read_id AND c{k}.dir = cp.dir AND c{k}.lib_id = cp.lib_id AND c{k}.type = 'CODON' AND c{k}.cycle = {k} AND abs(c{k}.pos - {end}) <= 3"
    return f"""ev AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN {body("L2")} ELSE {body("L1")} END AS whole FROM events),
    rd AS (SELECT 'S' || (event_id // 8 % 4) AS sample, event_id AS read_id, CASE event_id % 8 WHEN 1 THEN reverse(translate(whole, 'ACGT', 'TGCA')) WHEN 2 THEN substr(whole, 1, 3) || substr(whole, 5) WHEN 3 THEN substr(whole, 9)
      WHEN 4 THEN substr(whole, 1, 47) WHEN 5 THEN 'GATTACA' || whole WHEN 6 THEN substr(whole, 1, 20) || 'TTTTTTTT' || substr(whole, 21) ELSE whole END AS seq FROM ev),
    pat AS (SELECT * FROM (VALUES {values}) v(type, lib_id, cycle, bb_id, kmer, miss)),
    tried AS (SELECT * FROM rd WHERE true),
    di AS (SELECT read_id, 0 AS dir, seq FROM tried UNION ALL SELECT read_id, 1, reverse(translate(seq, 'ACGT', 'TGCA')) FROM tried),
    wi AS (SELECT read_id, dir, i - 1 AS pos, substr(seq, i, k) AS kmer FROM di, generate_series(1, 80) g(i), (VALUES (7), (8), (9), (11), (12), (13), (15), (16), (17)) l(k) WHERE i + k - 1 <= length(seq)),
    h AS (SELECT read_id, dir, pos::INTEGER AS pos, pat.*, length(kmer)::INTEGER AS len FROM wi JOIN pat USING (kmer)),
    ca AS (SELECT cp.read_id, cp.dir, cp.lib_id, cp.pos AS cp_pos, cp.len AS cp_len, cp.miss AS cp_miss, op.pos AS op_pos, op.len AS op_len, op.miss AS op_miss, op.lib_id AS op_lib, hp.pos AS hp_pos, hp.len AS hp_len, hp.miss AS hp_miss, hp.lib_id AS hp_lib,
      abs(c1.pos - (op.pos + op.len)) + abs(c2.pos - (c1.pos + c1.len)) + abs(c3.pos - (c2.pos + c2.len)) + abs(cp.pos - (c3.pos + c3.len)) AS penalty,
      c1.pos AS c1_pos, c2.pos AS c2_pos, c3.pos AS c3_pos, c1.bb_id AS bb1, c2.bb_id AS bb2, c3.bb_id AS bb3
      FROM h cp JOIN h op ON op.read_id = cp.read_id AND op.dir = cp.dir AND op.type = 'OP' AND op.lib_id IN ('', cp.lib_id) AND op.pos < cp.pos
      JOIN h hp ON hp.read_id = cp.read_id AND hp.dir = cp.dir AND hp.type = 'HP' AND hp.lib_id IN ('', cp.lib_id) AND hp.pos < op.pos AND abs(op.pos - hp.pos - hp.len) <= 3
      {codon(1, "(op.pos + op.len)")} {codon(2, "(c1.pos + c1.len)")} {codon(3, "(c2.pos + c2.len)")} WHERE cp.type = 'CP' AND abs(cp.pos - (c3.pos + c3.len)) <= 3),
    done AS (SELECT * EXCLUDE (r, op_lib, hp_lib) FROM (SELECT *, row_number() OVER (PARTITION BY read_id ORDER BY {best}) AS r FROM ca) WHERE r = 1),
    an AS (SELECT read_id, max(CASE type WHEN 'CP' THEN 1 ELSE 0 END) AS cp, max(CASE type WHEN 'OP' THEN 1 ELSE 0 END) AS op, max(CASE type WHEN 'HP' THEN 1 ELSE 0 END) AS hp FROM h WHERE dir = 0 GROUP BY 1),
    und AS (SELECT t.read_id, CASE WHEN coalesce(cp, 0) = 0 THEN 'no_cp' WHEN coalesce(op, 0) = 0 THEN 'no_op' WHEN coalesce(hp, 0) = 0 THEN 'no_hp' ELSE 'codon_fail' END AS reason
      FROM tried t LEFT JOIN an USING (read_id) WHERE t.read_id NOT IN (SELECT read_id FROM done))"""


_DECODE = "WITH " + _decode_sql()
_LIMITED = _DECODE.replace("WHERE true", "WHERE abs(length(seq) - 63) <= 7")
_OUTCOME = _LIMITED + ", oc AS (SELECT rd.sample, rd.read_id, CASE WHEN d.read_id IS NOT NULL THEN CASE WHEN hp_pos <= op_pos AND op_pos <= c1_pos AND c1_pos <= c2_pos AND c2_pos <= c3_pos AND c3_pos <= cp_pos THEN 'decoded' ELSE 'order_violation' END WHEN u.read_id IS NOT NULL THEN reason ELSE 'len_out_of_range' END AS outcome FROM rd LEFT JOIN done d ON d.read_id = rd.read_id LEFT JOIN und u ON u.read_id = rd.read_id)"


def _done(spark, sf_dir):
    table = staged(decode.patterns(tags(spark)))
    r = staged(reads(spark, sf_dir).select("read_id", "seq"))  # read twice: for the different texts, and joined with what they are decoded to
    return r, table, decode.decoded(r, table, CYCLES, SIZES)


def _outcomes(spark, sf_dir):
    """Decoded reads with their sample, and every read's outcome, behind a filter on lengths."""
    r = staged(reads(spark, sf_dir))
    kind = counts.length_class(F.length("seq"), 63, 63, 7, mode="3")
    return decode.outcomes(r, staged(decode.patterns(tags(spark))), CYCLES, SIZES, counts.length_passes(kind))


@_query(f"{_DECODE} SELECT * FROM done")
def decode_reads(spark, sf_dir):
    return _done(spark, sf_dir)[2].drop("cycles", "c1_len", "c2_len", "c3_len")


@_query(f"{_DECODE} SELECT * FROM und")
def undecoded_reasons(spark, sf_dir):
    r = staged(reads(spark, sf_dir).select("read_id", "seq"))
    return decode.undecoded_reasons(r, decode.attempts(r, staged(decode.patterns(tags(spark))), CYCLES, SIZES)).select("read_id", "reason")


_GAPS = ", gaps AS (SELECT lib_id, 'hp_op' AS metric, op_pos - hp_pos - hp_len AS gap FROM done UNION ALL SELECT lib_id, 'op_c1', c1_pos - op_pos - op_len FROM done UNION ALL SELECT lib_id, 'c1_c2', c2_pos - c1_pos - 9 FROM done UNION ALL SELECT lib_id, 'c2_c3', c3_pos - c2_pos - 9 FROM done UNION ALL SELECT lib_id, 'c3_cp', cp_pos - c3_pos - 9 FROM done)"


@_query(f"{_DECODE}{_GAPS} SELECT lib_id, metric, count(*) AS n, round(avg(gap), 6) AS mean, round(stddev_pop(gap), 6) AS sd, min(gap)::DOUBLE AS least, max(gap)::DOUBLE AS greatest FROM gaps GROUP BY ALL")
def gap_stats(spark, sf_dir):
    return rounded(decode.gap_stats(_done(spark, sf_dir)[2], CYCLES, 9), "mean", "sd")


@_query(f"{_DECODE} SELECT lib_id, dir, count(*) AS n, " + ", ".join(f"count(*) FILTER ({a}_miss = {m}) AS {a}_{w}" for a in ("hp", "op", "cp") for m, w in ((0, "perf"), (1, "miss"))) + " FROM done GROUP BY ALL")
def anchor_quality(spark, sf_dir):
    return decode.anchor_quality(_done(spark, sf_dir)[2])


@_query(f"{_DECODE} SELECT lib_id, cycle, bb_id, count(*) AS n FROM (SELECT lib_id, 1 AS cycle, bb1 AS bb_id FROM done UNION ALL SELECT lib_id, 2, bb2 FROM done UNION ALL SELECT lib_id, 3, bb3 FROM done) GROUP BY ALL")
def bb_frequency_by_cycle(spark, sf_dir):
    return decode.block_counts(_done(spark, sf_dir)[2], CYCLES)


@_query(f"{_OUTCOME} SELECT sample, count(*) AS total_reads, count(*) FILTER (outcome = 'decoded') AS decoded_reads, " + ", ".join(f"count(*) FILTER (outcome = '{k}') AS {k}" for k in ("no_cp", "no_op", "no_hp", "codon_fail", "len_out_of_range", "order_violation")) + " FROM oc GROUP BY sample")
def decoding_summary(spark, sf_dir):
    return decode.decoding_summary(_outcomes(spark, sf_dir)[1])


@_query(f"{_OUTCOME} SELECT sample, count(*) AS total_reads, count(*) FILTER (outcome <> 'len_out_of_range') AS length_passed_reads, count(*) FILTER (outcome = 'decoded') AS decoded_reads, round(100.0 * count(*) FILTER (outcome = 'decoded') / count(*), 3) AS decode_rate_pct FROM oc GROUP BY sample")
def sample_stats(spark, sf_dir):
    return decode.sample_stats(_outcomes(spark, sf_dir)[1])


@_query(f"{_OUTCOME} SELECT sample, lib_id, 3 AS cycles, count(*) AS n FROM oc JOIN done USING (read_id) WHERE outcome = 'decoded' GROUP BY ALL")
def cycle_distribution(spark, sf_dir):
    return decode.cycle_distribution(_outcomes(spark, sf_dir)[0], CYCLES)


@_query(f"{_OUTCOME} SELECT sample, count(*) FILTER (outcome = 'order_violation') AS order_violation, count(*) FILTER (outcome = 'decoded' AND NOT cp_len BETWEEN 16 AND 17) AS cp_len_odd FROM oc LEFT JOIN done USING (read_id) GROUP BY sample")
def qc_checks(spark, sf_dir):
    done, every = _outcomes(spark, sf_dir)
    return decode.quality_checks(done, every, 9, 16, 17)


@_query(f"{_OUTCOME}, c AS (SELECT lib_id, '3_' || bb1 || '_' || bb2 || '_' || bb3 || '_NA' AS id, sample, count(*) AS n FROM oc JOIN done USING (read_id) WHERE outcome = 'decoded' GROUP BY ALL), d AS (SELECT sample, count(*) AS denominator FROM oc WHERE outcome <> 'len_out_of_range' GROUP BY 1) SELECT lib_id, id, c.sample, n, round(n * 1e6 / denominator, 6) AS cpm FROM c JOIN d USING (sample)")
def cpm_sample_length_passed(spark, sf_dir):
    done, every = _outcomes(spark, sf_dir)
    found = counts.cells(done.withColumn("id", ids.chain_id(F.lit(CYCLES), *[F.col(f"bb{k}") for k in (1, 2, 3)], F.lit("NA"))))
    return counts.cpm(found, every.filter("outcome != 'len_out_of_range'").groupBy("sample").agg(F.count(F.lit(1)).alias("denominator")), ["sample"])


_CLAIMS = "tg AS (SELECT p_partkey, 'L' || (p_partkey % 40) AS lib_id, translate(substr(md5((p_partkey % 60)::VARCHAR), 1, 10), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq FROM part), va AS (SELECT lib_id, seq AS kmer FROM tg UNION SELECT lib_id, substr(seq, 1, i - 1) || b || substr(seq, i + 1) FROM tg, generate_series(1, 10) g(i), (VALUES ('A'), ('C'), ('G'), ('T')) v(b) UNION SELECT lib_id, substr(seq, 1, i - 1) || substr(seq, i + 1) FROM tg, generate_series(1, 10) g(i) UNION SELECT lib_id, substr(seq, 1, i) || b || substr(seq, i + 1) FROM tg, generate_series(1, 9) g(i), (VALUES ('A'), ('C'), ('G'), ('T')) v(b) WHERE NOT (i = 1 AND b = substr(seq, 1, 1)) AND NOT (i = 9 AND b = substr(seq, 10, 1)))"


@_query(f"WITH {_CLAIMS} SELECT kmer, count(DISTINCT lib_id) AS libs, string_agg(DISTINCT lib_id, ',' ORDER BY lib_id) AS claimed_by FROM va GROUP BY kmer HAVING count(DISTINCT lib_id) > 1")
def cp_variant_collisions(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet")
    seq = F.translate(F.substring(F.md5((F.col("p_partkey") % 60).cast("string").cast("binary")), 1, 10), "0123456789abcdef", "ACGTACGTACGTACGT")
    rows = p.select(F.lit("CP").alias("type"), F.concat(F.lit("L"), (F.col("p_partkey") % 40).cast("string")).alias("lib_id"), F.lit(0).alias("cycle"), F.col("p_name").alias("bb_id"), seq.alias("seq"))
    return decode.variant_collisions(decode.patterns(rows))


@_query("WITH l AS (SELECT source AS sample, length(text) AS n FROM documents) SELECT sample, count(*) FILTER (abs(n - 830) <= 500 AND NOT abs(n - 1500) <= 500) AS within_3, count(*) FILTER (abs(n - 1500) <= 500 AND NOT abs(n - 830) <= 500) AS within_4, count(*) FILTER (abs(n - 830) <= 500 AND abs(n - 1500) <= 500) AS within_both, count(*) FILTER (abs(n - 830) > 500 AND abs(n - 1500) > 500) AS outside FROM l GROUP BY 1")
def length_windows(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    d = d.select(F.col("source").alias("sample"), counts.length_class(F.char_length("text"), 830, 1500, 500).alias("c"))
    return d.groupBy("sample").agg(*[F.count(F.when(F.col("c") == k, 1)).alias(k) for k in ("within_3", "within_4", "within_both", "outside")])


@_query()
def top_k_peaks(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    h = d.groupBy(F.col("source").alias("sample"), F.floor(F.char_length("text") / 100).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    return counts.peaks(h, 5, 2, 0.01)


# Comparison of runs ---------------------------------------------------------------------------------------------------

_RUN = "runs AS (SELECT run, lib_id, bb1 || '|' || bb2 || '|' || bb3 || '|NA' AS key, count(*)::DOUBLE AS score FROM cube GROUP BY ALL), best AS (SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY run, key ORDER BY score DESC, lib_id) AS r FROM runs) WHERE r = 1), rk AS (SELECT run, key, score, row_number() OVER (PARTITION BY run ORDER BY score DESC, key) AS rank, count(*) OVER (PARTITION BY run) AS n, avg(score) OVER (PARTITION BY run) AS mu, stddev_pop(score) OVER (PARTITION BY run) AS sd FROM best), rp AS (SELECT run, key, score, rank, 100.0 * (1 - (rank - 1)::DOUBLE / greatest(n - 1, 1)) AS rank_pct, (score - mu) / CASE WHEN sd > 0 THEN sd ELSE 1 END AS score_z FROM rk)"


def _runs(spark, sf_dir):
    c = cube(spark, sf_dir).withColumn("key", ids.compound_key(*map(F.col, BBS)))
    return c.groupBy("run", "lib_id", "key").agg(F.count(F.lit(1)).cast("double").alias("score"))


def _run_map(spark, sf_dir, run):
    return compare.rank_map(compare.best_per_key(_runs(spark, sf_dir).filter(F.col("run") == run), "key", "score", "lib_id"), "key", "score")


@_query(f"WITH {CUBE_SQL}, {_RUN} SELECT key, score, rank, round(rank_pct, 6) AS rank_pct, round(score_z, 6) AS score_z FROM rp WHERE run = 'A'")
def run_rank_maps(spark, sf_dir):
    return rounded(_run_map(spark, sf_dir, "A"), "rank_pct", "score_z")


_PATTERN = f"WITH {CUBE_SQL}, {_RUN}, t AS (SELECT * FROM rp WHERE rank <= 300), pt AS (SELECT key, string_agg(run, '+' ORDER BY run) AS pattern, count(*)::INTEGER AS n_runs FROM t GROUP BY key)"


def _patterns(spark, sf_dir):
    tops = {r: _run_map(spark, sf_dir, r).filter("rank <= 300") for r in ("A", "I")}
    return compare.patterns(tops, "key", "score")


@_query(f"{_PATTERN} SELECT key, pattern, n_runs FROM pt")
def union_patterns(spark, sf_dir):
    return _patterns(spark, sf_dir).select("key", "pattern", "n_runs")


@_query(f"{_PATTERN} SELECT key FROM pt WHERE n_runs >= 2")
def overlap(spark, sf_dir):
    return _patterns(spark, sf_dir).filter("n_runs >= 2").select("key")


@_query(f"{_PATTERN} SELECT pattern, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM pt GROUP BY pattern")
def pattern_counts(spark, sf_dir):
    return rounded(compare.pattern_counts(_patterns(spark, sf_dir)), "pct")


_TIER = f"WITH {CUBE_SQL}, {_RUN}, tj AS (SELECT coalesce(a.key, i.key) AS key, coalesce(a.rank_pct, 0) AS ap, coalesce(i.rank_pct, 0) AS ip FROM (SELECT * FROM rp WHERE run = 'A') a FULL JOIN (SELECT * FROM rp WHERE run = 'I') i ON a.key = i.key), tt AS (SELECT *, CASE WHEN ap >= 90 AND ip <= 50 THEN 'active' WHEN ip >= 90 AND ap <= 50 THEN 'inactive' WHEN ap >= 90 AND ip >= 90 THEN 'both' ELSE 'Other' END AS tier FROM tj), tk AS (SELECT *, round(CASE tier WHEN 'active' THEN ap - ip WHEN 'inactive' THEN ip - ap WHEN 'both' THEN least(ap, ip) END, 6) AS specificity FROM tt)"


def _tiers(spark, sf_dir):
    t = compare.tiers(_run_map(spark, sf_dir, "A"), _run_map(spark, sf_dir, "I"), "key", 90.0, 50.0, 80.0)
    return rounded(t, "specificity")


@_query(f"{_TIER} SELECT key, tier, specificity FROM tk")
def tier_groups(spark, sf_dir):
    return _tiers(spark, sf_dir).select("key", "tier", "specificity")


@_query(f"{_TIER}, p AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY specificity DESC NULLS LAST, key) AS pick FROM tk) SELECT key, tier, pick::INTEGER AS pick FROM p WHERE pick <= 10")
def final_picks(spark, sf_dir):
    return compare.picks(_tiers(spark, sf_dir), "tier", 10, F.lit(False), F.desc_nulls_last("specificity"), F.asc("key")).select("key", "tier", "pick")


@_query(f"WITH {MATRIX_SQL}, b AS (SELECT quantile_cont(neg_r1, 0.9) AS b1, quantile_cont(neg_r2, 0.9) AS b2 FROM m) SELECT lib_id, id FROM m, b WHERE neg_r1 < b1 AND neg_r2 < b2")
def neg_percentile_filter(spark, sf_dir):
    return compare.below_controls(matrix(spark, sf_dir), ["neg_r1", "neg_r2"], 90).select("lib_id", "id")


@_query(f"WITH {MATRIX_SQL} SELECT lib_id, id, round(list_aggregate([{', '.join(R1)}], 'median'), 6) AS med, round(list_avg([{', '.join(R1)}]), 6) AS avg, greatest({', '.join(R1)}) AS most FROM m")
def enrichment_rank(spark, sf_dir):
    return rounded(matrix(spark, sf_dir).select("lib_id", "id", compare.enrichment(R1).alias("med"), compare.enrichment(R1, "mean").alias("avg"), compare.enrichment(R1, "max").alias("most")), "med", "avg")


@_query(f"WITH {CUBE_SQL}, {_RUN} SELECT a.key, a.score AS current, i.score AS previous, a.score - i.score AS diff, CASE WHEN a.rank <= 100 AND i.rank <= 100 THEN 'both' WHEN a.rank <= 100 THEN 'only_current' ELSE 'only_previous' END AS status FROM (SELECT * FROM rp WHERE run = 'A') a JOIN (SELECT * FROM rp WHERE run = 'I') i ON a.key = i.key WHERE a.rank <= 100 OR i.rank <= 100")
def topk_shift(spark, sf_dir):
    return compare.shift(_run_map(spark, sf_dir, "A"), _run_map(spark, sf_dir, "I"), "key", "score", 100)


@_query(f"WITH {CUBE_SQL}, {_RUN} SELECT coalesce(a.key, i.key) AS key, coalesce(a.lib_id, i.lib_id) AS lib_id, a.score AS score_a, i.score AS score_b FROM (SELECT * FROM best WHERE run = 'A') a FULL JOIN (SELECT * FROM best WHERE run = 'I') i ON a.key = i.key")
def full_run_outer_merge(spark, sf_dir):
    r = _runs(spark, sf_dir)
    return compare.merged_runs(r.filter("run = 'A'"), r.filter("run = 'I'"), "key", ["lib_id"], "score")


@_query(f"WITH {MATRIX_SQL}, t AS (SELECT * FROM m ORDER BY r2c1 + r2c2 DESC, lib_id, id LIMIT 500), l AS (SELECT lib_id, unnest([{{'p': 'bb1', 'b': bb1}}, {{'p': 'bb2', 'b': bb2}}, {{'p': 'bb3', 'b': bb3}}]) AS x FROM t), c AS (SELECT x.p AS position, x.b AS block, count(*) AS n, string_agg(DISTINCT lib_id, ',' ORDER BY lib_id) AS libs FROM l GROUP BY ALL) SELECT position, block, n, libs FROM (SELECT *, row_number() OVER (PARTITION BY position ORDER BY n DESC, block) AS r FROM c) WHERE r <= 5")
def bb_frequency_top(spark, sf_dir):
    t = compare.top(matrix(spark, sf_dir).withColumn("s", F.col("r2c1") + F.col("r2c2")), 500, "s", "lib_id", "id")
    return compare.block_frequency(t, ["bb1", "bb2", "bb3"], 5).select("position", "block", "n", "libs")


@_query(f"{_TO_HIT}, {_RS0}, {_CALL}, qb AS (SELECT greatest(0, quantile_cont(neg_r1, 0.9)) AS b1, greatest(0, quantile_cont(neg_r2, 0.9)) AS b2 FROM m), f AS (SELECT hc.*, concat_ws(';', CASE WHEN del2 < 10 THEN 'LOW_DEL2' END, CASE WHEN neg_r1 >= b1 AND b1 > 0 THEN 'NEG_R1_HIGH' END, CASE WHEN neg_r2 >= b2 AND b2 > 0 THEN 'NEG_R2_HIGH' END, CASE WHEN lfc_r2 < lfc_r1 - 1 THEN 'R2_DROP' END, CASE WHEN neg_hard_fail THEN 'NEG_HARD_FAIL' END) AS fl FROM hc, qb) SELECT lib_id, id, CASE WHEN fl = '' THEN 'OK' ELSE fl END AS flags, CASE WHEN glm_hit AND rs_fail = '' AND fl = '' THEN 'A' WHEN glm_hit OR rs_fail = '' THEN 'B' ELSE 'Other' END AS tier FROM f")
def qc_flags_tiers(spark, sf_dir):
    return compare.quality_tiers(compare.quality_flags(_called(spark, sf_dir), "del2", ["neg_r1", "neg_r2"])).select("lib_id", "id", "flags", "tier")


@_query(f"WITH {CUBE_SQL}, a AS (SELECT id, count(*) AS n FROM cube GROUP BY 1), b AS (SELECT id, count(*) AS k FROM cube WHERE run = 'A' GROUP BY 1) SELECT id, n, coalesce(k, 0) AS k FROM a LEFT JOIN b USING (id) WHERE n <> coalesce(k, 0)")
def count_crosscheck(spark, sf_dir):
    c = cube(spark, sf_dir)
    a, b = c.groupBy("id").agg(F.count(F.lit(1)).alias("n")), c.filter("run = 'A'").groupBy("id").agg(F.count(F.lit(1)).alias("k"))
    return a.join(b, "id", "full").na.fill(0, ["n", "k"]).filter("n <> k")


# Similarity -----------------------------------------------------------------------------------------------------------


def _prints(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey").repartition(spark.sparkContext.defaultParallelism, "p_partkey")  # one file would be one task
    smiles = F.translate(F.substring(F.md5((F.col("p_partkey") % 211).cast("string").cast("binary")), 1, 20), "0123456789abcdef", "CCNOccn1(=)2SFPB")
    tail = F.element_at(F.array(*[F.lit(x) for x in ("", "CO", "N1", "C=O")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    return p.select(F.col("p_partkey").alias("key"), similarity.fingerprint(F.concat(smiles, tail)).alias("bits"))


@_query("WITH s AS (SELECT p_partkey AS key, translate(substr(md5((p_partkey % 211)::VARCHAR), 1, 20), '0123456789abcdef', 'CCNOccn1(=)2SFPB') || ['', 'CO', 'N1', 'C=O'][(p_partkey % 4 + 1)::INT] AS t FROM part), f AS (SELECT key, list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS g FROM s), p AS (SELECT a.key AS i, b.key AS j, len(list_intersect(a.g, b.g))::DOUBLE AS n, len(a.g) + len(b.g) AS m FROM f a JOIN f b ON a.key < b.key) SELECT i, j, round(n / (m - n), 6) AS sim FROM p WHERE n / (m - n) >= 0.8")
def tanimoto_pairs(spark, sf_dir):
    return similarity.pairs(_prints(spark, sf_dir), "key", 80, digits=6)


def _clustered(spark, sf_dir):
    """Classes of equal structures, their near pairs and clusters, and each part's class."""
    sets, members = similarity.classes(_prints(spark, sf_dir), "key")
    near = staged(similarity.class_pairs(sets, "key", 80))
    return sets, near, similarity.butina(sets, "key", near, "copies"), members


@_query()
def butina_clusters(spark, sf_dir):
    _, _, clusters, members = _clustered(spark, sf_dir)
    return similarity.spread(clusters, members, "key").drop("class")


@_query()
def cluster_reps(spark, sf_dir):
    scores = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("score"))
    _, _, clusters, members = _clustered(spark, sf_dir)
    return similarity.representatives(similarity.spread(clusters, members, "key").drop("class"), scores, "key", F.desc("score"), F.asc("key"))


@_query()
def cluster_medoids(spark, sf_dir):
    sets, near, clusters, members = _clustered(spark, sf_dir)
    best = similarity.medoids(clusters, near, "key", copies=sets)
    return similarity.spread(best, members, "key").select("cluster_id", "key", "cluster_size", (F.col("medoid") & (F.col("key") == F.col("class"))).alias("medoid"))


# More of hit calling and comparison ----------------------------------------------------------------------------------

_FANO = ", ".join(f"median(CASE WHEN {{m{g}}} > 0 THEN {{v{g}}} / {{m{g}}} END) AS f{g}" for g in (1, 2)).format(m1=_m(R1, "n_"), v1=_v(["n_" + s for s in R1]), m2=_m(R2, "n_"), v2=_v(["n_" + s for s in R2]))


@_query(f"{_TO_GLM}, f AS (SELECT {_FANO} FROM g) SELECT round(least(greatest(CASE WHEN f1 <= 1 THEN 0.1 WHEN f1 >= 3 THEN 0.9 ELSE 0.1 + (f1 - 1) * 0.4 END, 0.0), 0.95), 6) AS w_r1, round(least(greatest(CASE WHEN f2 <= 1 THEN 0.3 WHEN f2 >= 3 THEN 0.95 ELSE 0.3 + (f2 - 1) * 0.325 END, 0.1), 0.98), 6) AS w_r2, 0.0::DOUBLE AS w_neg, true AS fix_neg_poisson FROM f")
def pre_tuned_weights(spark, sf_dir):
    return rounded(hits.shrinkage(hits.fano(_base_frame(spark, sf_dir), GROUPS)), "w_r1", "w_r2")


@_query(f"WITH {MATRIX_SQL}, a AS (SELECT lib_id, id, {_m(R1)} AS v FROM m) SELECT lib_id, id, round((v - avg(v) OVER ()) / nullif(stddev_pop(v) OVER (), 0), 6) AS z FROM a")
def avg_r1_zscore(spark, sf_dir):
    m = staged(matrix(spark, sf_dir).select("lib_id", "id", stats.mean([F.col(s) for s in R1]).alias("v")))
    return rounded(hits.standardised(m, "v", "z"), "z").drop("v")


@_query(f"WITH {MATRIX_SQL}, x AS (SELECT lib_id, id, bb1, bb2, {' + '.join(R2)} AS v FROM m), f AS (SELECT *, row_number() OVER (PARTITION BY bb1, bb2 ORDER BY v DESC, lib_id, id) AS r FROM x) SELECT lib_id, id, v FROM f WHERE r = 1 ORDER BY v DESC, lib_id, id LIMIT 50")
def diversity_pick(spark, sf_dir):
    m = matrix(spark, sf_dir).select("lib_id", "id", "bb1", "bb2", stats.total([F.col(s) for s in R2]).alias("v"))
    return compare.diverse(m, ["bb1", "bb2"], 50, F.desc("v"), F.asc("lib_id"), F.asc("id")).select("lib_id", "id", "v")


@_query(f"{_PATTERN}, ba AS (SELECT key, score, 'A' AS run, row_number() OVER (ORDER BY score DESC, key) AS r FROM rp WHERE run = 'A'), bi AS (SELECT key, score, 'I' AS run, row_number() OVER (ORDER BY score DESC, key) AS r FROM rp WHERE run = 'I') SELECT key, score, run FROM ba WHERE r <= 200 UNION ALL SELECT key, score, run FROM bi WHERE r <= 200 AND key NOT IN (SELECT key FROM ba WHERE r <= 200)")
def candidate_pool(spark, sf_dir):
    runs = {r: compare.best_per_key(_runs(spark, sf_dir).filter(F.col("run") == r), "key", "score", "lib_id").select("key", "score") for r in ("A", "I")}
    return compare.pooled(runs, "key", 200, "score")


@_query(f"{_PATTERN} SELECT key, pattern, coalesce(ta.score, ra.score) AS filled_A, coalesce(ti.score, ri.score) AS filled_I FROM pt LEFT JOIN t ta ON ta.key = pt.key AND ta.run = 'A' LEFT JOIN t ti ON ti.key = pt.key AND ti.run = 'I' LEFT JOIN rp ra ON ra.key = pt.key AND ra.run = 'A' LEFT JOIN rp ri ON ri.key = pt.key AND ri.run = 'I'".replace("SELECT key, pattern", "SELECT pt.key, pattern"))
def filled_scores(spark, sf_dir):
    whole = {r: _run_map(spark, sf_dir, r) for r in ("A", "I")}
    return compare.filled(_patterns(spark, sf_dir), whole, "key").select("key", "pattern", "filled_A", "filled_I")


_BLOCKS = f"WITH {CUBE_SQL}, k AS (SELECT run, sample, bb1 || '|' || bb2 || '|' || bb3 || '|NA' AS key FROM cube), b AS (SELECT key, run, " + ", ".join(f"count(*) FILTER (sample = '{s}')::DOUBLE AS {s}" for s in SAMPLES) + " FROM k GROUP BY ALL)"


def _blocks(spark, sf_dir):
    c = cube(spark, sf_dir).withColumn("key", ids.compound_key(*map(F.col, BBS)))
    one = lambda s: F.count(F.when(F.col("sample") == s, 1)).cast("double").alias(s)
    return {f"{r.lower()}_": c.filter(F.col("run") == r).groupBy("key").agg(*map(one, SAMPLES)) for r in ("A", "I")}, c.select("key").distinct()


@_query(f"{_BLOCKS} SELECT u.key, " + ", ".join(f"a.{s} AS a_{s}, i.{s} AS i_{s}, coalesce(a.{s}, i.{s}) AS {s}" for s in ("r1c1", "del2")) + " FROM (SELECT DISTINCT key FROM b) u LEFT JOIN (SELECT * FROM b WHERE run = 'A') a ON a.key = u.key LEFT JOIN (SELECT * FROM b WHERE run = 'I') i ON i.key = u.key")
def sample_blocks(spark, sf_dir):
    blocks_, keys = _blocks(spark, sf_dir)
    return compare.with_sample_blocks(keys, blocks_, "key", ["r1c1", "del2"])


@_query(f"{_TO_HIT}, {_RS0}, {_CALL}, qb AS (SELECT greatest(0, quantile_cont(neg_r1, 0.9)) AS b1, greatest(0, quantile_cont(neg_r2, 0.9)) AS b2 FROM m), f AS (SELECT unnest(string_split(CASE WHEN fl = '' THEN 'OK' ELSE fl END, ';')) AS flag FROM (SELECT concat_ws(';', CASE WHEN del2 < 10 THEN 'LOW_DEL2' END, CASE WHEN neg_r1 >= b1 AND b1 > 0 THEN 'NEG_R1_HIGH' END, CASE WHEN neg_r2 >= b2 AND b2 > 0 THEN 'NEG_R2_HIGH' END, CASE WHEN lfc_r2 < lfc_r1 - 1 THEN 'R2_DROP' END, CASE WHEN neg_hard_fail THEN 'NEG_HARD_FAIL' END) AS fl FROM hc, qb)) SELECT flag, count(*) AS n FROM f GROUP BY 1")
def flag_totals(spark, sf_dir):
    return compare.flag_totals(compare.quality_flags(_called(spark, sf_dir), "del2", ["neg_r1", "neg_r2"]))


@_query(f"WITH {CUBE_SQL}, b AS (SELECT DISTINCT bb1 FROM cube UNION SELECT 'NA') SELECT bb1, row_number() OVER (ORDER BY CASE WHEN bb1 = 'NA' THEN 1 ELSE 0 END, upper(regexp_extract(bb1, '^([A-Za-z]*)', 1)), try_cast(regexp_extract(bb1, '^[A-Za-z]*([0-9]*)', 1) AS BIGINT) NULLS LAST, bb1) AS place FROM b")
def natural_block_order(spark, sf_dir):
    from pyspark.sql import Window

    b = cube(spark, sf_dir).select("bb1").union(spark.createDataFrame([("NA",)], "bb1 string")).distinct()
    return b.select("bb1", F.row_number().over(Window.orderBy(*compare.natural_order(F.col("bb1")))).cast("long").alias("place"))  # a design's blocks


from . import queries_compare, queries_decode, queries_hits  # noqa: E402,F401  they register their queries
