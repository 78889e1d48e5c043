"""Queries of similarity by blocks, picks in two stages, lookups, and comparison of three runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import compare, lookup, similarity
from .plans.staging import staged
from .plans.testbed import CUBE_SQL, MATRIX_SQL, R2, cube
from .queries import _query, _TIER, _tiers, matrix

# Compounds of the cube, their blocks as SMILES: blocks of one number modulo 5 differ in their ends only, and one block is missing.
_SMILES = "CASE WHEN {b} = 'B7' THEN NULL ELSE translate(substr(md5(CAST(CAST(substr({b}, 2) AS INT) % 5 AS STRING)), 1, 24), '0123456789abcdef', 'CCNOccn1(=)2SFPB') || CASE CAST(substr({b}, 2) AS INT) % 3 WHEN 0 THEN '' WHEN 1 THEN 'CO' ELSE 'N1=C' END END"
_COMPOUNDS = "SELECT id AS key, " + ", ".join(f"{_SMILES.format(b=b)} AS s{k}" for k, b in enumerate(("bb1", "bb2", "bb3"), 1)) + " FROM (SELECT DISTINCT id, bb1, bb2, bb3 FROM {cube}) d"
_GRAMS = f"c AS ({_COMPOUNDS.format(cube='cube')}), g AS (SELECT key, {', '.join(f'CASE WHEN s{k} IS NOT NULL THEN list_distinct(list_transform(range(1, length(s{k}) - 1), lambda i: substr(s{k}, i, 3))) END AS g{k}' for k in (1, 2, 3))} FROM c)"


def _compounds(spark, sf_dir):
    return staged(spark.sql(_COMPOUNDS, cube=cube(spark, sf_dir)))


_ALIKE = [f"CASE WHEN a.g{k} IS NOT NULL AND b.g{k} IS NOT NULL THEN len(list_intersect(a.g{k}, b.g{k}))::DOUBLE / (len(a.g{k}) + len(b.g{k}) - len(list_intersect(a.g{k}, b.g{k}))) END" for k in (1, 2, 3)]


@_query(f"WITH {CUBE_SQL}, {_GRAMS}, p AS (SELECT a.key AS i, b.key AS j, list_avg([{', '.join(_ALIKE)}]) AS sim FROM g a JOIN g b ON a.key < b.key) SELECT i, j, round(sim, 6) AS sim FROM p WHERE round(100 * sim, 9) >= 90")
def block_average_pairs(spark, sf_dir):
    out = similarity.average_pairs(_compounds(spark, sf_dir), "key", ["s1", "s2", "s3"], 90)
    return out.withColumn("sim", F.round("sim", 6))


@_query(f"WITH {CUBE_SQL}, {_GRAMS}, u AS (SELECT key, list_distinct(list_concat(coalesce(g1, []), coalesce(g2, []), coalesce(g3, []))) AS g FROM g), p AS (SELECT a.key AS i, b.key AS j, len(list_intersect(a.g, b.g)) AS n, len(a.g) + len(b.g) AS m FROM u a JOIN u b ON a.key < b.key) SELECT i, j, round(n::DOUBLE / (m - n), 6) AS sim FROM p WHERE 100 * n >= 90 * (m - n) AND m > n")
def block_union_pairs(spark, sf_dir):
    c = _compounds(spark, sf_dir)
    prints = staged(c.select("key", similarity.union(*[similarity.fingerprint(F.col(f"s{k}")) for k in (1, 2, 3)]).alias("bits")))
    return similarity.pairs(prints, "key", 90, digits=6)


_FIRST_BLOCK = "split_part(key, '|', 1)"


@_query(f"{_TIER}, d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tier, {_FIRST_BLOCK} ORDER BY specificity DESC NULLS LAST, key) AS r FROM tk) WHERE r = 1), n AS (SELECT * FROM (VALUES ('active', 8), ('inactive', 30), ('both', 5)) v(tier, n)), o AS (SELECT key, tier, row_number() OVER (PARTITION BY tier ORDER BY specificity DESC NULLS LAST, key) AS pick FROM d), f AS (SELECT key, tier, pick, 1 AS stage FROM o JOIN n USING (tier) WHERE pick <= n), t AS (SELECT tier, count(*) AS taken FROM f GROUP BY 1), s AS (SELECT key, tier, row_number() OVER (PARTITION BY tier ORDER BY specificity DESC NULLS LAST, key) AS pick FROM tk WHERE key NOT IN (SELECT key FROM f)), e AS (SELECT key, tier, pick + coalesce(taken, 0) AS pick, 2 AS stage FROM s JOIN n USING (tier) LEFT JOIN t USING (tier) WHERE pick + coalesce(taken, 0) <= n) SELECT key, tier, pick::INTEGER AS pick, stage FROM f UNION ALL SELECT key, tier, pick::INTEGER, stage FROM e")
def final_picks_filled(spark, sf_dir):
    """The best of each first block, then whatever is left, to a number for each tier."""
    t = staged(_tiers(spark, sf_dir))
    order = (F.desc_nulls_last("specificity"), F.asc("key"))
    first = compare.group_ranks(t.withColumn("_g", F.concat_ws("|", "tier", F.substring_index("key", "|", 1))), "_g", *order).filter("group_rank = 1")
    return compare.picks_filled(t, first, "key", "tier", {"active": 8, "inactive": 30, "both": 5}, *order).select("key", "tier", "pick", "stage")


@_query()
def final_picks_of_clusters(spark, sf_dir):
    """Twelve parts of each group: first those that represent a cluster of similar structures, then the dearest of the rest."""
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("score"), (F.col("p_size") % 4).alias("group"))
    smiles = F.translate(F.substring(F.md5((F.col("key") % 29).cast("string").cast("binary")), 1, 24), "0123456789abcdef", "CCNOccn1(=)2SFPB")
    prints = p.select("key").repartition(spark.sparkContext.defaultParallelism, "key").select("key", similarity.fingerprint(F.concat(smiles, F.when(F.col("key") % 2 == 0, "CO").otherwise(""))).alias("bits"))
    sets, members = similarity.classes(prints, "key")
    clusters = similarity.butina(sets, "key", staged(similarity.class_pairs(sets, "key", 80)), "copies")
    clusters = similarity.spread(clusters, members, "key").drop("class")
    reps = similarity.representatives(clusters, p, "key", F.desc("score"), F.asc("key")).filter("rep")
    return compare.picks_filled(p, reps, "key", "group", 12, F.desc("score"), F.asc("key"))


# Ids of part rows as block ids: some with a number behind them, some without SMILES or library.
_BLOCK_ROWS = "SELECT p_partkey AS line, 'B' || CAST(p_partkey % 23 AS STRING) || CASE WHEN p_partkey % 5 = 0 THEN '.' || CAST(p_partkey % 3 AS STRING) ELSE '' END AS bb_id, CASE WHEN p_partkey % 23 IN (3, 7, 19) OR p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'NA' END ELSE 'L' || CAST(p_partkey % 6 AS STRING) END AS lib FROM {part} WHERE NOT (p_partkey % 23 IN (1, 4, 12) AND p_partkey % 5 <> 0)"
_GAPPED = "SELECT DISTINCT id, CASE WHEN bb1 IN ('B2', 'B5') THEN lib_id WHEN bb1 = 'B6' THEN 'NA' END AS lib, CASE WHEN bb1 = 'B9' THEN 'NA' ELSE bb1 END AS bb1, bb2, bb3 FROM {cube} WHERE lib_id = 'A'"


@_query(
    f"WITH {CUBE_SQL}, p AS ({_BLOCK_ROWS.format(part='part')}), r AS ({_GAPPED.format(cube='cube')}), k AS (SELECT line, bb_id, true AS exact, lib FROM p UNION ALL SELECT line, split_part(bb_id, '.', 1), false, lib FROM p WHERE contains(bb_id, '.')), "
    "e AS (SELECT bb_id, arg_min(lib, line) AS v FROM k WHERE exact AND lib NOT IN ('', 'NA') GROUP BY 1), b AS (SELECT bb_id, arg_min(lib, line) AS v FROM k WHERE NOT exact AND lib NOT IN ('', 'NA') GROUP BY 1) "
    "SELECT r.id, coalesce(CASE WHEN r.lib <> 'NA' THEN r.lib END, " + ", ".join(f"CASE WHEN r.bb{k} <> 'NA' THEN coalesce(e{k}.v, b{k}.v) END" for k in (1, 2, 3)) + ", 'NA') AS lib FROM r "
    + " ".join(f"LEFT JOIN e e{k} ON e{k}.bb_id = r.bb{k} LEFT JOIN b b{k} ON b{k}.bb_id = r.bb{k}" for k in (1, 2, 3))
)
def filled_libraries(spark, sf_dir):
    """Libraries of molecules from the first of their blocks that is known, by its own id or a numbered one's."""
    blocks = spark.sql(_BLOCK_ROWS, part=spark.read.parquet(f"{sf_dir}/part.parquet"))
    rows = staged(spark.sql(_GAPPED, cube=cube(spark, sf_dir)))
    return lookup.filled(rows, ["id"], ["bb1", "bb2", "bb3"], lookup.dictionary(blocks, ["lib"]), "lib", "lib").select("id", "lib")


_SUFFIXED = "SELECT 'S' || CAST(p_partkey % 3 AS STRING) AS sample, CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN ' ' ELSE 'L1' END AS lib_id, CASE p_partkey % 5 WHEN 0 THEN '3_a_LIBL1_b_c' WHEN 1 THEN '3_a_libX_b_c' WHEN 2 THEN NULL ELSE '3_a_LIB' END AS id, CASE WHEN p_partkey % 7 < 2 THEN 'a_LIBL1' ELSE 'a' END AS bb1, CASE WHEN p_partkey % 7 = 2 THEN 'b_LIBL2' ELSE NULL END AS bb2 FROM {part}"


@_query(
    f"WITH x AS ({_SUFFIXED.format(part='part')}), y AS (SELECT sample, coalesce(regexp_matches(id, '(?i)_LIB[\\w.-]'), false) AS i, coalesce(regexp_matches(bb1, '(?i)_LIB[\\w.-]'), false) OR coalesce(regexp_matches(bb2, '(?i)_LIB[\\w.-]'), false) AS b, coalesce(trim(lib_id), '') <> '' AS l FROM x) "
    "SELECT sample, count(*) AS total_reads, count(*) FILTER (i) AS id_has_lib, count(*) FILTER (NOT i) AS id_missing_lib, count(*) FILTER (b) AS bb_has_lib, count(*) FILTER (NOT b) AS bb_missing_lib, count(*) FILTER (NOT i AND b) AS id_missing_bb_has_lib, count(*) FILTER (NOT i AND NOT b) AS id_missing_bb_missing_lib, "
    "count(*) FILTER (i AND NOT b) AS id_has_lib_bb_missing_lib, count(*) FILTER (l) AS lib_id_present, count(*) FILTER (NOT i AND l) AS id_missing_lib_with_lib_id, round(100.0 * count(*) FILTER (NOT i) / count(*), 6) AS id_missing_lib_pct FROM y GROUP BY 1"
)
def lib_suffix_audit(spark, sf_dir):
    return lookup.suffix_counts(spark.sql(_SUFFIXED, part=spark.read.parquet(f"{sf_dir}/part.parquet")), ["bb1", "bb2"])


_THREE = "SELECT CASE CAST(substr(bb3, 2) AS INT) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS run, bb1 || '|' || bb2 AS key, CAST(count(*) AS DOUBLE) AS score FROM {cube} GROUP BY 1, 2"


@_query(f"WITH {CUBE_SQL}, r AS ({_THREE.format(cube='cube')}), t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY score DESC, key) AS n FROM r) WHERE n <= 60) SELECT key, string_agg(run, '+' ORDER BY run) AS pattern, count(*)::INTEGER AS n_runs, max(score) AS best_score FROM t GROUP BY 1")
def three_run_patterns(spark, sf_dir):
    """Cells of a diagram of three runs, with the best score of any."""
    r = staged(spark.sql(_THREE, cube=cube(spark, sf_dir)))
    tops = {x: compare.top(r.filter(F.col("run") == x), 60, "score", "key") for x in ("A", "B", "C")}
    out = compare.patterns(tops, "key", "score")
    return out.select("key", "pattern", "n_runs", F.greatest(*[f"score_{x}" for x in tops]).alias("best_score"))


@_query(f"WITH {MATRIX_SQL}, t AS (SELECT * FROM m ORDER BY {' + '.join(R2)} DESC, lib_id, id LIMIT 400), l AS (SELECT lib_id, unnest([{{'p': 'bb1', 'b': bb1}}, {{'p': 'bb2', 'b': bb2}}]) AS x FROM t), b AS (SELECT x.p AS position, x.b AS block, lib_id, count(*) AS n FROM l GROUP BY ALL), c AS (SELECT position, block, sum(n)::BIGINT AS n, string_agg(lib_id || ':' || n, ',' ORDER BY lib_id || ':' || n) AS lib_counts FROM b GROUP BY ALL), d AS (SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY position), 6) AS pct, row_number() OVER (PARTITION BY position ORDER BY n DESC, block) AS r FROM c) SELECT position, block, n, pct, lib_counts FROM d WHERE r <= 4")
def bb_frequency_by_library(spark, sf_dir):
    t = compare.top(matrix(spark, sf_dir).withColumn("s", sum((F.col(c) for c in R2), F.lit(0.0))), 400, "s", "lib_id", "id")
    return compare.block_frequency(t, ["bb1", "bb2"], 4).select("position", "block", "n", F.round("pct", 6).alias("pct"), "lib_counts")
