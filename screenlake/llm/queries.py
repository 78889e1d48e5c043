"""The operators' queries over the whole tables, and their SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import delta_lloyd, divergence, fingerprints, jaccard_join, multi_index, packing, pii, piece_matching, secrets, token_counts, topk, toxicity, warc
from .common import documents, scratch_path, table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10, scale=1024)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_counts(documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"), budget=4096)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.found(docs, pii.train(docs))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_components(documents(spark, sf_dir), n=3, percent=90)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.sequences(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), end_id=1, capacity=2048)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets.scanned(docs, secrets.train(docs))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_matching.round_trip(documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))


def op11_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=10, top=10)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_lloyd.clustered(table(spark, sf_dir, "embeddings"), clusters=8, rounds=10, dim=64, scale=1024, salt="3")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_topk, op2_fingerprints, op3_toxicity, op4_token_counts, op5_warc, op6_pii, op7_jaccard_join, op8_packing, op9_secrets, op10_pieces]
    own += [op11_near_duplicates, op12_divergence, op13_centroids]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": """
            WITH v AS (
              SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
              WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ), s AS (
              SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
            ), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
            SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
        "op5_warc": """
            WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
            d AS (SELECT page_id, t, min(page_id) OVER (PARTITION BY t) AS first, sha1(t) AS h FROM p),
            b AS (SELECT page_id, t, first, array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')), '') AS bits FROM d)
            SELECT page_id, strlen(t)::BIGINT AS payload_bytes,
              array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                (1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
                 + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT)::INT, 1)), '') AS payload_digest,
              CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
              CASE WHEN first < page_id THEN first END AS refers_to
            FROM b""",
        "op7_jaccard_join": JACCARD_SQL,
        "op11_near_duplicates": COSINE_SQL,
        "op12_divergence": DIVERGENCE_SQL,
        "op13_centroids": _lloyd_sql(),
    }


JACCARD_SQL = r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
      FROM documents
    ), s AS (
      SELECT doc_id, CASE WHEN len(ws) >= 3 THEN list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w
    ), n AS (SELECT doc_id, len(sh)::BIGINT AS n FROM s),
    e AS (SELECT doc_id, unnest(sh) AS x FROM s),
    c AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n_both FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT u, v FROM c JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * n_both >= 90 * (a.n + b.n - n_both)),
    g AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
    r AS (SELECT doc_id, doc_id AS t FROM n UNION SELECT r.doc_id, g.v FROM r JOIN g ON g.u = r.t)
    SELECT n.doc_id, any_value(n.n) AS n_shingles, min(r.t) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id"""

COSINE_SQL = """
    WITH RECURSIVE v AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x,
        label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS sound
      FROM embeddings
    ), s AS (SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS size FROM v WHERE sound),
    l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM s a JOIN s b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_dot_product(a.x, b.x) / (a.size * b.size) >= 0.93),
    r AS (SELECT vec_id, vec_id AS t FROM v UNION SELECT r.vec_id, l.v FROM r JOIN l ON l.u = r.t),
    n AS (SELECT u, count(*) AS n FROM l GROUP BY u)
    SELECT vec_id, any_value(coalesce(n.n, 0))::BIGINT AS n_links, min(t) AS component_id, vec_id = min(t) AS kept FROM r LEFT JOIN n ON n.u = vec_id GROUP BY vec_id"""

DIVERGENCE_SQL = r"""
    WITH d AS (
      SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
      FROM documents
    ), e AS (SELECT lang, source, unnest(ts) AS term FROM d),
    df AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 10),
    c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM e SEMI JOIN df USING (lang, term) GROUP BY ALL),
    g AS (SELECT DISTINCT lang, source FROM d),
    gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
    lv AS (SELECT lang, count(*)::HUGEINT AS v FROM df GROUP BY lang),
    lt AS (SELECT lang, sum(n)::HUGEINT AS total FROM c GROUP BY lang),
    ln AS (SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY lang, term),
    p AS (SELECT lang, source, df.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (gn.n + 2 * v) AS p FROM gn JOIN df USING (lang) JOIN lv USING (lang) LEFT JOIN c USING (lang, source, term)),
    q AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (total + 2 * v) AS q FROM ln JOIN lt USING (lang) JOIN lv USING (lang)),
    f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    term AS (SELECT p.lang, p.source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p > q)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)) WHERE part = 'pair' OR rank <= 10"""


def _lloyd_sql(clusters: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """Each round's centroids as one more subquery."""
    sql = f"""
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings
      WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INTEGER AS c, x FROM v ORDER BY sha256('3:' || vec_id) LIMIT {clusters}),"""
    near = "SELECT v.vec_id, v.x, c, list_sum(list_transform(list_zip(v.x, k.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance FROM v, c{r} k QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY distance, c) = 1"
    for r in range(rounds):
        sql += f"""
    a{r} AS MATERIALIZED ({near.format(r=r)}),
    s{r} AS (SELECT c, k, floor_div FROM (SELECT c, k, (sum(x[k]) - ((sum(x[k]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div FROM a{r}, (SELECT unnest(range(1, {dim + 1})) AS k) GROUP BY c, k)),
    c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN (SELECT c, list(floor_div::BIGINT ORDER BY k) AS x FROM s{r} GROUP BY c) m USING (c)),"""
    return sql + f"""
    z AS MATERIALIZED ({near.format(r=rounds)})
    SELECT vec_id, c AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(k.x, ',')) AS centroid_sha256
    FROM z JOIN c{rounds} k USING (c)"""
