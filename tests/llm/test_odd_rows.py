"""Each operator on nulls, empty and long texts, ties, repeated rows, clashing extra columns and empty tables."""

import hashlib
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from screenlake.llm import fingerprints, packing, pii, piece_matching, secrets, token_counts, topk, toxicity, warc

LONG = "alpha beta gamma " * 20000
ROWS = [(1, None), (2, ""), (3, "One two three"), (3, "One two three"), (None, "no id here"), (5, LONG), (6, "mail a.b@example.org or +44 20 7946 0958"), (7, "password = hunter22x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 0, -1.0) for r in ROWS], "doc_id long, text string, block string, place int, score double").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter(F.lit(False))


def ids(rows):
    return sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in rows)


ALL = sorted(-1 if i is None else i for i, _ in ROWS)


def test_fingerprints(docs, none):
    got = fingerprints.edited_pairs(docs).collect()
    assert ids(got) == ALL
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert by[1] == by[2] and len(by[3]) == 1  # a null is an empty text; repeated rows agree
    assert {r["n_chars"] for r in got if r["doc_id"] == 5} == {len(LONG)}
    assert fingerprints.edited_pairs(none).collect() == []


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 5, 6, 7)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.scored(docs, model).collect()
    assert ids(got) == ALL and all(0 <= r["score"] <= 1 for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] == 3} == {zlib.crc32(b"3") % 5 == 0}
    assert toxicity.scored(none, toxicity.train(none, labels)).collect() == []
    assert all(r["predicted"] == 0 for r in toxicity.scored(docs, toxicity.train(docs, labels.filter("toxic = 0"))).collect())


def test_counts_and_pieces(docs, none):
    model = public_tokenizers.path("piece_bpe_32k.model")
    got = token_counts.with_counts(docs, model, 4096).collect()
    assert ids(got) == ALL
    by = {r["doc_id"]: r for r in got}
    assert (by[1]["n_bytes"], by[1]["n_tokens"]) == (by[2]["n_bytes"], by[2]["n_tokens"]) == (0, 0)
    assert by[5]["n_bytes"] == len(LONG) and by[5]["over_limit"]
    assert token_counts.with_counts(none, model, 4096).collect() == []
    trip = piece_matching.round_trip(docs, model).collect()
    assert ids(trip) == ALL
    assert {r["doc_id"]: r["n_pieces"] for r in trip} == {r["doc_id"]: r["n_tokens"] for r in got}
    assert piece_matching.round_trip(none, model).collect() == []


@pytest.mark.parametrize("operator, apply", [(pii, pii.found), (secrets, secrets.scanned)])
def test_spans(docs, none, operator, apply):
    got = apply(docs, operator.train(docs)).collect()
    assert ids(got) == ALL
    nothing = hashlib.sha256(b"").hexdigest()
    assert {r["base_sha256"] for r in got if r["doc_id"] in (1, 2, 3, 5)} == {nothing}
    assert any(r["spans"] for r in got if r["doc_id"] == (6 if operator is pii else 7))
    assert apply(none, operator.train(none)).collect() == []


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.sequences(docs, path, 1).collect()
    used, size = {}, {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        size[r["doc_id"]] = size.get(r["doc_id"], 0) + r["length"]
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert size[1] == size[2] == 1  # the end id alone
    assert size[3] == 2 * next(r["doc_tokens"] for r in got if r["doc_id"] == 3)
    assert packing.sequences(none, path, 1).collect() == []


def test_archives(spark, tmp_path):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>x</p>"), (5, "u", "<p>x</p>"), (4, "u", "<p>x</p>"), (6, "u", "y" * 3_000_000)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, payload string")
    got = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archived(pages, str(tmp_path / "a")).collect()}
    assert got == {
        1: (0, "response", None), 2: (0, "revisit", 1), 3: (8, "response", None), 4: (8, "revisit", 3), 5: (8, "revisit", 3), 6: (3_000_000, "response", None),
    }
    whole = {r["page_id"]: bytes(r["payload"] or b"") for r in spark.read.format("warc").load(str(tmp_path / "a")).filter("record_type = 'response'").collect()}
    assert whole == {1: b"", 3: b"<p>x</p>", 6: b"y" * 3_000_000}
    assert warc.archived(pages.filter(F.lit(False)), str(tmp_path / "b")).collect() == []


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.5, -0.5]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (100, [-1.0, -1.0])]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, pivot int")
    got = sorted(tuple(r) for r in topk.search(vectors, vectors.filter("vec_id % 100 = 0"), k=3).select("query_id", "rank", "vec_id", "score").collect())
    half, one = 512, 1024
    assert got == [(0, 1, 1, half * one), (0, 2, 2, half * one), (0, 3, 3, half * one), (100, 1, 3, 0), (100, 2, 0, -one * one), (100, 3, 1, -one * one)]
    assert topk.search(vectors.filter(F.lit(False)), vectors, k=3).collect() == []


@pytest.mark.parametrize("size", [1, 2**20, 2**26, 2**28, 2**34])
def test_top_k_of_large_components(spark, size):
    """Whole numbers are compared as such, also where floats can't tell them apart: ties go to smaller ids, and no better row is ruled out."""
    import random

    r = random.Random(size)
    rows = [(k, [float(size * r.randrange(-8, 9) + r.randrange(0, 3)) for _ in range(3)]) for k in range(100, 160)]
    rows += [(k, [float(size)] * 3) for k in range(300, 324)] + [(200, [float(size), 0.0, float(size)])]
    r.shuffle(rows)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in topk.search(vectors, vectors.filter("vec_id in (100, 200, 300)"), k=10, scale=1).collect()}
    by = dict(rows)
    cut = lambda v: max(-(1 << 63), min((1 << 63) - 1, v))
    for q in (100, 200, 300):
        want = sorted((-cut(sum(int(a) * int(b) for a, b in zip(by[q], v))), k) for k, v in rows if k != q)[:10]
        assert [got[q, n + 1] for n in range(10)] == [(k, -s) for s, k in want], (q, size)


@pytest.mark.parametrize("size, wider", [(1, 1), (16, 1), (17, 300), (4096, 1 << 22), (1 << 32, 1)])
def test_top_k_sends_packs_from_task_to_task(spark, size, wider):
    """Every pack of queries may need every block, so none of it goes through the driver, however few rows the planner sees; components of each width, of queries other than of rows, stay what they are."""
    import random

    r = random.Random(size)
    component = lambda: float(r.choice([-8 * size, -8 * size + 1, 8 * size - 1, r.randrange(-8 * size, 8 * size)]))
    rows = [(k, [component() for _ in range(3)]) for k in range(200)]
    asked = [(k, [wider * x for x in rows[k][1]]) for k in range(0, 200, 40)]
    vectors, queries = (spark.createDataFrame(x, "vec_id long, embedding array<double>").repartition(3) for x in (rows, asked))
    found = topk.search(vectors, queries, k=4, scale=1)
    got = {(x["query_id"], x["rank"]): (x["vec_id"], x["score"]) for x in found.collect()}
    cut = lambda v: max(-(1 << 63), min((1 << 63) - 1, v))
    for q, v in asked:
        want = sorted((-cut(sum(int(a) * int(b) for a, b in zip(v, w))), k) for k, w in rows if k != q)[:4]
        assert [got[q, n + 1] for n in range(4)] == [(k, -s) for s, k in want], (q, size)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_archives_keep_odd_pages(spark, tmp_path):
    """Addresses with line breaks, repeated ids and rows without an id all come back."""
    rows = [(1, "http://a/\r\nWARC-Type: x\r\n\r\n", "one"), (2, "b\tc", "two"), (2, "b", "two"), (None, "n", "two"), (3, "u\u2028v", "two")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in warc.archived(pages, str(tmp_path / "odd")).collect())
    assert got == [(0, "response", None), (1, "response", None), (2, "response", None), (2, "response", None), (3, "revisit", 2)]
    uris = {r["page_id"]: r["target_uri"] for r in spark.read.format("warc").load(str(tmp_path / "odd")).collect()}
    assert uris[1] == "http://a/%0D%0AWARC-Type: x%0D%0A%0D%0A" and uris[3] == "u%E2%80%A8v"


def test_fingerprints_of_sparse_ids(spark):
    """The next document over the whole range of 64 bits, and over a cluster with a far neighbour."""
    for ids_ in ([-(1 << 63), -5, 0, 7, 1 << 40, (1 << 63) - 1], [*range(100, 160), 1 << 50]):
        rows = [(i, f"text {i} " * 3) for i in ids_]
        got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.edited_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        down = sorted(rows, reverse=True)
        for k, (i, t) in enumerate(down):
            half = len(t) // 2
            assert got[i] == hashlib.sha256((t[: len(t) - half] + down[(k + 1) % len(down)][1][:half]).encode()).hexdigest(), i


def test_blocks_of_documents(spark):
    """One outlying id, and half the ids missing, leave blocks of even sizes, in order of the ids."""
    for without in (0, 20_000):
        rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).union(spark.createDataFrame([(1 << 50, "far")], "doc_id long, text string"))
        rows = rows.union(spark.range(without).select(F.lit(None).cast("long"), F.concat(F.lit("t"), F.col("id").cast("string"))))
        blocks = fingerprints._with_blocks(rows)
        sizes = [r["count"] for r in blocks.groupBy("block").count().collect()]
        assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2] and max(sizes) < 2 * fingerprints.BLOCK
        got = blocks.filter("doc_id is not null").orderBy("doc_id").collect()
        assert all(a["block"] <= b["block"] for a, b in zip(got, got[1:]))


def test_fingerprints_without_ids(spark):
    """Every document without an id has one of them, or at the end the first, as its next."""
    rows = [(None, f"text {k} " * 5) for k in range(1500)] + [(7, "the only one with an id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.edited_pairs(df).collect()
    assert len(got) == len(rows) and all(0 <= r["near_next"] <= 1 for r in got)
    def edit(t, following):
        half = len(t) // 2
        return hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()

    texts = [t for _, t in rows]
    made = {edit(t, o): (t, o) for t in texts for o in texts[:3] + texts[-1:]}
    firsts = [made[r["edited_sha256"]] for r in got if r["edited_sha256"] in made]
    assert any(o == rows[-1][1] for _, o in firsts)  # the last of them is followed by the first document of all


STAGE_ROWS = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (None, "no id here"), (5, "alpha beta gamma delta " * 4000), (6, "token = abcdef123456"), (8, "one two three four five six")]


@pytest.mark.parametrize("k, kept", [(0, None), (1, [-1, 1, 2, 3, 5, 6]), (2, [-1, 1, 2, 3, 3, 5, 6, 8]), (3, None)])
def test_stages(spark, k, kept):
    """Every stage of the pipeline on odd rows, with columns whose names operators use themselves, and on no rows."""
    import corpus_pipeline

    extra = "tox_score double, rep int, node long, keys string"
    docs = spark.createDataFrame([(*r, "en", "s", 0, -1.0, 1, 2, "x") for r in STAGE_ROWS], f"doc_id long, text string, lang string, source string, n_chars long, {extra}").repartition(2)
    stage = corpus_pipeline.STAGES[k][1]
    got = stage(spark, docs, "/root/testdata/sf0.001")
    if k < 3:
        assert got.columns == docs.columns
        rows = got.collect()
        assert all(r["tox_score"] == -1.0 for r in rows)
        assert ids(rows) == (kept or [-1, 1, 2, 3, 3, 5, 6, 8])
    else:
        sizes = {}
        for r in got.collect():
            sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["length"]
        assert sizes[1] == sizes[2] == 1 and set(sizes) == {1, 2, 3, None, 5, 6, 8}
    assert stage(spark, docs.filter(F.lit(False)), "/root/testdata/sf0.001").collect() == []
