"""Sinks of reads, samples by hash, tables put together, report shapes, similarity by blocks and picks, against plain Python."""

import hashlib
import json
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from screenlake import queries as screening
from screenlake.operators import compare, samples, similarity, validate
from screenlake.sources import files

SF = "/root/testdata/sf0.001"


def test_sinks(spark, tmp_path):
    """A round trip, a bounded dump, and a sample's folder read alone."""
    done = spark.createDataFrame([(f"S{k % 3}", k, "ACGT" * k) for k in range(1, 40)], "sample string, read_id long, read_seq string")
    lost = spark.createDataFrame([(f"S{k % 3}", k, "no_cp") for k in range(100, 160)], "sample string, read_id long, reason string").repartition(5)
    for most in (None, 4):
        files.write_reads(done, lost, str(tmp_path / "out"), most)
        back = files.read_reads(spark, str(tmp_path / "out"), files.DECODED, done.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, done.collect()))
        kept = defaultdict(list)
        for r in files.read_reads(spark, str(tmp_path / "out"), files.UNDECODED, lost.schema).collect():
            kept[r["sample"]].append(r["read_id"])
        assert {s: sorted(v) for s, v in kept.items()} == {f"S{s}": [k for k in range(100, 160) if k % 3 == s][: most or 60] for s in range(3)}
    plan = back.filter("sample = 'S1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sample" in plan


def test_bottom_k(spark):
    """The same rows under any partitioning: those of the smallest hashes; a small group comes whole; repeated rows and nulls are rows."""
    rows = [("a", k) for k in range(3000)] + [("b", k) for k in range(7)] + [(None, 5)] * 3 + [("c", None)] * 300
    df = spark.createDataFrame(rows, "g string, k long")
    want = defaultdict(list)
    for g, k in rows:
        want[g].append((hashlib.md5(f"9:{'' if k is None else k}".encode()).hexdigest(), -1 if k is None else k))
    want = {g: sorted(v)[:20] for g, v in want.items()}
    for parts in (1, 7):
        got = defaultdict(list)
        for r in samples.bottom_k(df.repartition(parts), ("g",), 20, 9, "k").collect():
            got[r["g"]].append(-1 if r["k"] is None else r["k"])
        assert {g: sorted(v) for g, v in got.items()} == {g: sorted(k for _, k in v) for g, v in want.items()}
    assert samples.bottom_k(df.limit(0), ("g",), 20, 9, "k").collect() == []
    reads = df.filter("g is not null").select(F.col("g").alias("sample"), F.col("k").alias("read_no"))
    assert sorted(r["read_no"] for r in files.subsample(reads.filter("sample = 'a'"), 4, 0, "head").collect()) == [0, 1, 2, 3]


def test_bottom_k_where_the_bound_fails(spark, monkeypatch):
    """With a bound that lets too few rows through, all of the group's rows are looked at."""
    df = spark.createDataFrame([("a", k) for k in range(500)], "g string, k long")
    want = sorted(range(500), key=lambda k: hashlib.md5(f"1:{k}".encode()).hexdigest())[:30]
    monkeypatch.setattr(samples.math, "sqrt", lambda x: -9.0)
    assert sorted(r["k"] for r in samples.bottom_k(df, ("g",), 30, 1, "k").collect()) == sorted(want)


def test_assembled(spark):
    a = spark.createDataFrame([("x", 1, 2), ("y", 3, 4)], "sample string, p int, q int")
    b = spark.createDataFrame([("x", 2, 9), ("z", 4, 0)], "sample string, q int, r int")
    got = {r["sample"]: tuple(r)[1:] for r in validate.assembled({"a": a, "b": b.withColumn("q", F.when(F.col("sample") == "x", 7).otherwise(F.col("q")))}).collect()}
    assert got == {"x": (1, 7, 9, "", "q"), "y": (3, 4, 0, "b", ""), "z": (0, 4, 0, "a", "")}


def test_report_shapes(spark, tmp_path):
    shapes = {
        "list": {"insert_size": {"peak": 3, "width": 2.5, "histogram": [0, 4, "x", 5, None]}}, "pairs": {"insertSize": {"mode": 7, "hist": [[2, 1], [5, 6], [2, 3], ["a", 1], [9]]}},
        "object": {"insert-size": {"distribution": {"10": 2, "12": 9, "note": "none"}}}, "lists": {"insert_size": {"peak_insert_size": 4, "histogram": {"x": [1, 2, 3], "y": [5, "no", 7, 8]}}},
        "tie": {"insert_size": {"histogram": {"30": 4, "20": 4}}}, "empty": {"insert_size": {}}, "other": {"summary": 1},
    }
    for name, value in shapes.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=1))
    (tmp_path / "broken.json").write_text("{")
    got = {r["sample"]: (r["peak"], r["width"], {e["length"]: e["n"] for e in r["histogram"]}) for r in files.insert_reports(spark, str(tmp_path)).collect()}
    assert got == {
        "list": (3, 2.5, {0: 0, 1: 4, 3: 5}), "pairs": (7, None, {2: 4, 5: 6}), "object": (12, None, {10: 2, 12: 9}), "lists": (4, None, {1: 5, 3: 7}), "tie": (20, None, {20: 4, 30: 4}),
        "empty": (None, None, {}), "other": (None, None, {}), "broken": (None, None, {}),
    }


@pytest.mark.parametrize("percent", [80, 55, 30])
def test_average_pairs(spark, percent):
    """Compounds that have blocks at different places, also where bounds say nothing."""
    rng = random.Random(percent)
    stems = ["CCOc1ccccc1", "CCOc1ccccc1N", "CCOc1ccncc1", "NCC(=O)O", "NCC(=O)OC", "S1CCSC1"]
    rows = [(k, *[rng.choice([*stems, None]) if n < 3 else rng.choice([None, "NCC(=O)O", "CC"]) for n in range(4)]) for k in range(70)]
    grams = lambda s: {s[i : i + 3] for i in range(len(s) - 2)} if s and len(s) >= 3 else None
    want = {}
    for a in rows:
        for b in rows:
            sims = [len(x & y) / len(x | y) for x, y in zip(map(grams, a[1:]), map(grams, b[1:])) if x and y]
            if a[0] < b[0] and sims and round(100 * sum(sims) / len(sims), 9) >= percent:
                want[a[0], b[0]] = sum(sims) / len(sims)
    df = spark.createDataFrame(rows, "key int, a string, b string, c string, d string")
    got = {(r["i"], r["j"]): r["sim"] for r in similarity.average_pairs(df, "key", ["a", "b", "c", "d"], percent).collect()}
    assert got == pytest.approx(want) and len(want) > 20


def test_picks_of_clusters(spark):
    """Representatives first, then the dearest that are left."""
    parts = spark.read.parquet(f"{SF}/part.parquet").collect()
    smiles = {p["p_partkey"]: hashlib.md5(str(p["p_partkey"] % 29).encode()).hexdigest()[:24].translate(str.maketrans("0123456789abcdef", "CCNOccn1(=)2SFPB")) + "CO" * (p["p_partkey"] % 2 == 0) for p in parts}
    grams = {k: {s[i : i + 3] for i in range(len(s) - 2)} for k, s in smiles.items()}
    near = {k: {j for j in grams if j != k and 100 * len(grams[k] & grams[j]) >= 80 * len(grams[k] | grams[j])} for k in grams}
    free, clusters = set(grams), []
    for k in sorted(grams, key=lambda k: (-len(near[k]), k)):
        if k in free:
            clusters.append({k, *(near[k] & free)})
            free -= clusters[-1]
    price = {p["p_partkey"]: p["p_retailprice"] for p in parts}
    reps = {min(c, key=lambda k: (-price[k], k)) for c in clusters}
    groups = defaultdict(list)
    for p in parts:
        groups[p["p_size"] % 4].append((-p["p_retailprice"], p["p_partkey"]))
    got = defaultdict(list)
    for r in screening.queries()["final_picks_of_clusters"](spark, SF).orderBy("pick").collect():
        got[r["group"]].append((r["key"], r["stage"]))
    for g, rows in groups.items():
        first = [(k, 1) for _, k in sorted(rows) if k in reps][:12]
        rest = [(k, 2) for _, k in sorted(rows) if (k, 1) not in first][: 12 - len(first)]
        assert got[g] == first + rest
    assert {s for v in got.values() for _, s in v} == {1, 2}


def test_picks_by_number(spark):
    df = spark.createDataFrame([(k, "ab"[k % 2], k % 5) for k in range(40)], "key int, g string, s int")
    got = compare.picks_filled(df, df.filter("key < 6"), "key", "g", {"a": 5}, F.desc("s"), F.asc("key")).orderBy("pick").collect()
    assert [(r["key"], r["stage"]) for r in got] == [(4, 1), (2, 1), (0, 1), (14, 2), (24, 2)]


def test_medoid_ties(spark):
    """Equal distances: the greatest of the columns in turn, nulls last, then the smallest key."""
    clusters = spark.createDataFrame([(k, 1, 3) for k in (1, 2, 3)] + [(k, 4, 2) for k in (4, 5)], "key int, cluster_id int, cluster_size int")
    near = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.9), (2, 3, 0.9), (4, 5, 0.8)], "i int, j int, sim double")
    ties = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 2.0), (3, None, 9.0), (4, None, None)], "key int, score double, rank double")
    assert {r["key"] for r in similarity.medoids(clusters, near, "key", ties, "score", "rank").filter("medoid").collect()} == {2, 4}
    assert {r["key"] for r in similarity.medoids(clusters, near, "key").filter("medoid").collect()} == {1, 4}


def test_fit_of_nothing(spark):
    from screenlake.functions import stats

    assert math.isclose(stats.absolute_deviation(spark.createDataFrame([(1.0,), (2.0,), (9.0,)], "v double"), ["v"]).first()[0], 1.0)


def test_passing(spark):
    """Gates that exist all hold, a null doesn't, and the score is a finite number."""
    from screenlake.operators import lookup

    rows = [(1, True, 1.0), (2, False, 1.0), (3, None, 1.0), (4, True, None), (5, True, float("nan")), (6, True, float("inf"))]
    df = spark.createDataFrame(rows, "id int, glm_hit boolean, s double")
    assert [r["id"] for r in lookup.passing(df, "s").collect()] == [1]
    assert {r["id"] for r in lookup.passing(df.drop("glm_hit"), "s").collect()} == {1, 2, 3}


def test_collisions_and_numbers(spark):
    from screenlake.operators import blocks

    df = spark.createDataFrame([("A", "1"), ("A", "1"), ("A", "2"), ("C", "3")], "seq string, lib_id string")
    assert [tuple(r) for r in blocks.collisions(df).collect()] == [("A", 2)]
    got = files.with_numbers(spark.createDataFrame([("1.5", "x"), ("NA", "2")], "a string, b string"), ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [(1.5, None), (None, 2.0)]


def test_negative_controls():
    from screenlake.operators import hits

    assert hits.negative_controls("neg1", "neg2") == ("neg2", {"neg1": 0.5, "neg2": 0.5})
    assert hits.negative_controls("neg1", None) == ("neg1", {"neg1": 1.0})
    assert hits.negative_controls(None, "neg2") == ("neg2", {"neg2": 1.0})
    assert hits.negative_controls(None, None) == (None, {})


def test_copies(spark):
    """Equal structures are compared once, and clusters, medoids and pairs are those of all keys; more copies than a block, and texts without bits."""
    texts = {k: ("CCOCNCC1", "CCOCNCC1C", "", "SNSNFBPB", None)[0 if k < 40 else k % 5] for k in range(60)}
    df = spark.createDataFrame(list(texts.items()), "key int, text string")
    prints = df.select("key", similarity.fingerprint(F.col("text")).alias("bits"))
    grams = {k: {t[i : i + 3] for i in range(len(t or "") - 2)} for k, t in texts.items()}
    want = {(i, j): len(grams[i] & grams[j]) / len(grams[i] | grams[j]) for i in grams for j in grams if i < j and grams[i] and 100 * len(grams[i] & grams[j]) >= 80 * len(grams[i] | grams[j])}
    for block in (1024, 7):
        similarity.BLOCK, kept = block, similarity.BLOCK
        got = [tuple(r) for r in similarity.pairs(prints, "key", 80).collect()]
        similarity.BLOCK = kept
        assert len(got) == len(want) and {(i, j): s for i, j, s in got} == want
    sets, members = similarity.classes(prints, "key")
    assert sets.count() == len({frozenset(g) for g in grams.values() if g}) + sum(not g for g in grams.values())
    near = similarity.class_pairs(sets, "key", 80)
    clusters = similarity.butina(sets, "key", near, "copies")
    long = spark.createDataFrame([(i, j, s) for (i, j), s in want.items()], "i int, j int, sim double")
    plain = similarity.butina(df.select("key"), "key", long)
    assert sorted(map(tuple, similarity.spread(clusters, members, "key").drop("class").collect())) == sorted(map(tuple, plain.collect()))
    best = {r["key"] for r in similarity.medoids(clusters, near, "key", copies=sets).filter("medoid").collect()}
    assert best == {r["key"] for r in similarity.medoids(plain, long, "key").filter("medoid").collect()}


def test_reads_are_dealt_by_their_number(spark, monkeypatch):
    """Tasks of matching follow the number of reads, however small their files are, and nothing is shuffled between matching and collecting."""
    from screenlake.operators import decode
    from screenlake.plans.staging import staged

    monkeypatch.setattr(decode, "READS_A_TASK", 10)
    reads = spark.range(95).select(F.col("id").alias("read_id"), F.lit("ACGTACGTAC").alias("seq")).coalesce(1)
    table = spark.createDataFrame([("HP", "", 0, "H", "ACGTA", 5, 0, None), ("HP", "", 0, "H", "ACGTAC", 6, 1, None)], "type string, lib_id string, cycle int, bb_id string, kmer string, len int, miss int, cycles int")
    got = decode.collected(reads, staged(table), {"HP": [5, 6]})
    places = {(r["read_id"], h["dir"], h["pos"], h["len"]) for r in got.collect() for h in r["found"]}
    assert places == {(k, d, p, n) for k in range(95) for d, s in ((0, "ACGTACGTAC"), (1, "GTACGTACGT")) for n in (5, 6) for p in range(11 - n) if s[p : p + n] == "ACGTAC"[:n]}
    assert got.rdd.getNumPartitions() == 10


def test_equal_reads_are_decoded_once(spark, monkeypatch):
    """Matching sees each text once, and every read has its own row: copies in several samples, one that the length filter keeps out, nulls, and reads that nothing matches."""
    from screenlake import queries_decode
    from screenlake.operators import decode
    from screenlake.plans.staging import staged

    seen, collected = [], decode.collected
    monkeypatch.setattr(decode, "collected", lambda reads, *rest: seen.append(reads.count()) or collected(reads, *rest))
    made = [r["seq"] for r in queries_decode.reads(spark, SF).filter("read_id in (0, 1, 2, 3, 4)").orderBy("read_id").collect()]
    texts = [*made, "ACGT" * 20, None]
    reads = spark.createDataFrame([(k, f"S{k % 2}", texts[k % 7]) for k in range(70)], "read_id long, sample string, seq string")
    table = staged(decode.patterns(queries_decode.tags(spark)))
    passes = (F.col("seq").isNull() | (F.length("seq") > 0)) & (F.col("read_id") != 7)
    done, every = decode.outcomes(reads, table, queries_decode.CYCLES, queries_decode.SIZES, passes)
    outcome = {r["read_id"]: (r["sample"], r["outcome"], r["cp_found"]) for r in every.collect()}
    assert seen == [6] and len(outcome) == every.count() == 70
    assert outcome[7] == ("S1", "len_out_of_range", 0) and {outcome[k][1] for k in range(5, 70, 7)} == {outcome[k][1] for k in range(6, 70, 7)} == {"no_cp"}
    assert {outcome[k][1] for k in range(70) if k % 7 < 5 and k != 7} == {"decoded"}
    rows = {r["read_id"]: r.asDict() for r in done.collect()}
    assert sorted(rows) == [k for k in range(70) if k % 7 < 5 and k != 7]
    for k, r in rows.items():
        assert r["sample"] == f"S{k % 2}" and r | {"read_id": 0, "sample": ""} == rows[14 + k % 7] | {"read_id": 0, "sample": ""}
    assert decode.attempts(reads, table, queries_decode.CYCLES, queries_decode.SIZES).filter("penalty is not null").count() == 50
    assert seen == [6, 6]


def test_ids_are_parsed_once(spark, monkeypatch):
    """Read-back takes each id apart once, and rows of equal ids, of none, and without a read have their own mismatches."""
    from screenlake.functions import ids

    ask, parsed = F.udf(lambda i: counted.add(1) or i, "string"), ids.parsed
    counted = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(ids, "parsed", lambda c: parsed(ask(c)))
    places = {f"{a}_{f}": (0, 4, "ACGT")[n] for a in ("hp", "op", "cp", "c1") for n, f in enumerate(("pos", "len", "seq"))}
    rows = [places | {"read_id": k, "lib_id": "X", "cycles": 1, "id": (None, "1_A_LIBX_NA_NA_NA", "1_B_LIBY_NA_NA_NA")[k % 3], "direction": "forward", "c1_bb_id": "A_LIBX"} for k in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c.endswith(('_pos', '_len')) or c == 'cycles' else 'long' if c == 'read_id' else 'string'}" for c in rows[0]))
    reads = spark.range(29).select(F.col("id").alias("read_id"), F.when(F.col("id") == 1, "ACCT").otherwise("ACGT").alias("seq"))
    got = {r["read_id"]: r["mismatches"] for r in validate.read_back(df, reads, 1).select("read_id", "mismatches").collect()}
    usual = (["cycles_mismatch", "bb_id_mismatch", "lib_suffix_missing"], [], ["bb_id_mismatch", "lib_id_mismatch"])
    want = {k: usual[k % 3] for k in range(30)} | {1: [f"seq_mismatch_{a}" for a in ("HP", "OP", "CP", "C1")], 29: ["read_missing", *usual[2]]}
    assert got == want and counted.value < len(rows)


@pytest.mark.parametrize("name", ["gap_stats", "undecoded_reasons", "decoding_summary"])
def test_reads_are_made_once(spark, monkeypatch, name):
    """What is read several times, for the different texts and for the reads that have them, is written first."""
    counted, made = spark.sparkContext.accumulator(0), screening.reads(spark, SF)
    ask = F.udf(lambda s: counted.add(1) or s, "string")
    monkeypatch.setattr(screening, "reads", lambda *_: made.withColumn("seq", ask("seq")))
    assert screening.queries()[name](spark, SF).count() > 0 and counted.value == made.count()


def test_events_are_dealt_by_their_number(spark, monkeypatch):
    """Tasks that make reads follow the number of events, and no event is lost."""
    from screenlake import queries_decode

    n = spark.read.parquet(f"{SF}/events.parquet").count()
    for module in (screening, queries_decode):
        assert module.reads(spark, SF).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(screening, "EVENTS_A_TASK", 10, raising=False)
    for module in (screening, queries_decode):
        got = module.reads(spark, SF)
        assert got.rdd.getNumPartitions() == -(-n // 10) and got.select("read_id").distinct().count() == n


def test_rules_are_evaluated_once_and_compiled(spark):
    """Rules of one row as before, with codons passed over, and none of them below a lambda, where all would be interpreted, nor twice in the plan."""
    from screenlake import queries_decode
    from screenlake.operators import decode
    from screenlake.plans.staging import staged

    row = queries_decode._records(spark, SF).filter("lib_id = 'M4' and read_id % 23 = 0").orderBy("read_id").limit(1)
    change = lambda name, **new: row.withColumns({k: F.expr(v) for k, v in new.items()}).withColumn("sample", F.lit(name))
    rows = [
        change("sound"), change("no c2", c2_pos="cast(null as int)"), change("no codons", **{f"c{k}_seq": "cast(null as string)" for k in range(1, 5)}), change("c1 out", c1_pos="-1"), change("turned", c3_pos="c2_pos", c2_pos="c3_pos"),
        change("no cycles", cycles="cast(null as int)"), change("no cp", cp_len="cast(null as int)"), change("no read", read_seq="cast(null as string)"), change("long", c4_len="30"),
    ]
    bad = staged(rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3]).unionByName(rows[4]).unionByName(rows[5]).unionByName(rows[6]).unionByName(rows[7]).unionByName(rows[8]))
    checked = validate.validated(bad, staged(decode.patterns(queries_decode.tags(spark))), 4)
    got = {r["sample"]: r["errors"] for r in checked.collect()}
    assert got["sound"] == [] and got["no read"] == []
    assert got["no c2"] == ["missing_c2", "gap_C1_C2"] and got["c1 out"] == ["c1_pos_oob", "gap_OP_C1"]
    assert got["no codons"] == [f"missing_c{k}" for k in range(1, 5)] and got["no cycles"] == ["cycles_parse"] and got["no cp"] == ["missing_cp"]
    assert got["turned"] == ["c2_seq_mismatch", "c3_seq_mismatch", "gap_C1_C2", "order_violation", "gap_C2_C3", "gap_C3_C4"]
    assert got["long"] == ["c4_seq_mismatch", "gap_C_last_CP", "codon_len_not9"]
    plan = checked.select("errors")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_seq_mismatch") == 7 and plan.count("transform(") == plan.count("filter(") == 0
