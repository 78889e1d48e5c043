"""Queries without SQL against plain Python, and the readers and writers of files."""

import gzip
import json
import os
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from screenlake import queries as screening
from screenlake.functions import ids
from screenlake.operators import compare, counts, hits, similarity
from screenlake.plans import config
from screenlake.sources import files

SF = os.environ.get("SCREENLAKE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def near(spark):
    rows = screening.queries()["tanimoto_pairs"](spark, SF).collect()
    out = {}
    for r in rows:
        out.setdefault(r["i"], {})[r["j"]] = r["sim"]
        out.setdefault(r["j"], {})[r["i"]] = r["sim"]
    return out


def clusters_of(near, keys):
    """The key with most free neighbours takes them, again and again; neighbours are counted over the whole table."""
    free, out = set(keys), {}
    for k in sorted(keys, key=lambda k: (-len(near.get(k, {})), k)):
        if k in free:
            for m in [k, *near.get(k, {})]:
                if m in free:
                    out[m] = k
                    free.discard(m)
    return out


def test_butina(spark, near):
    keys = [r["p_partkey"] for r in spark.read.parquet(f"{SF}/part.parquet").collect()]
    want = clusters_of(near, keys)
    size = pd.Series(want).value_counts()
    got = screening.queries()["butina_clusters"](spark, SF).collect()
    assert {r["key"]: (r["cluster_id"], r["cluster_size"]) for r in got} == {k: (c, size[c]) for k, c in want.items()}
    price = {r["p_partkey"]: r["p_retailprice"] for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    reps = {r["key"] for r in screening.queries()["cluster_reps"](spark, SF).collect() if r["rep"]}
    medoids = {r["key"] for r in screening.queries()["cluster_medoids"](spark, SF).collect() if r["medoid"]}
    members = {}
    for k, c in want.items():
        members.setdefault(c, []).append(k)
    assert reps == {min(m, key=lambda k: (-price[k], k)) for m in members.values()}
    assert medoids == {min(m, key=lambda k: (round(sum(1 - near.get(k, {}).get(o, 0) for o in m if o != k), 6), k)) for m in members.values()}


def test_members_meet_as_blocks(spark):
    """Pairs of copies are as many as asked for, but what is shuffled for them is a row for each block of a class: not one for each member, and no more rounding than there are pairs of classes."""
    sets = {0: [1, 2, 3, 4, 5], 1: [1, 2, 3, 4, 5, 6], 2: [1, 2, 3, 4, 5, 6, 7], 3: [50, 51]}
    rows = [(k, sets[k % 4]) for k in range(1200)] + [(5000, []), (5001, None)]
    prints = spark.createDataFrame(rows, "key long, bits array<long>").repartition(3)
    found = similarity.pairs(prints, "key", 80, digits=6)
    got = {(r["i"], r["j"]): r["sim"] for r in found.collect()}
    alike = {(a, b): round(len({*x} & {*y}) / len({*x} | {*y}), 6) for a, x in sets.items() for b, y in sets.items()}
    want = {(i, j): alike[i % 4, j % 4] for i in range(1200) for j in range(i + 1, 1200) if alike[i % 4, j % 4] >= 0.8}
    assert got == want and found.count() == len(want)
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    shuffled = [float(n) for n in re.findall(r"rowCount=([0-9.E+]+)", found._jdf.queryExecution().explainString(formatted))]
    assert shuffled and max(shuffled) < 100


def test_peaks(spark):
    got = {r["sample"]: r["centers"] for r in screening.queries()["top_k_peaks"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("source", F.char_length("text").alias("n")).toPandas().dropna()
    for source, lengths in docs.groupby("source")["n"]:
        bins = (lengths // 100).astype(int).value_counts()
        chosen = []
        for b, n in sorted(bins.items(), key=lambda x: (-x[1], x[0])):
            if n >= 0.01 * bins.sum() and all(abs(b - c) >= 2 for c in chosen) and len(chosen) < 5:
                chosen.append(b)
        assert list(got[source]) == chosen


def fastq(n, name):
    return "".join(f"@{name}{i}\nACGT{'ACGT'[i % 4]}\n+\nIIIII\n" for i in range(n))


def test_reads_of_many_small_files(spark, tmp_path):
    """Plain, gzip and cut-off files, several to a partition."""
    for k in range(6):
        (tmp_path / f"s{k}_merged.fastq").write_text(fastq(7 + k, f"r{k}_") + ("@cut\nAC\n" if k % 2 else ""))
    with gzip.open(tmp_path / "z.fpmerged.fq.gz", "wt") as f:
        f.write(fastq(5, "z"))
    got = files.read_fastq(spark, str(tmp_path)).toPandas().sort_values(["sample", "read_no"])
    assert got.groupby("sample").size().to_dict() == {**{f"s{k}": 7 + k for k in range(6)}, "z": 5}
    assert all(g["read_id"].tolist() == [f"{'z' if s == 'z' else 'r' + s[1:] + '_'}{i}" for i in range(len(g))] for s, g in got.groupby("sample"))
    assert set(got["read_len"]) == {5}
    few = files.subsample(files.read_fastq(spark, str(tmp_path)), 3, seed=4).groupBy("sample").count().collect()
    assert {r["count"] for r in few} == {3}


def test_tables(spark, tmp_path):
    (tmp_path / "in.tsv").write_text("﻿lib-id\t\"my id\"\tr1.c1\nA\tx\t1\nA\tx\tfour\nB\ty\n")
    df = files.read_tsv(spark, str(tmp_path / "in.tsv"))
    assert df.columns == ["LIB_ID", "MYID", "R1_C1"]
    assert sorted(map(tuple, counts.summed(df, ["R1_C1"], ("LIB_ID", "MYID")).collect())) == [("A", "x", 1.0), ("B", "y", 0.0)]
    files.write_tsv(df, str(tmp_path / "out"))
    back = files.read_tsv(spark, str(tmp_path / "out"))
    assert back.count() == 3 and back.filter("R1_C1 = 'NA'").count() == 1
    assert files.numeric_columns(df, ["R1_C1", "MYID"], 0.5) == ["R1_C1"]
    assert files.resolve(["Bb-Id", "TAG_UID"], {"bb": ["bb_id_fixed", "bb_id"], "tag": ["tag_uid"]}) == {"bb": "Bb-Id", "tag": "TAG_UID"}
    with pytest.raises(ValueError):
        files.resolve(["x"], {"bb": ["bb_id"]})


def test_pairs_and_histogram(spark, tmp_path):
    found, alone = files.pair_files(["b/a_R1_001.fastq.gz", "b/a_R2_001.fastq.gz", "b/c_1.fq"])
    assert found == [("a", "b/a_R1_001.fastq.gz", "b/a_R2_001.fastq.gz")] and alone == ["c"]
    (tmp_path / "s.json").write_text(json.dumps({"insert_size": {"histogram": [0, 2, 0, 5]}}))
    assert sorted((r["sample"], r["length"], r["n"]) for r in files.insert_histogram(spark, str(tmp_path)).collect()) == [("s", 1, 2), ("s", 3, 5)]


def test_small_functions(spark):
    row = spark.range(1).select(
        ids.truthy(F.lit(" Yes ")).alias("t"), ids.library_of(F.lit("B1_LIBx")).alias("l"), ids.chain_id(F.lit(3), F.lit("a"), F.lit(None).cast("string")).alias("c"),
        compare.common(F.lit(4.0), F.lit(9.0), "gmean").alias("g"), compare.common(F.lit(4.0), F.lit(9.0)).alias("m"),
    ).first()
    assert tuple(row) == (True, "x", "3_a_NA", 6.0, 4.0)
    assert config.fit_rows(2_000_000) == ("top", 2.0, 200_000) and config.prefilter_for(6_000_000) == (0.75, 3, 1)
    kinds = [counts.length_class(F.col("n"), 63, 72, 5, F.array(F.lit(90))).alias("c"), counts.length_class(F.col("n"), 63, 72, 5, mode="4").alias("m")]
    got = spark.createDataFrame([(63,), (68,), (91,), (72,)], "n int").select("n", *kinds).collect()
    assert {r["n"]: (r["c"], r["m"]) for r in got} == {63: ("outside", "outside"), 68: ("outside", "within_4"), 91: ("within_multi", "outside"), 72: ("outside", "within_4")}


def test_control_weights(spark):
    f = spark.createDataFrame([(2.0, 3.5, 2.15, 1.0)], "fano_r1 double, fano_r2 double, fano_neg1 double, fano_neg2 double")
    assert [round(v, 6) if not isinstance(v, bool) else v for v in hits.shrinkage(f).first()] == [0.5, 0.95, 0.4, False]
    assert hits.shrinkage(f.drop("fano_neg1", "fano_neg2"), strict=True).first()["w_neg"] == 0.6


def test_runs(spark):
    a = spark.createDataFrame([("x", 1.0, 5.0), ("y", None, 6.0)], "key string, s1 double, s2 double")
    b = spark.createDataFrame([("x", 1.0, 7.0), ("z", 3.0, 6.0)], "key string, s1 double, s2 double")
    keys = spark.createDataFrame([("x",), ("y",), ("z",)], "key string")
    wide = compare.with_sample_blocks(keys, {"a_": a, "b_": b}, "key", ["s1", "s2"])
    assert {r["key"]: (r["s1"], r["s2"]) for r in wide.collect()} == {"x": (1.0, 5.0), "y": (None, 6.0), "z": (3.0, 6.0)}
    same = compare.with_sample_blocks(keys, {"a_": a, "b_": a}, "key", ["s1", "s2"])
    assert compare.same_columns(same, ["s1", "s2"], ["a_", "b_"]) == ["b_s1", "b_s2"] and compare.same_columns(wide, ["s1", "s2"], ["a_", "b_"]) == []
