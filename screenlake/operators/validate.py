"""Checks of decoded reads that were kept: a rule engine over one row, its counts, a read-back against the reads themselves, and a table of all tables by sample.

Rules give an array of errors for each row, inside one projection. What a library allows comes by joins on the text of an anchor or codon, so a design of any size is a table; the planner
broadcasts it where its size allows. Rows: those of decode.records().
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dna, ids
from ..plans.staging import staged
from .decode import TOLERANCE

ANCHORS = ("hp", "op", "cp")


def _oriented(sequence: str = "read_seq") -> Column:
    return F.when(F.col("direction") == "revcomp", dna.reverse_complement(F.col(sequence))).otherwise(F.col(sequence))


def validated(rows: DataFrame, table: DataFrame, cycles: int = 4, tolerance: int = TOLERANCE, codon: int = 9, cp_least: int = 27, cp_most: int = 29, rejected: Column | None = None) -> DataFrame:
    """rows with errors, the names of all rules that a row breaks, once for each break; none for a sound row.

    Anchors and codons are read again from the kept sequence at the kept places. A codon that is missing or out of bounds is passed over by the rules of order and gaps, so
    these look at its neighbours. table: decode.patterns(). rejected: whether the length filter would have kept the read out.
    """
    sets = staged(table.groupBy("type", "kmer").agg(F.collect_set("lib_id").alias("libs")))
    known = table.filter("type = 'CODON'").groupBy("lib_id").agg(F.max("cycle").alias("_expected"))
    here = lambda a, f: F.col(f"{a}_{f}")
    missing = lambda a: here(a, "pos").isNull() | here(a, "len").isNull() | here(a, "seq").isNull()
    outside = lambda a: (here(a, "pos") < 0) | (here(a, "pos") + here(a, "len") > F.length("_o"))
    differs = lambda a: F.substring("_o", here(a, "pos") + 1, here(a, "len")) != here(a, "seq")
    count, codons = F.coalesce("cycles", F.lit(0)), [f"c{k}" for k in range(1, cycles + 1)]

    def place(a: str, name: str, asked: Column) -> Column:
        """What is wrong with where an anchor or codon lies, if it is asked for."""
        return F.when(asked & missing(a), f"missing_{a}").when(asked & outside(a), f"{name}_pos_oob").when(asked & differs(a), f"{name}_seq_mismatch")

    # Rules are plain columns: what a lambda is given is interpreted, lambdas inside it included. The two steps have a small one each, which keeps them out of the joins' code: with it they
    # would be one method, too large to be compiled.
    x = rows.withColumn("_o", _oriented()).join(staged(known), "lib_id", "left")
    for a in (*ANCHORS, *codons):
        kind = a.upper() if a in ANCHORS else "CODON"
        x = x.join(sets.filter(F.col("type") == kind).select(F.col("kmer").alias(f"{a}_seq"), F.col("libs").alias(f"_{a}_libs")), f"{a}_seq", "left")
    fits = lambda a: F.coalesce(F.array_contains(f"_{a}_libs", F.col("lib_id")) | (F.array_contains(f"_{a}_libs", "") if a in ("hp", "op") else F.lit(False)), F.lit(False))
    seen = {a: ~missing(a) for a in ANCHORS} | {c: (count >= k) & ~missing(c) & ~outside(c) for k, c in enumerate(codons, 1)}  # of codons only those that can be looked at
    x = x.withColumns({f"_{a}_{f}": F.when(seen[a], here(a, f)) for a in seen for f in ("pos", "len")} | {"_strange": F.exists(F.array(*[seen[c] & ~fits(c) for c in codons]), lambda v: F.coalesce(v, F.lit(False)))})

    pos, size = lambda a: F.col(f"_{a}_pos"), lambda a: F.col(f"_{a}_len")
    some = lambda f, order: F.coalesce(*[F.col(f"_{c}_{f}") for c in order])
    far = lambda a, n, b: F.abs(b - (a + n)) > tolerance
    errors = [F.when(F.col("read_len") != F.length("read_seq"), "read_len_mismatch"), F.when(F.col("cycles").isNull(), "cycles_parse")]
    errors += [F.when(count > 0, F.when(F.col("_expected").isNull(), "lib_unknown").when(count != F.col("_expected"), "cycles_mismatch"))]
    if rejected is not None:
        errors.append(F.when(rejected, "length_filter_reject"))
    errors += [place(a, a.upper(), F.lit(True)) for a in ANCHORS] + [place(c, c, count >= k) for k, c in enumerate(codons, 1)]
    first, last, end = some("pos", codons), some("pos", codons[::-1]), some("len", codons[::-1])
    errors += [F.when(pos("hp") > pos("op"), "order_violation"), F.when(first < pos("op"), "order_violation"), F.when(last > pos("cp"), "order_violation")]
    errors += [F.when(far(pos("hp"), size("hp"), pos("op")), "gap_HP_OP"), F.when(far(pos("op"), size("op"), first), "gap_OP_C1"), F.when(far(last, end, pos("cp")), "gap_C_last_CP")]
    errors += [F.when(F.exists(F.array(*map(size, codons)), lambda n: F.coalesce(n != codon, F.lit(False))), f"codon_len_not{codon}"), F.when(~F.coalesce(size("cp").between(cp_least, cp_most), F.lit(True)), f"cp_len_out_of_{cp_least}_{cp_most}")]
    errors += [F.when(~missing(a) & ~fits(a), f"{a.upper()}_not_in_lib") for a in ANCHORS]
    errors.append(F.when(F.col("_expected").isNotNull() & F.col("_strange"), "codon_not_in_lib"))
    for k in range(1, cycles):  # each codon that can be looked at and the one before it, the i-th of them
        before, here_, i = codons[k - 1 :: -1], codons[k], sum((pos(c).isNotNull().cast("int") for c in codons[:k]), F.lit(0))
        name = F.concat(F.lit("gap_C"), i.cast("string"), F.lit("_C"), (i + 1).cast("string"))
        errors += [F.when(pos(here_) < some("pos", before), "order_violation"), F.when(far(some("pos", before), some("len", before), pos(here_)), name)]
    found = F.array_remove(F.split(F.concat_ws(",", *errors), ","), "")  # what is null is left out, and names hold no comma
    return x.select(*rows.columns, found.alias("errors"))


def error_counts(checked: DataFrame) -> DataFrame:
    """By sample: check and n, for the rows looked at (n), those that pass or fail, and each error."""
    verdict = F.when(F.size("errors") == 0, "pass").otherwise("fail")
    long = checked.select("sample", F.explode(F.concat(F.array(F.lit("n"), verdict), "errors")).alias("check"))
    return long.groupBy("sample", "check").agg(F.count(F.lit(1)).alias("n"))


def read_back(rows: DataFrame, reads: DataFrame, cycles: int = 4) -> DataFrame:
    """rows with mismatches: what their own reads, found by id, and their ids don't bear out.

    Every anchor and codon has to stand at its place of the read in the decoded direction, and the id's parts have to be the row's cycles, blocks and library. A row without a read has read_missing.
    Each id is taken apart once, as the reads of a molecule share it. reads: read_id, seq. rows are read twice: stage them if they are costly.
    """
    text = F.coalesce("id", F.lit(""))
    named = rows.select(text.alias("_id")).distinct().withColumn("_p", ids.parsed(F.col("_id")))
    libs = F.array_distinct(F.filter(F.array(*[ids.library_of(F.col(f"_p.bb{k}")) for k in range(1, cycles + 1)]), lambda v: v.isNotNull()))
    x = rows.withColumn("_id", text).join(named.withColumn("_libs", libs), "_id", "left")
    x = x.join(reads.select("read_id", F.col("seq").alias("_seq")), "read_id", "left").withColumn("_o", _oriented("_seq"))
    differs = lambda a: F.coalesce((F.col(f"{a}_pos") < 0) | (F.substring("_o", F.col(f"{a}_pos") + 1, F.col(f"{a}_len")) != F.col(f"{a}_seq")), F.lit(False))
    found = [F.when(F.col("_seq").isNull(), "read_missing"), *[F.when(differs(a), f"seq_mismatch_{a.upper()}") for a in (*ANCHORS, *[f"c{k}" for k in range(1, cycles + 1)])]]
    found.append(F.when((F.col("cycles") > 0) & (F.col("_p.cycles").cast("int") != F.col("cycles")), "cycles_mismatch"))
    same = reduce(lambda a, b: a & b, [F.coalesce(f"c{k}_bb_id", F.lit("NA")) == F.col(f"_p.bb{k}") for k in range(1, cycles + 1)])
    libs = F.col("_libs")
    found.append(F.when(~same, "bb_id_mismatch"))
    found.append(F.when(F.size(libs) == 0, "lib_suffix_missing").when((F.size(libs) > 1) | ~F.array_contains(libs, F.col("lib_id")), "lib_id_mismatch"))
    return x.select(*rows.columns, F.filter(F.array(*found), lambda m: m.isNotNull()).alias("mismatches"))


def recounted(rows: DataFrame, matrix: DataFrame, samples: list[str]) -> DataFrame:
    """lib_id, id, sample, kept and counted where the matrix and a new count of the rows differ; what one of them lacks counts 0."""
    own = rows.groupBy("lib_id", "id", "sample").agg(F.count(F.lit(1)).alias("counted"))
    long = matrix.select("lib_id", "id", F.explode(F.array(*[F.struct(F.lit(s).alias("sample"), F.col(s).cast("long").alias("kept")) for s in samples])).alias("x")).select("lib_id", "id", "x.sample", "x.kept")
    both = long.filter("kept != 0").join(own, ["lib_id", "id", "sample"], "full")
    return both.na.fill(0, ["kept", "counted"]).filter("kept != counted").select("lib_id", "id", "sample", "kept", "counted")


def assembled(tables: dict[str, DataFrame], key: str = "sample") -> DataFrame:
    """One row for each key of any table, with all tables' numbers: each column once, 0 where no table has it for a key; absent, the tables without the key, and conflicts, the columns that tables disagree on.

    All tables are laid end to end as (key, table, column, value) and put together by one aggregation, however many there are; what several tables say is compared there. The greatest value
    stands where they disagree.
    """
    columns = list(dict.fromkeys(c for t in tables.values() for c in t.columns if c != key))
    pairs = lambda t: F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in t.columns if c != key])).alias("x")
    long = reduce(lambda a, b: a.unionByName(b), [t.select(key, F.lit(name).alias("table"), pairs(t)) for name, t in tables.items()]).select(key, "table", "x.c", "x.v")
    cells = long.groupBy(key, "c").agg(F.max("v").alias("v"), F.min("v").alias("least"), F.collect_set("table").alias("tables"))
    rows = cells.groupBy(key).agg(
        *[F.coalesce(F.max(F.when(F.col("c") == c, F.col("v"))), F.lit(0.0)).alias(c) for c in columns],
        F.array_distinct(F.flatten(F.collect_list("tables"))).alias("_there"),
        F.concat_ws(",", F.sort_array(F.collect_list(F.when(F.col("v") != F.col("least"), F.col("c"))))).alias("conflicts"),
    )
    absent = F.concat_ws(",", F.array_except(F.array(*map(F.lit, sorted(tables))), "_there"))
    return rows.select(key, *columns, absent.alias("absent"), "conflicts")
