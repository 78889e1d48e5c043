"""DNA text functions, all of them column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")


def normalised(seq: Column) -> Column:
    """Upper case, without blanks (the no-break space included)."""
    return F.upper(F.regexp_replace(seq, r"[ \s]+", ""))


def reverse_complement(seq: Column) -> Column:
    """Bases other than ACGT stay as they are."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def is_dna(seq: Column) -> Column:
    return seq.rlike("^[ACGT]+$")


def substitutions(seq: Column) -> Column:
    """All sequences with one other base at one position."""
    n = F.length(seq)
    at = lambda i, b: F.concat(F.substring(seq, F.lit(1), i - 1), b, F.substring(seq, i + 1, n))
    bases = F.array(*map(F.lit, BASES))
    return F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.filter(bases, lambda b: b != F.substring(seq, i, F.lit(1))), lambda b: at(i, b))))


def deletions(seq: Column) -> Column:
    """All distinct sequences with one base left out; none for a single base."""
    n = F.length(seq)
    out = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(seq, F.lit(1), i - 1), F.substring(seq, i + 1, n)))
    return F.filter(F.array_distinct(out), lambda s: s != "")


def insertions(seq: Column) -> Column:
    """All distinct sequences with one base put in between two, but for a repeat of the outer bases at the outer gaps."""
    n = F.length(seq)
    bases = F.array(*map(F.lit, BASES))
    first, last = F.substring(seq, F.lit(1), F.lit(1)), F.substring(seq, n, F.lit(1))
    allowed = lambda i: F.filter(bases, lambda b: ~((i == 1) & (b == first)) & ~((i == n - 1) & (b == last)))
    put = lambda i: F.transform(allowed(i), lambda b: F.concat(F.substring(seq, F.lit(1), i), b, F.substring(seq, i + 1, n)))
    return F.when(n > 1, F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), put)))).otherwise(F.array().cast("array<string>"))


def kmers(seq: Column, k: int) -> Column:
    """Structs of 0-based position and text of every window of k bases."""
    n = F.length(seq)
    return F.when(
        n >= k, F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), lambda i: F.struct(i.alias("pos"), F.substring(seq, i + 1, F.lit(k)).alias("kmer")))
    )
