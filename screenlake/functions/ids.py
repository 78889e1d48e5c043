"""Molecule ids: parsing, keys and names for display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = ("", "NA", "nan", "None")


def present(c: Column) -> Column:
    """The trimmed value, null for the marks of a missing one."""
    t = F.trim(c)
    return F.when(~t.isin(*MISSING), t)


def or_na(c: Column) -> Column:
    return F.coalesce(present(c), F.lit("NA"))


def strip_library(c: Column) -> Column:
    """A building block without its library suffix."""
    return F.regexp_replace(c, r"(?i)_LIB[\w.-]+$", "")


def library_of(c: Column) -> Column:
    """The library that a building block's suffix names, else null."""
    return present(F.regexp_extract(c, r"_LIB([\w.-]+)$", 1))


def has_library(c: Column) -> Column:
    """Whether an id or a block names a library by a suffix; nothing names none."""
    return F.coalesce(c.rlike(r"(?i)_LIB[\w.-]"), F.lit(False))


def chain_id(cycles: Column, *blocks: Column) -> Column:
    return F.concat_ws("_", cycles.cast("string"), *[or_na(b) for b in blocks])


def parsed(mol_id: Column) -> Column:
    """A struct of cycles, bb1 to bb4 and cp from an id.

    Parts are separated by any of | _ , : ; / and blanks; a leading number gives the cycles. A part that begins with LIB is glued to the one before it, if
    that is a block of its own: not NA, not itself a LIB part and not glued already. Of what is left after four blocks, the last part is the closing primer if it
    looks like one, in either case. Without a number, cycles are 4 if there is a fourth block, else 3.
    """
    parts = F.filter(F.split(F.coalesce(mol_id, F.lit("")), r"[|_,:;/\s]+"), lambda p: p != "")
    counted = F.coalesce(F.get(parts, F.lit(0)).rlike("^[0-9]+$"), F.lit(False))
    rest = F.when(counted, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts)
    empty = F.array().cast("array<struct<text:string,open:boolean>>")

    def add(acc: Column, p: Column) -> Column:
        last = F.element_at(acc, -1)
        plain = F.struct(p.alias("text"), ((p != "NA") & ~p.startswith("LIB")).alias("open"))
        glued = F.struct(F.concat_ws("_", last["text"], p).alias("text"), F.lit(False).alias("open"))
        fits = p.startswith("LIB") & (F.size(acc) > 0) & (F.size(acc) <= 4) & last["open"]
        return F.when(fits, F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(glued))).otherwise(F.concat(acc, F.array(plain)))

    # An empty array has no last element, so the first part is put in before the rest are folded.
    head = F.transform(F.slice(rest, F.lit(1), F.lit(1)), lambda p: F.struct(p.alias("text"), ((p != "NA") & ~p.startswith("LIB")).alias("open")))
    tail = F.slice(rest, F.lit(2), F.greatest(F.size(rest), F.lit(1)))
    glued = F.when(F.size(rest) > 0, F.aggregate(tail, head, add)).otherwise(empty)
    block = lambda i: F.coalesce(F.get(glued, F.lit(i))["text"], F.lit("NA"))
    after = F.get(glued, F.size(glued) - 1)["text"]
    cycles = F.when(counted, F.get(parts, F.lit(0)).try_cast("int")).otherwise(F.when(block(3) != "NA", 4).otherwise(3))
    cp = F.when((F.size(glued) > 4) & after.rlike("(?i)^(DEL|CP)[A-Za-z0-9]+$"), after).otherwise(F.lit("NA"))
    return F.struct(cycles.alias("cycles"), *[block(i).alias(f"bb{i + 1}") for i in range(4)], cp.alias("cp"))


def compound_key(*blocks: Column, strip: bool = True) -> Column:
    return F.concat_ws("|", *[strip_library(or_na(b)) if strip else or_na(b) for b in blocks])


def display_id(lib: Column, *blocks: Column) -> Column:
    """Library and blocks without suffixes and missing ones."""
    return F.concat_ws("_", present(lib), *[present(strip_library(b)) for b in blocks])


def truthy(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y", "t")
