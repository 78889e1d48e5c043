"""Document fingerprints by consistent weighted sampling, in DataFrame functions only (operator 2).

A text's terms are its lower-cased runs between blanks, weighted by how often they occur. For each slot k and term, three numbers follow from one hash
of (term, k): r and c, drawn from a Gamma(2, 1) distribution, and b, uniform. With t = floor(ln w / r + b), a
term's rank is ln a = ln c - r (t - b) - r, and the slot holds the (term, t) of least rank. Two texts have the same (term, t) in a slot with a probability
equal to the generalised Jaccard similarity of their term weights, so the share of equal slots estimates it.

r and ln c are read from tables of the distribution's quantiles, the latter finer towards 0, where the least ranks come from; that costs
a hash and a few products for a term and slot and no logarithm. Below the table c follows its limit sqrt(2 u). A slot's rank and its
identity travel as one long, so that the least of them is a plain minimum.

Nulls and empty texts count as the one empty term: their fingerprints are equal to one another's and unlike any other. Texts of any length
are read whole. Rows that repeat an id are documents of their own, in order of their text; null ids come last, in an order of hashes of their texts. An empty table gives
an empty result. Columns other than those named are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SLOTS = 48
BLOCK = 512  # documents of one block, about
RANGES = 64  # quantiles of all ids, and of the ids between two of them; ids are cut there first, and evenly in between


def gamma_quantile(u: float) -> float:
    """x with P(Gamma(2, 1) <= x) = 1 - (1 + x) exp(-x) = u, by bisection."""
    low, high = 0.0, 60.0
    for _ in range(80):
        mid = (low + high) / 2
        if -math.expm1(-mid) - mid * math.exp(-mid) < u:
            low = mid
        else:
            high = mid
    return low


def _literal(values: list[float]) -> Column:
    """A constant array; folded to one literal by the optimizer."""
    return F.expr("cast(split('" + ",".join(f"{v:.5f}" for v in values) + "', ',') as array<double>)")


def tables() -> tuple[list[float], list[float]]:
    """r in the middle of 256 equal parts of its distribution, and ln c in the middle of 64 equal parts of [0, 2**-10), of [0, 2**-5) and of [0, 1)."""
    r = [gamma_quantile((k + 0.5) / 256) for k in range(256)]
    c = [math.log(gamma_quantile((k + 0.5) / 64 * top)) for top in (2**-10, 2**-5, 1) for k in range(64)]
    return r, c


def terms(text: Column) -> Column:
    """Sorted hashes of all terms, repeated ones included; a text without terms has the empty one."""
    words = F.array_remove(F.split(F.lower(text), r"\s+"), "")
    return F.sort_array(F.transform(F.when(F.size(words) > 0, words).otherwise(F.array(F.lit(""))), lambda w: F.xxhash64(w)))


def run_starts(sorted_terms: str) -> Column:
    """Where the runs of equal terms begin."""
    h = F.col(sorted_terms)
    return F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: (i == 0) | (F.get(h, i) != F.get(h, i - 1)))


def slot(term: Column, log_weight: Column, k: int, r_table: Column, p_table: Column, c_table: Column) -> Column:
    """Rank (upper 31 bits) and identity (lower 32 bits) of a term in slot k."""
    h = F.xxhash64(term, F.lit(k))
    bits = lambda at, n: F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << n) - 1))
    i = bits(0, 8).cast("int")
    r, per_r = F.coalesce(F.get(r_table, i), F.lit(1.0)), F.coalesce(F.get(p_table, i), F.lit(1.0))
    v = bits(8, 22).cast("int")
    cell = F.when(v >= 1 << 17, F.shiftright(v, 16) + 128).when(v >= 1 << 12, F.shiftright(v, 11) + 64).otherwise(F.shiftright(v, 6))
    c = F.when(v >= 1 << 7, F.coalesce(F.get(c_table, cell), F.lit(0.0))).otherwise(F.coalesce(0.5 * F.log((v + 0.5) * 2.0**-21), F.lit(0.0)))
    b = bits(30, 30) * 2.0**-30
    t = F.floor(log_weight * per_r + b)
    rank = c - r * (t - b + 1.0)
    scaled = F.floor((F.least(F.greatest(rank, F.lit(-100.0)), F.lit(27.9)) + 100.0) * float(1 << 24))
    identity = F.shiftrightunsigned(h, 9).bitwiseXOR(t * 40503).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(scaled, 32).bitwiseOR(identity)


def sampled(rows: DataFrame, keys: list[str], text_col: str, slots: int = SLOTS) -> DataFrame:
    """keys and slots (array of longs), for rows whose keys are unique. Shuffles only if rows aren't dealt by some of the keys."""
    r_values, c_values = tables()
    r_table, p_table, c_table = _literal(r_values), _literal([1 / r for r in r_values]), _literal(c_values)
    h = rows.select(*keys, terms(F.col(text_col)).alias("_h"))
    begins = h.select(*keys, "_h", run_starts("_h").alias("_b"))
    # The outer form has no filter inferred from it, which would compute the arrays once more.
    runs = begins.select(*keys, "_h", "_b", F.posexplode_outer("_b").alias("_i", "_at"))
    weight = F.coalesce(F.get("_b", F.col("_i") + 1), F.size("_h")) - F.col("_at")
    pairs = runs.select(*keys, F.coalesce(F.get("_h", F.col("_at")), F.lit(0)).alias("_term"), F.coalesce(F.log(weight.cast("double")), F.lit(0.0)).alias("_log"))
    least = [F.min(slot(F.col("_term"), F.col("_log"), k, r_table, p_table, c_table)).alias(f"_s{k}") for k in range(slots)]
    return pairs.groupBy(*keys).agg(*least).select(*keys, F.array(*[F.col(f"_s{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(slots)]).alias("slots"))


def as_text(slots: Column) -> Column:
    """Eight hexadecimal digits for each slot."""
    return F.concat_ws("", F.transform(slots, lambda s: F.lower(F.lpad(F.hex(s), 8, "0"))))


def likeness(a: Column, b: Column, slots: int = SLOTS) -> Column:
    """The share of equal slots."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), lambda same: same)) / F.lit(float(slots))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """id and fingerprint of each row's text. Rows are told apart by a number of their own, so repeated ids keep theirs."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    return sampled(rows, ["doc_id", "row"], "text", slots).select("doc_id", as_text(F.col("slots")).alias("fingerprint"))


def _with_blocks(rows: DataFrame) -> DataFrame:
    """rows with block, a number that never falls as ids grow, of about BLOCK documents each wherever the ids lie.

    Ids are cut at RANGES * RANGES quantiles of a sketch and evenly between two of these, so a few outlying ids leave the others' blocks as they are. Documents without an id are dealt to as many blocks
    as they need by a hash of their text; these are below all others.
    """
    n = rows.agg(F.count("doc_id").alias("with_id"), F.count(F.lit(1)).alias("all")).first()
    steps = max(2, min(RANGES * RANGES, -(-n["with_id"] // BLOCK)))
    shares = F.expr("cast(split('" + ",".join(str(k / steps) for k in range(1, steps)) + "', ',') as array<double>)")
    cuts = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * steps)).alias("cuts")).first()["cuts"]
    block = F.lit(0).cast("long")
    if cuts:
        flat = F.expr("cast(split('" + ",".join(map(str, cuts)) + "', ',') as array<bigint>)")
        tops = F.expr("cast(split('" + ",".join(map(str, cuts[RANGES - 1 :: RANGES])) + "', ',') as array<bigint>)") if len(cuts) >= RANGES else F.array().cast("array<bigint>")
        below = lambda a: F.size(F.filter(a, lambda c: c < F.col("doc_id")))
        rows = rows.withColumn("_top", below(tops)).withColumn("_range", F.when(F.col("doc_id").isNotNull(), F.col("_top") * RANGES + below(F.slice(flat, F.col("_top") * RANGES + 1, F.lit(RANGES - 1))))).drop("_top")
        wide = F.max("doc_id").cast("double") - F.min("doc_id").cast("double")
        sizes = rows.groupBy("_range").agg(F.min("doc_id").cast("double").alias("_low"), (wide / F.ceil(F.count(F.lit(1)) / BLOCK) + 1.0).alias("_width"))
        sizes = sizes.filter("_range is not null")
        rows = rows.join(F.broadcast(sizes), "_range", "left")  # RANGES * RANGES rows at most
        block = F.col("_range").cast("long") * (1 << 24) + F.floor((F.col("doc_id").cast("double") - F.col("_low")) / F.col("_width"))
    if n["all"] > n["with_id"]:
        k = F.pmod(F.xxhash64("text"), F.lit(-(-(n["all"] - n["with_id"]) // BLOCK)))
        block = F.when(F.col("doc_id").isNull(), -(1 + F.pmod(k, F.lit(4096)) * (1 << 24) + F.floor(k / 4096))).otherwise(block)
    return rows.withColumn("block", block.cast("long")).select("doc_id", "text", "block")


def _next_blocks(ids: DataFrame) -> DataFrame:
    """block, the next lower block, and the greatest id there; the lowest block is followed by the greatest one.

    A block's neighbour is looked up among blocks between two quantiles, then among these, so no task orders all blocks.
    """
    heads = ids.groupBy("block").agg(F.max("doc_id").alias("head")).withColumn("upper", F.floor(F.col("block") / (1 << 24)))
    inside = Window.partitionBy("upper").orderBy(F.col("block").desc())
    tops = heads.groupBy("upper").agg(F.max(F.struct("block", "head")).alias("top"))
    every = Window.orderBy(F.desc("upper"))  # RANGES * RANGES rows, and as many for documents without an id
    follow = tops.select("upper", F.lead("top").over(every).alias("after"), F.first("top").over(every).alias("first"))
    return (
        heads.withColumn("next", F.lead(F.struct("block", "head")).over(inside))
        .join(follow, "upper")
        .select("block", F.coalesce("next", "after", "first").alias("next"))
        .select("block", F.col("next.block").alias("next_block"), F.col("next.head").alias("next_id"))
    )


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Fingerprints of each text and of its edited text, with how alike they and the next document's are.

    The edited text has its last half (rounded down, in code points) replaced by as much of the start of the next document,
    by descending id; the first follows the last. Documents are dealt by blocks of ids, each with a copy of the document that follows the
    block, so one shuffle of the texts serves the edit, the fingerprints and the comparison with the next document.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = _with_blocks(rows)
    after = written(_next_blocks(rows.select("doc_id", "block")), "blocks")
    follow = after.select(F.col("block").alias("for_block"), "next_block", "next_id")
    heads = (
        rows.join(follow, (rows["block"] == follow["next_block"]) & rows["doc_id"].eqNullSafe(follow["next_id"]))
        .groupBy("for_block", "doc_id")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.col("for_block").alias("block"), F.lit(1).alias("copy"))
    )
    every = rows.select("doc_id", "text", "block", F.lit(0).alias("copy")).unionByName(heads)
    order = Window.partitionBy("block").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    placed = every.withColumn("place", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    placed = placed.select("block", "place", "copy", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    both = placed.select(
        "block", "place", "copy", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.when(F.col("copy") == 0, F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body")))).otherwise(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body"))))).alias("of"),
    ).select("block", "place", "copy", "doc_id", "n_chars", "edited_sha256", "of.kind", "of.body")
    keys = ["block", "place", "copy", "doc_id", "n_chars", "edited_sha256"]
    found = sampled(both, [*keys, "kind"], "body", slots)
    pairs = found.groupBy(*keys).agg(F.max(F.when(F.col("kind") == 0, F.col("slots"))).alias("own"), F.max(F.when(F.col("kind") == 1, F.col("slots"))).alias("changed"))
    with_next = pairs.withColumn("next", F.lead("own").over(Window.partitionBy("block").orderBy("place"))).filter("copy = 0")
    return with_next.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed"), slots).alias("near_edited"), likeness(F.col("own"), F.col("next"), slots).alias("near_next"),
    )
