"""How far sources of a language differ in their words (operator 12), by sorted streams.

Tasks sort the words of a slice of their documents (SLICE_BYTES) by document and by group, and send runs of equal (lang, term, source) with their numbers. Rows are dealt by (lang, term, source) and sorted by (lang, term,
source, document); a scan of runs of equal keys adds up documents and occurrences. One row for each of these keys is left, so no task gets a common word's rows whole: dealt by
(lang, term) and sorted by source they make one run for each term, as long as its language has sources, which the second scan writes as one row of a table, if enough documents have it.

Scores are exact whole numbers: p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and f = floor((p - q)^2 / (p + q)) between two shares. For pairs of sources, each run gives partial
sums over the sources that have the term. Where both lack it, f is one number for the pair: it is counted for all V terms first, and runs give the difference to it.
The groups (lang, source) with their sums are sent to all tasks: the result has a row for each pair of a language's groups, so their number is about the root of the result's.

Nulls in lang, source and text are read as empty strings. Every row is a document, also where ids are null or repeat. Terms are runs of letters A to Z, a to z and all characters beyond ASCII; only A to Z
are lowered. A language without kept terms has pairs of value 0 and no terms. Equal values rank by item, in the order of UTF-8. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

# Bytes of UTF-8: those of characters beyond ASCII and lower letters stay, A to Z are lowered, all others part terms.
TERM_BYTES = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
SLICE_BYTES = 24 << 20  # of texts whose words a task sorts and adds up together
TOGETHER = 1 << 21  # pairs of a term's source and another source at a time, and of sums that a task holds
SHARE = 1_000_000_000


def counted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """lang, term, source, document (the first of the slice's in that group), docs, n."""
    for batch in small_batches(batches, most):
        words = pa.array([t.translate(TERM_BYTES) for t in batch.column("text").cast(pa.binary()).to_pylist()], pa.binary()).cast(pa.string())
        words = pc.ascii_split_whitespace(words)
        of = np.repeat(np.arange(len(batch)), pc.list_value_length(words).to_numpy())
        words = words.flatten().dictionary_encode()
        terms, word = words.dictionary, words.indices.to_numpy().astype(np.int64)
        filled = np.append(pc.binary_length(terms).to_numpy(), 0)[word] > 0
        # Runs of (document, term), then of (group, term); a group is a lang and a source.
        size = max(1, len(terms))
        one, n = np.unique(of[filled] * size + word[filled], return_counts=True)
        document, term = one // size, one % size
        pair = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"]).to_pylist()
        numbers = {g: k for k, g in enumerate(dict.fromkeys((p["lang"], p["source"]) for p in pair))}
        group = np.array([numbers[p["lang"], p["source"]] for p in pair], np.int64)
        key = group[document] * size + term
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0]) if len(key) else np.array([], np.int64)
        first = pa.array(document[order][at])
        docs, total = np.diff(np.r_[at, len(key)]), np.add.reduceat(n[order], at) if len(at) else n
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").take(first), terms.take(pa.array(term[order][at])), batch.column("source").take(first), batch.column("document").take(first), pa.array(docs, pa.int64()), pa.array(total, pa.int64())],
            ["lang", "term", "source", "document", "docs", "n"],
        )


def _starts(batch: pa.RecordBatch, by: tuple[str, ...]) -> np.ndarray:
    """Where runs of equal keys begin in a sorted batch."""
    changed = np.zeros(len(batch), bool)
    changed[:1] = True
    for c in by:
        column = batch.column(c)
        changed[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(changed)


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each run of (lang, term, source), of the docs and occurrences of its rows."""
    names, rest = ["lang", "term", "source", "docs", "n"], None
    for batch in batches:
        batch = batch.select(names)
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        if not len(batch):
            continue
        at = _starts(batch, ("lang", "term", "source"))
        keys = batch.select(names[:3]).take(pa.array(at))
        runs = pa.RecordBatch.from_arrays([*keys.columns, *[pa.array(np.add.reduceat(batch.column(c).to_numpy(), at)) for c in ("docs", "n")]], names)
        rest = runs.slice(len(runs) - 1)
        yield runs.slice(0, len(runs) - 1)
    if rest is not None:
        yield rest


def gathered(least: int):
    """One row for each run of (lang, term) with at least so many documents: n, and its sources with their counts."""

    def done(batch: pa.RecordBatch, at: np.ndarray) -> pa.RecordBatch:
        ends = np.r_[at, len(batch)].astype(np.int32)
        keys = batch.select(["lang", "term"]).take(pa.array(at))
        docs, n = (np.add.reduceat(batch.column(c).to_numpy(), at) for c in ("docs", "n"))
        lists = [pa.ListArray.from_arrays(pa.array(ends), batch.column(c)) for c in ("source", "n")]
        return pa.RecordBatch.from_arrays([*keys.columns, pa.array(n), *lists], ["lang", "term", "n", "sources", "counts"]).filter(pa.array(docs >= least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            if not len(batch):
                continue
            at = _starts(batch, ("lang", "term"))
            rest = batch.slice(at[-1])
            if len(at) > 1:
                yield done(batch.slice(0, at[-1]), at[:-1])
        if rest is not None:
            yield done(rest, np.array([0]))

    return run


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / total), exact."""
    if len(count) and int(count.max()) > 9_000_000_000:
        return np.array([1 + SHARE * (int(c) + 2) // int(t) for c, t in zip(count, np.broadcast_to(total, count.shape), strict=True)], np.int64)
    return 1 + SHARE * (count + 2) // total


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def paired(groups: dict[str, tuple[list[str], np.ndarray, int]]):
    """Partial sums of f for pairs of sources, beyond f of two sources that lack the term. groups: sources, their sums N and V of each language."""
    place = {lang: {s: k for k, s in enumerate(sources)} for lang, (sources, _, _) in groups.items()}

    def rows(lang: str, sums: dict[tuple[int, int], int] | np.ndarray, first: np.ndarray) -> pa.RecordBatch:
        names = pa.array(groups[lang][0], pa.string())
        a, b = np.nonzero(sums)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), names.take(pa.array(first[a])), names.take(pa.array(b)), pa.array(sums[a, b])], ["lang", "source", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            of = np.array(batch.column("lang").to_pylist(), object)
            for lang in dict.fromkeys(of):
                some = batch.filter(pa.array(of == lang))
                sources, total, v = groups[lang]
                size, total = len(sources), total + 2 * v
                none = shares(np.zeros(size, np.int64), total)
                term = np.repeat(np.arange(len(some)), pc.list_value_length(some.column("sources")).to_numpy())
                where = np.array([place[lang][s] for s in some.column("sources").flatten().to_pylist()], np.int64)
                p = shares(some.column("counts").flatten().to_numpy(), total[where])
                cuts = [0]  # between terms, so that a slice has a term's sources together
                for end in np.flatnonzero(np.r_[term[1:] != term[:-1], True]) + 1:
                    if (end - cuts[-1]) * size >= TOGETHER or end == len(term):
                        cuts.append(int(end))
                for begin, end in zip(cuts, cuts[1:], strict=False):
                    t, s, own = term[begin:end] - term[begin], where[begin:end], p[begin:end]
                    every = np.broadcast_to(none, (t[-1] + 1, size)).copy()
                    lacks = np.ones(every.shape, bool)
                    every[t, s], lacks[t, s] = own, False
                    more = _differ(own[:, None], every[t]) - _differ(none[s][:, None], none[None, :])
                    more *= lacks[t] | (s[:, None] < np.arange(size))  # what both have counts once
                    which, at = np.unique(s, return_inverse=True)
                    sums = np.zeros((len(which), size), np.int64)
                    np.add.at(sums, at, more)
                    if size * size > TOGETHER:
                        yield rows(lang, sums, which)
                        continue
                    if lang not in held and sum(x.size for x in held.values()) + size * size > TOGETHER:
                        yield from (rows(k, x, np.arange(len(x))) for k, x in held.items())
                        held.clear()
                    held.setdefault(lang, np.zeros((size, size), np.int64))[which] += sums
        yield from (rows(k, x, np.arange(len(x))) for k, x in held.items())

    return run


def audit(docs: DataFrame, least_docs: int = 10, top: int = 10, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part (pair or term), item (another source, or a term that the source has more often than its language), value, rank."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), F.col(id_col).cast("long").alias("document"), blank(text_col).alias("text"))
    key = ["lang", "term", "source"]
    most = SLICE_BYTES
    parts = rows.mapInArrow(lambda batches: counted(batches, most), "lang string, term string, source string, document long, docs long, n long")
    sums = parts.repartition(*key).sortWithinPartitions(*key, "document").mapInArrow(summed, "lang string, term string, source string, docs long, n long")
    terms = sums.repartition("lang", "term").sortWithinPartitions(*key).mapInArrow(gathered(least_docs), "lang string, term string, n long, sources array<string>, counts array<long>")
    terms = written(terms, "terms")

    # Every language's V and N, every group's N.
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("of_lang"))
    entries = terms.select("lang", "term", F.col("n").alias("in_lang"), F.explode(F.arrays_zip("sources", "counts")).alias("e")).select("lang", "term", "in_lang", "e.sources", "e.counts")
    entries = entries.withColumnsRenamed({"sources": "source", "counts": "n"})
    own = entries.groupBy("lang", "source").agg(F.sum("n").alias("of_group"))
    groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("of_group", "v", "of_lang")]), "groups")
    share = lambda n, total: 1 + F.expr(f"cast({SHARE} as decimal(10,0)) * cast({n} + 2 as decimal(20,0)) div cast({total} + 2 * v as decimal(20,0))")
    differ = F.expr("(p - q) * (p - q) div (p + q)")

    # Terms that a group has more often than its language. The window keeps a task's best before the shuffle.
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    scored = entries.join(groups, ["lang", "source"]).withColumns({"p": share("n", "of_group"), "q": share("in_lang", "of_lang")}).filter("p > q")
    best = scored.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), differ.alias("value")).withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)

    # Pairs: f of two sources that lack a term, for all terms, and what the terms' runs add.
    known: dict[str, tuple[list, list, int]] = {}
    for r in groups.filter("v > 0").orderBy("lang", "source").toLocalIterator():
        known.setdefault(r["lang"], ([], [], r["v"]))
        known[r["lang"]][0].append(r["source"])
        known[r["lang"]][1].append(r["of_group"])
    sent = {lang: (sources, np.array(n, np.int64), v) for lang, (sources, n, v) in known.items()}
    more = terms.select("lang", "sources", "counts").mapInArrow(paired(sent), "lang string, source string, item string, value long")
    more = more.groupBy("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item")).agg(F.sum("value").alias("more"))
    none = groups.select("lang", "source", "v", F.when(F.col("v") > 0, share("0", "of_group")).alias("p"))
    other = none.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    half = none.join(other, "lang").filter("source < item").join(written(more, "pairs"), ["lang", "source", "item"], "left")
    half = half.select("lang", "source", "item", (F.coalesce(F.col("v") * differ, F.lit(0)) + F.coalesce("more", F.lit(0))).alias("value"))
    both = half.select("*", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("x"))
    pairs = both.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value").withColumn("rank", F.row_number().over(by))
    return pairs.unionByName(best)
