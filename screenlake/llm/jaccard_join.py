"""N-gram Jaccard self-join with a token-group matrix, and the classes that its links make (operator 7).

A text's words are lower-cased (A-Z) runs without blanks; its set holds its distinct n-word shingles as 64-bit hashes (a text with
fewer words has the one shingle of all of them; without words the set is empty and linked with nothing). Two texts link when
100 * intersection >= percent * union.

1. Texts with equal sets form a class, named by a hash of the set, with one representative text.
2. Linked sets differ in few shingles, d at most (`most_different`). A set's shingles are dealt by hash to more than d buckets, so linked sets have
   buckets with just the same content. A set keeps d + 1 of its buckets, the fullest first, as keys: that order is the same for all sets,
   so linked sets share a key (prefixes of sets of buckets). A key stands for several shingles at once, those of a common passage mixed with the
   text's own, so texts that merely share passages don't meet. The number of buckets follows the size: sizes are cut into ranges, and
   a set that may link with one of the next range has keys for that range as well.
3. Classes that share keys are put into groups of about GROUP_ROWS, each led by the smallest name among those that it met, so that a group's members
   are alike. A group is a column of the token-group matrix: its token union, with the members that hold each token. It is built in one task,
   which links the group's own members, and is stored.
4. What has linked so far is one component. A query goes to other groups only where one of its keys meets a larger component than its own, as
   links inside a component change nothing, and only where the tokens' counts over the stored unions allow a link: tokens that no other class holds
   can't be in an intersection. So many near copies of one text that don't link, as each has tokens of its own, don't ask one another. A stored
   group is opened for a query only if its union holds percent of the query's tokens.

Every link between different components is found, so components are exact (up to equal 64-bit hashes of different
shingles). No step brings a group of unbounded size into one task, and nothing that grows with the corpus goes to the driver.

Null texts count as empty; null ids take no part and get a null component. Rows that repeat an id are one document with the links of all of
them. Ties (equal ids, equal sets) don't change the result. An empty table gives an empty result. Columns other than those named are
ignored.
"""

from __future__ import annotations

import functools
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, temporary, written

GROUP_ROWS = 48
GROUP_TOKENS = 1 << 20  # tokens of all members of a group, about
QUERY_ROWS = 64
PARTS_TOGETHER = 128
RANGE_WIDTH = 3  # a range of sizes spans this many steps of 100 / percent
SPARE_BUCKETS = 1.4  # buckets for each shingle that linked sets of a range may differ in
SLICE_TOKENS = 1 << 15
KEYS_TOGETHER = 1 << 18  # keys that a task brings together at a time, on either side of the shuffle
SEEN_CLASSES = 1_000_000  # a task's memory of classes whose keys it has given; beyond it some are given again
FILTER_PARTS = 512  # parts of 32,768 bits of the filter of ids, 2 MB in all

_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words; bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


@functools.cache
def _word_hashes() -> _Hashes:
    """One for each Python worker."""
    return _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, n: int, known: dict) -> np.ndarray:
    """The text's set, as sorted hashes."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z only, and exactly the six blanks of ASCII
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mixed(out * _ODD + h[k : len(words) - size + 1 + k])
    return np.unique(out)


def most_different(a: int, b: int, percent: int) -> int:
    """The most shingles that one of two linked sets of these sizes has and the other hasn't."""
    return (a + b) * (100 - percent) // (100 + percent)


@functools.cache
def _range_starts(percent: int) -> list[int]:
    return [1]


def size_ranges(n: int, percent: int) -> list[tuple[int, int]]:
    """Number and greatest size of the ranges that a set of n >= 1 has keys for: its own, and the next one if a set there can link with it."""
    starts, largest = _range_starts(percent), 100 * n // percent
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 100**RANGE_WIDTH // percent**RANGE_WIDTH)))
    return [(k, starts[k] - 1) for k in range(bisect_right(starts, n), bisect_right(starts, largest) + 1)]


def keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set (sorted or not, without repeats): linked sets that aren't equal share one."""
    n = len(s)
    different = most_different(n, 100 * n // percent, percent) if n else 0
    if not different:
        return np.zeros(0, np.int64)
    out = []
    for number, largest in size_ranges(n, percent):
        buckets = int(SPARE_BUCKETS * (most_different(largest, largest, percent) + 1))
        of = (s % np.uint64(buckets)).astype(np.int64)
        load = np.bincount(of, minlength=buckets)
        begin = np.cumsum(load) - load
        sums = np.zeros(buckets, np.uint64)
        filled = np.flatnonzero(load)
        sums[filled] = np.add.reduceat(_mixed(s ^ _ODD)[np.argsort(of, kind="stable")], begin[filled])
        names = _mixed(sums + _mixed(np.arange(buckets, dtype=np.uint64) * _ODD + np.uint64(number)))
        # With too many empty buckets, equal ones may all be empty: then every bucket is a key.
        chosen = np.lexsort((names, -load))[: different + 1] if len(filled) > different else slice(None)
        out.append(names[chosen])
    return np.concatenate(out).view(np.int64)


class Group:
    """A column of the token-group matrix: the union of its members' tokens and, bit by bit, the members that hold each."""

    def __init__(self, tokens: np.ndarray, bits: np.ndarray, sizes: np.ndarray):
        self.tokens, self.bits, self.sizes = tokens, bits, sizes

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Group:
        tokens = np.unique(np.concatenate(sets))
        bits = np.zeros((len(tokens), -(-len(sets) // 8)), np.uint8)
        for i, s in enumerate(sets):
            bits[np.searchsorted(tokens, s), i // 8] |= np.uint8(1 << i % 8)
        return cls(tokens, bits, np.array([len(s) for s in sets], np.int64))

    def _both(self, rows: np.ndarray) -> np.ndarray:
        return np.unpackbits(rows, axis=1, count=len(self.sizes), bitorder="little")

    def links(self, percent: int) -> np.ndarray:
        """Which members link with which."""
        both = np.zeros((len(self.sizes), len(self.sizes)), np.int64)
        for k in range(0, len(self.tokens), SLICE_TOKENS):
            held = self._both(self.bits[k : k + SLICE_TOKENS]).astype(np.float32)
            both += (held.T @ held).astype(np.int64)  # whole numbers below 2**24
        return (100 * both >= percent * (self.sizes[:, None] + self.sizes - both)) & (both > 0)

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members that link with the query. The members are opened only if the union holds enough of the query."""
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        if not len(at) or 100 * len(at) < percent * len(query):
            return np.zeros(0, np.int64)
        both = self._both(self.bits[at]).sum(0, dtype=np.int64)
        return np.flatnonzero((100 * both >= percent * (len(query) + self.sizes - both)) & (both > 0))


def class_name(s: np.ndarray) -> int:
    """A hash of a whole set."""
    x = np.array([np.add.reduce(_mixed(s)), np.bitwise_xor.reduce(_mixed(s ^ _ODD)), len(s)], np.uint64)
    return int(_mixed(_mixed(_mixed(x[:1]) + x[1:2]) + x[2:])[0].view(np.int64))


def features(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """For each row: doc_id, text_hash, size of its set, its class (null without words), and the set's keys, if no earlier row of the task has that class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_hashes()
        seen: set[int] = set()
        for batch in small_batches(batches):
            size, node, held = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                s = shingles(text, n, known)
                size.append(len(s))
                node.append(class_name(s) if len(s) else None)
                new = doc_id is not None and len(s) and node[-1] not in seen
                if new:
                    if len(seen) >= SEEN_CLASSES:
                        seen.clear()
                    seen.add(node[-1])
                held.append(keys(s, percent) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(node, pa.int64()), pa.array(held, pa.list_(pa.int64()))], ["doc_id", "text_hash", "n_shingles", "node", "keys"]
            )

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, node long, keys array<long>")


def _in_order(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of key and node in order, without repeats; which of them have a key of several nodes, and which are the first of their key."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    first = np.append(True, key[1:] != key[:-1])[: len(key)]
    new = first | np.append(True, node[1:] != node[:-1])[: len(key)]
    key, node, first = key[new], node[new], first[new]
    alone = first & np.append(first[1:], True)[: len(key)]
    return key, node, ~alone, first


def _shared(leads: DataFrame) -> DataFrame:
    """key and node of the keys that several classes have; a pair may come twice. leads: node, keys.

    Keys cross the network once, packed by part. A task compares its own pairs first, KEYS_TOGETHER at a time: of each key one node goes to the key's
    part, and where a key has several nodes all of them go on as a part of their own. So a part has no more rows of a hot key than there are such lots.
    """
    total = leads.agg(F.sum(F.size("keys"))).first()[0] or 0
    parts = max(1, -(-total // KEYS_TOGETHER))

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key, node, n = [], [], 0
        for batch in small_batches(batches):
            lists = batch.column(1)
            key.append(lists.flatten().to_numpy(zero_copy_only=False))
            node.append(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)))
            n += len(key[-1])
            if n >= KEYS_TOGETHER:
                yield np.concatenate(key), np.concatenate(node)
                key, node, n = [], [], 0
        if n:
            yield np.concatenate(key), np.concatenate(node)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(part: list[int], of: list[np.ndarray]) -> pa.RecordBatch:
            columns = [pa.array(part, pa.int64()), *(pa.array([pairs[at].tobytes() for at in of], pa.binary()) for pairs in (key, node))]
            return pa.RecordBatch.from_arrays(columns, ["part", "keys", "nodes"])

        for key, node in lots(batches):
            key, node, several, first = _in_order(key, node)
            if several.any():
                own = np.add.reduce(_mixed((key[several] ^ node[several]).view(np.uint64)))
                yield rows([-1 - int(own >> np.uint64(1))], [several])
            key, node = key[first], node[first]
            part = (key.view(np.uint64) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            at, begin = np.unique(part[order], return_index=True)
            yield rows(at.tolist(), np.split(order, begin[1:]))

    def met(part: pa.Table) -> pa.Table:
        key, node = (np.frombuffer(b"".join(part[c].to_pylist()), np.int64) for c in ("keys", "nodes"))
        key, node, several, _ = _in_order(key, node)
        return pa.table({"key": key[several], "node": node[several]})

    return leads.mapInArrow(packed, "part long, keys binary, nodes binary").groupBy("part").applyInArrow(met, "key long, node long")


def components(links: DataFrame) -> DataFrame:
    """node and the smallest node that links lead to, for every node of links (u, v).

    Stars: each node's larger neighbours are tied to its smallest one, then its smaller ones are, in turn, until nothing changes.
    Each step is aggregated and joined by key; steps end in tables of the shared folder.
    """
    edges = written(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if not seen["n"] or (seen["n"], seen["x"]) == mark:
            break
        mark = (seen["n"], seen["x"])
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
        edges = written(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
    root = edges.groupBy("u").agg(F.min("v").alias("component"))
    return root.select(F.col("u").alias("node"), "component").unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _with_texts(names: DataFrame, docs: DataFrame) -> DataFrame:
    """node and text of classes with a representative (node, rep: a struct of doc_id and text_hash).

    Few documents are wanted, so a filter of the wanted ids, of a fixed size, goes to all tasks first: only what passes is shuffled and joined exactly.
    """
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_PARTS << 15))
    wanted = written(names.select("node", "rep.doc_id", "rep.text_hash", at(F.col("rep.doc_id")).alias("at")), "wanted")
    bits = wanted.groupBy((F.col("at") / (1 << 15)).cast("int").alias("filter_part")).agg(F.expr("bitmap_construct_agg(at % 32768)").alias("bits"))
    rows = docs.withColumn("at", at(F.col("doc_id"))).withColumn("filter_part", (F.col("at") / (1 << 15)).cast("int"))
    place = (F.col("at") % (1 << 15)).cast("int")
    octet = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = rows.join(F.broadcast(bits), "filter_part").withColumn("octet", octet).withColumn("bit", place % 8).filter("shiftright(octet, bit) % 2 = 1")  # FILTER_PARTS rows
    return rows.select("doc_id", "text_hash", "text").join(wanted.drop("at"), ["doc_id", "text_hash"]).select("node", "text")


def _built(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """The matrix: for each leader and part, the group's column, its members, and a forest of the links among them. rows: leader, part, node, text."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("node").sort_values("node", kind="stable")
        known = _word_hashes()
        sets = [shingles(t, n, known) for t in group["text"]]
        column, nodes = Group.of(sets), group["node"].to_numpy()
        links = column.links(percent)
        top = np.arange(len(nodes))
        while True:  # the smallest member that links lead to
            low = np.where(links, top, len(nodes)).min(1)
            if (low >= top).all():
                break
            top = np.minimum(top, low)
        tied = np.flatnonzero(top < np.arange(len(nodes)))
        return pd.DataFrame([(*key, column.tokens.tobytes(), column.bits.tobytes(), column.sizes, nodes, nodes[tied], nodes[top[tied]])], columns=["leader", "part", "tokens", "bits", "sizes", "nodes", "u", "v"])

    return rows.groupBy("leader", "part").applyInPandas(run, "leader long, part long, tokens binary, bits binary, sizes array<long>, nodes array<long>, u array<long>, v array<long>")


def _own_tokens(matrix: DataFrame) -> DataFrame:
    """node and own: how many tokens of a class no other class of the matrix holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for row in batch.to_pylist():
                tokens = np.frombuffer(row["tokens"], np.int64)
                bits = np.frombuffer(row["bits"], np.uint8).reshape(len(tokens), -1)
                for k in range(0, len(tokens), SLICE_TOKENS):
                    held = np.unpackbits(bits[k : k + SLICE_TOKENS], axis=1, count=len(row["nodes"]), bitorder="little")
                    holder = np.array(row["nodes"], np.int64)[held.argmax(1)]
                    yield pa.RecordBatch.from_arrays([pa.array(tokens[k : k + SLICE_TOKENS]), pa.array(holder, mask=held.sum(1) > 1)], ["token", "node"])

    rows = matrix.select("tokens", "bits", "nodes").mapInArrow(run, "token long, node long")
    alone = rows.groupBy("token").agg(F.count(F.lit(1)).alias("groups"), F.max("node").alias("node")).filter("groups = 1 and node is not null")
    return alone.groupBy("node").agg(F.count(F.lit(1)).alias("own"))


def _shares(nodes: DataFrame, matrix: DataFrame) -> DataFrame:
    """node and common: how many of a class's tokens other classes hold too; classes without such tokens are left out."""
    common = F.col("n_shingles") - F.coalesce("own", F.lit(0))
    return written(nodes.join(_own_tokens(matrix), "node", "left").filter(common > 0).select("node", common.alias("common")), "shares")


def _can_link(least_size: Column, most_common: Column, percent: int) -> Column:
    """Whether a class (n_shingles, common) can link with one of at least this size that has at most so many tokens in common with others.

    The intersection is no larger than either number of common tokens, and the other set has at least its size and the intersection.
    """
    both = F.least(F.col("common"), most_common)
    return 100 * both >= percent * (F.col("n_shingles") + F.greatest(least_size, both) - both)


def _apart(nodes: DataFrame, shares: DataFrame, shared: DataFrame, links: DataFrame, percent: int, targets: bool = False) -> DataFrame:
    """Keys of classes that meet a larger component there (of equal ones: that of the greater name), given the links so far.

    node, n_shingles, common, home (its group), size (its component's), and top, the key's group of the largest component where most tokens are common; or with
    targets, a row for each leader that has the key in PARTS_TOGETHER parts of its group, with bounds of what their members are like.
    """
    tied = components(links).select("node", "component")
    placed = written(nodes.join(shares, "node").join(tied, "node", "left").withColumn("component", F.coalesce("component", "node")), "placed")
    weight = placed.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    placed = placed.join(weight, "component").select("node", "n_shingles", "leader", "part", F.struct("members", "component").alias("size"), "common")
    held = shared.select("key", "node").join(written(placed, "sized"), "node")
    top = F.max(F.struct("size", (F.col("common") / F.col("n_shingles")).alias("share"), "leader", "part", "n_shingles", "common")).alias("top")
    bounds = [F.min("n_shingles").alias("small"), F.max("n_shingles").alias("large"), F.max("common").alias("most_common")]
    mixed = written(held.groupBy("key").agg(F.min("size").alias("least"), top, *bounds).filter("least < top.size").drop("least"), "mixed")
    held = written(held.join(mixed, "key").filter(_can_link(F.col("small"), F.col("most_common"), percent)).drop("small", "large", "most_common"), "held")
    asking = held.filter("size < top.size").select("key", "node", "n_shingles", F.struct("leader", "part").alias("home"), "size", "common", "top")
    if not targets:
        return asking
    groups = held.groupBy("key", "leader", "part").agg(F.max("size").alias("greatest"), *bounds)
    # Parts of a large group travel together: a class that meets many of them by many keys is one row for each key, and each of the two once after that.
    together = F.collect_list(F.struct("part", "greatest", "small", "large", "most_common")).alias("parts")
    packs = groups.groupBy("key", "leader", F.floor(F.col("part") / PARTS_TOGETHER).alias("pack")).agg(together)
    return asking.join(written(packs, "targets"), "key")


def _asked(asked: DataFrame, matrix: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (u, v) of classes with members of the stored groups that they ask. asked: leader, part, node."""

    def run(asking: pd.DataFrame, column: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        known = _word_hashes()
        for c in column.itertuples():
            sizes, tokens = np.asarray(c.sizes, np.int64), np.frombuffer(c.tokens, np.uint64)
            group = Group(tokens, np.frombuffer(c.bits, np.uint8).reshape(len(tokens), -1), sizes)
            nodes = np.asarray(c.nodes, np.int64)
            for node, text in zip(asking["node"], asking["text"], strict=True):
                out += [(int(node), int(i)) for i in nodes[group.linked(shingles(text, n, known), percent)]]
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    by = ["leader", "part"]
    pages = written(asked.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("pages")), "pages")
    queries = asked.join(pages, by).select(*by, F.pmod(F.xxhash64("node"), "pages").alias("page"), "node").join(texts, "node")
    opened = matrix.join(pages, by).select(*by, F.explode(F.sequence(F.lit(0), F.col("pages") - 1)).alias("page"), "tokens", "bits", "sizes", "nodes")
    return queries.groupBy(*by, "page").cogroup(opened.groupBy(*by, "page")).applyInPandas(run, "u long, v long")


def _components_of(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables: doc_id, n_shingles and class of each row; what classes with links or several rows are found in; what rows without words are found in by their id."""
    spark = docs.sparkSession
    with temporary(spark) as keep:  # keys are as large as the rest of the features and only lead to those that are shared
        featured = written(features(docs, n, percent), "features")
        shared = written(_shared(featured.filter("doc_id is not null and n_shingles > 0 and keys is not null").select("node", "keys")), "shared")
        known = written(featured.drop("keys"), "known")
        keep(shared, known)
    some = known.filter("doc_id is not null and n_shingles > 0")
    # Both sides of the joins below are tables or plain scans, so a hot class or key is split by Spark's skew handling.
    rep = F.min(F.struct("doc_id", "text_hash")).alias("rep")
    classes = written(some.groupBy("node").agg(rep, F.max("n_shingles").alias("n_shingles"), F.count(F.lit(1)).alias("rows")), "classes")

    # Groups: each class goes to the smallest one that it met; large groups are split, and each part gets the leader.
    low = written(shared.groupBy("key").agg(F.min("node").alias("low")), "keys")
    leader = written(shared.join(low, "key").groupBy("node").agg(F.min("low").alias("leader")), "leader")
    lead = written(leader.join(classes.select("node", "n_shingles", "rep"), "node"), "lead")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_ROWS), F.ceil(F.sum("n_shingles") / GROUP_TOKENS))
    counts = written(lead.groupBy("leader").agg(parts.alias("parts")), "parts")
    nodes = written(lead.join(counts, "leader").select("node", "n_shingles", "leader", F.pmod(F.xxhash64("node"), "parts").alias("part"), "parts"), "nodes")
    texts = written(_with_texts(lead.select("node", "rep"), docs), "texts")
    own = nodes.select("leader", "part", "node")
    leaders = nodes.filter("node = leader and parts > 1").select("leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node")
    matrix = written(_built(own.unionByName(leaders).distinct().join(texts, "node"), n, percent), "matrix")
    first = matrix.select(F.explode(F.arrays_zip("u", "v")).alias("x")).select("x.u", "x.v")
    shares = _shares(nodes, matrix)

    # Other groups. Near copies of one text often link with that text and not with one another: so each query first asks the group where each of its keys
    # meets the largest component, and only what is apart after that asks all others.
    by = ["leader", "part"]
    with temporary(spark) as keep:
        at = _apart(nodes, shares, shared, first, percent)
        asked = at.filter((F.col("home") != F.struct("top.leader", "top.part")) & _can_link(F.col("top.n_shingles"), F.col("top.common"), percent))
        asked = asked.select("top.leader", "top.part", "node").distinct()
        asked = written(asked, "asked")
        hubs = written(_asked(asked, matrix, texts, n, percent), "links")
        keep(asked, hubs)
    with temporary(spark) as keep:
        at = _apart(nodes, shares, shared, first.unionByName(hubs), percent, targets=True)

        def fits(g: Column) -> Column:
            """Whether the class may link with members of the part that its component lacks."""
            other = (g["greatest"] > F.col("size")) & (F.col("home") != F.struct(F.col("leader"), g["part"].alias("part")))
            return other & _can_link(g["small"], g["most_common"], percent) & (100 * g["large"] >= percent * F.col("n_shingles")) & (100 * F.col("n_shingles") >= percent * g["small"])

        at = at.select("leader", "pack", "node", F.transform(F.filter("parts", fits), lambda g: g["part"]).alias("parts")).filter("size(parts) > 0")
        at = at.groupBy("leader", "pack", "node").agg(F.array_distinct(F.flatten(F.collect_list("parts"))).alias("parts"))
        at = at.select("leader", F.explode("parts").alias("part"), "node")
        rest = written(at.join(asked, [*by, "node"], "left_anti"), "asked")
        more = written(_asked(rest, matrix, texts, n, percent), "links")
        keep(more)
    links = first.unionByName(hubs).unionByName(more)

    # Ids of rows with different sets tie these rows' classes.
    by_id = known.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("v"))
    repeated = written(by_id.filter("rows > 1 and v is not null").select("doc_id", "v"), "repeated")
    kin = some.select("doc_id", F.col("node").alias("u")).join(repeated, "doc_id").select("u", "v")
    final = written(components(links.unionByName(kin)).select("node", "component"), "components")
    named = classes.select("node", F.col("rep.doc_id").alias("rep"), "rows").join(final, "node", "left")
    least = named.filter("component is not null").groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.filter("rows > 1 or component is not null").join(written(least, "least"), "component", "left").select("node", F.coalesce("component_id", "rep").alias("found"))
    named = written(named, "named")
    # A row without words has the component of the other rows of its id.
    empty = written(repeated.join(named.select(F.col("node").alias("v"), "found"), "v").select("doc_id", F.col("found").alias("elsewhere")), "elsewhere")
    return known, named, empty


def linked_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: doc_id, n_shingles (size of its set), component_id (the smallest id that links lead to, itself included)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    with temporary(docs.sparkSession) as keep:
        known, named, empty = _components_of(docs, n, percent)
        keep(known, named, empty)
    return (
        known.select("doc_id", "n_shingles", "node")
        .join(named, "node", "left")
        .join(empty, "doc_id", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "elsewhere", "doc_id")).alias("component_id"))
    )
