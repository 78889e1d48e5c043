"""Near duplicates among embeddings by an inverted multi-index (operator 11).

Index: vectors are cut into halves, and each half has a codebook of its own, fitted on a bounded sample (SAMPLE_ROWS, SAMPLE_VALUES); the nearest codes (i, j) of a
vector's halves are its cell of the product grid. A label's grid rows i are cut into groups and those into parts of about BLOCK_ROWS vectors, a row of binary columns each.

Search: a vector's sequence of cells goes by the sum of both halves' squared distances beyond those of its own cell. It ends at `reach`, the sum at which the wanted
share of partners has been met. The hardest partners are those at the threshold itself, so reach is set by random partners of just that cosine, made for the vectors of the
sample; nearer ones are met more often. Cells that the bisecting planes of the codes rule out are passed over. A block ships those of its vectors that visit a group to that group,
where cosines in double precision decide. A pair that both sides visit counts on one side.

Equal vectors of a label are one class with a number of copies, so copies cost nothing and lose no link. Links leave a task as numbers of links and a forest, never as pairs.

Vectors that are null, empty, all zero or hold a null or a non-finite component, a null label or a null id link with nothing; a row without an id has a null component and is kept.
Vectors of different lengths link with nothing of one another. Rows that repeat an id are vectors of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .jaccard_join import components

SAMPLE_ROWS = 8192
SAMPLE_VALUES = 1 << 22  # of the sample's components
MOST_CODES = 256  # of a half
CELL_ROWS = 48  # vectors for each cell of the grid, about, until the codes are MOST_CODES
PAIR_SAMPLE = 2048  # vectors that reach is set by
BLOCK_ROWS = 8192
SLICE = 1 << 20  # cosines at a time


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision; a power of two keeps their squares within range."""
    x = x.astype(np.float64)
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _squares(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ codes.T + (codes * codes).sum(1)


def _codebook(x: np.ndarray, count: int) -> np.ndarray:
    """At most count codes by a few rounds of Lloyd's."""
    codes = x[np.linspace(0, len(x) - 1, count).astype(int)]
    for _ in range(8):
        near = _squares(x, codes).argmin(1)
        size = np.bincount(near, minlength=len(codes))
        total = np.zeros_like(codes)
        np.add.at(total, near, x)
        codes = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], codes)
    return codes


@dataclass
class Grid:
    """Codebooks of both halves of vectors of one length, and how far a vector's sequence of cells goes."""

    first: np.ndarray
    second: np.ndarray
    reach: float
    cosine: float

    @classmethod
    def fitted(cls, x: np.ndarray, codes: int, cosine: float, recall: float) -> Grid:
        """x: unit vectors."""
        at = x.shape[1] - x.shape[1] // 2
        count = max(1, min(codes, len(x) // 8))
        grid = cls(_codebook(x[:, :at], count), _codebook(x[:, at:], count), 0.0, cosine)
        some = x[:PAIR_SAMPLE]
        aside = np.random.default_rng(11).standard_normal(some.shape)
        aside -= (aside * some).sum(1, keepdims=True) * some
        length = np.sqrt((aside * aside).sum(1, keepdims=True))
        partner = cosine * some + np.sqrt(max(0.0, 1 - cosine * cosine)) * aside / np.where(length > 0, length, 1)
        a, b = grid.beyond(some), grid.beyond(partner)
        here, there = grid.cells(some), grid.cells(partner)
        k = np.arange(len(some))
        met = np.minimum(a[0][k, there[0]] + a[1][k, there[1]], b[0][k, here[0]] + b[1][k, here[1]])
        grid.reach = float(np.quantile(met, recall)) + 1e-9 if len(met) else 0.0
        return grid

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = x.shape[1] - x.shape[1] // 2
        return _squares(x[:, :at], self.first), _squares(x[:, at:], self.second)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.halves(x)
        return a.argmin(1), b.argmin(1)

    def beyond(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector and code, the squared distance beyond the nearest one's; infinite where no partner can lie behind the bisecting plane."""
        out = []
        for codes, d in zip((self.first, self.second), self.halves(x), strict=True):
            near = d.argmin(1)
            more = d - d.min(1, keepdims=True)
            apart = np.sqrt(np.maximum(_squares(codes, codes), 0))[near]
            plane = np.divide(more, 2 * apart, out=np.zeros_like(more), where=apart > 1e-9)
            out.append(np.where(plane * plane > 2 - 2 * self.cosine + 1e-6, np.inf, more))
        return out[0], out[1]


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label, the least index of each index's component so far, after the links a to b."""
    while True:
        low = np.minimum(label[a], label[b])
        to = np.arange(len(label))
        np.minimum.at(to, label[a], low)
        np.minimum.at(to, label[b], low)
        while not np.array_equal(to, to[to]):
            to = to[to]
        if np.array_equal(to[label], label):
            return label
        label = to[label]


def verified(grid: Grid, asked: dict, block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes with links among the vectors that ask and a block's, their numbers of links, and a node that each one is tied to.

    asked and block: node, copies, cell (i and j in columns), x (unit vectors); the block's rows lie in order of their cells.
    """
    q, x = asked["x"], block["x"]
    a1, a2 = grid.beyond(q)
    b1, b2 = grid.beyond(x)
    links_a, links_b = np.zeros(len(q), np.int64), np.zeros(len(x), np.int64)
    label = np.arange(len(q) + len(x))
    cell = block["cell"]
    starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(1)]) if len(x) else np.array([], int)
    for begin, end in zip(starts, np.r_[starts[1:], len(x)], strict=True):
        i, j = cell[begin]
        who = np.flatnonzero(a1[:, i] + a2[:, j] <= grid.reach)
        step = max(1, SLICE // (end - begin))
        for at in range(0, len(who), step):
            some = who[at : at + step]
            a, b = np.nonzero(q[some] @ x[begin:end].T >= grid.cosine)
            a, b = some[a], b + begin
            own, other = asked["cell"][a], cell[b]
            visited = b1[b, own[:, 0]] + b2[b, own[:, 1]] <= grid.reach
            first = (own[:, 0] < other[:, 0]) | ((own[:, 0] == other[:, 0]) & ((own[:, 1] < other[:, 1]) | ((own[:, 1] == other[:, 1]) & (asked["node"][a] < block["node"][b]))))
            take = (~visited | first) & (asked["node"][a] != block["node"][b])
            a, b = a[take], b[take]
            np.add.at(links_a, a, block["copies"][b])
            np.add.at(links_b, b, asked["copies"][a])
            label = joined(label, a, b + len(q))
    node, links = np.r_[asked["node"], block["node"]], np.r_[links_a, links_b]
    has = links > 0
    return node[has], links[has], node[label[has]]


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.93, recall: float = 0.99, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """For each row: vec_id, n_links (other vectors of its label with at least this cosine), component_id (the smallest id that links lead to), kept (it is its own).

    recall: the share of partners at the threshold itself that the search is to meet.
    """
    spark = vectors.sparkSession
    kind = "double" if dict(vectors.dtypes)[vec_col] == "array<double>" else "float"
    if dict(vectors.dtypes)[vec_col] not in ("array<double>", "array<float>"):
        kind = "double"
    x = F.transform(F.col(vec_col), lambda v: v.cast(kind) + F.lit(0.0).cast(kind))  # no negative zeros
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    sound = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("x", lambda v: v != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), x.alias("x"))
    name = [F.when(sound, F.xxhash64("label", "x")).alias("h1"), F.when(sound, F.xxhash64(F.lit(1), "x", "label")).alias("h2")]
    rows = rows.select("vec_id", "label", "x", *name)

    # Classes of equal vectors; nodes are numbered as the table is written.
    classes = rows.filter("h1 is not null").groupBy("label", "h1", "h2").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("rep"))
    classes = written(classes.select("*", F.size("x").alias("dim"), F.monotonically_increasing_id().alias("node")), "classes")
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    codes = max(1, min(MOST_CODES, int((facts["n"] / CELL_ROWS) ** 0.5)))
    sample: dict[int, list] = {}
    for r in classes.orderBy("h1", "h2").limit(max(1, min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, facts["dim"] or 1)))).select("x").collect():
        sample.setdefault(len(r.x), []).append(r.x)
    grids = {d: Grid.fitted(_scaled(np.array(some)), codes, cosine, recall) for d, some in sample.items()}

    def grid(dim: int) -> Grid:
        """Lengths that the sample misses have a grid of one cell."""
        return grids.get(dim) or Grid(np.zeros((1, dim - dim // 2)), np.zeros((1, dim // 2)), 0.0, cosine)

    # Groups of grid rows, by the number of vectors of the label and length.
    sizes = classes.groupBy("label", "dim").agg(F.least(F.lit(codes), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS)).cast("int").alias("groups"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim in np.unique(dims := batch.column("dim").to_numpy()):
                some = batch.filter(pa.array(dims == dim))
                i, j = grid(int(dim)).cells(_scaled(_matrix(some.column("x"))))
                group = i * some.column("groups").to_numpy() // max(1, len(grid(int(dim)).first))
                more = [pa.array(c.astype(np.int32)) for c in (group, i, j)]
                yield pa.RecordBatch.from_arrays([some.column(c) for c in ("label", "dim", "groups", "node", "copies", "x")] + more, ["label", "dim", "groups", "node", "copies", "x", "group", "i", "j"])

    kept = f"label string, dim int, groups int, node long, copies long, x array<{kind}>"
    placed = written(classes.join(sizes, ["label", "dim"]).select("label", "dim", "groups", "node", "copies", "x").mapInArrow(place, kept + ", group int, i int, j int"), "placed")
    parts = written(placed.groupBy("label", "dim", "group").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("parts")), "parts")
    key = ["label", "dim", "group", "part"]
    schema = "label string, dim int, group int, part int, groups int, nodes binary, copies binary, cells binary, vectors binary"

    def pack(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        i, j = batch.column("i").to_numpy(), batch.column("j").to_numpy()
        order = np.lexsort((batch.column("node").to_numpy(), j, i))
        take = lambda c: np.ascontiguousarray(c[order]).tobytes()
        first = {c: batch.column(c).slice(0, 1) for c in (*key, "groups")}
        numbers = {"nodes": batch.column("node").to_numpy(), "copies": batch.column("copies").to_numpy(), "cells": np.column_stack([i, j]), "vectors": _matrix(batch.column("x"))}
        return pa.table(first | {k: pa.array([take(v)], pa.binary()) for k, v in numbers.items()})

    part = F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part")
    blocks = written(placed.join(parts, ["label", "dim", "group"]).select("*", part).drop("parts").groupBy(*key).applyInArrow(pack, schema), "blocks")

    def opened(row: dict, kinds: type) -> dict:
        x = np.frombuffer(row["vectors"], kinds).reshape(-1, row["dim"])
        return {"node": np.frombuffer(row["nodes"], np.int64), "copies": np.frombuffer(row["copies"], np.int64), "cell": np.frombuffer(row["cells"], np.int32).reshape(-1, 2), "raw": x}

    number = np.float64 if kind == "double" else np.float32
    ask_schema = "label string, dim int, group int, nodes_asked binary, copies_asked binary, cells_asked binary, vectors_asked binary"

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for k in range(len(batch)) for r in batch.slice(k, 1).to_pylist()):
            own, g = opened(row, number), grid(row["dim"])
            near = g.beyond(_scaled(own["raw"]))[0] <= g.reach
            to = np.arange(near.shape[1]) * row["groups"] // near.shape[1]
            for group in np.unique(to[near.any(0)]):
                who = np.flatnonzero(near[:, to == group].any(1))
                packed = [own[c][who].tobytes() for c in ("node", "copies", "cell", "raw")]
                head = [pa.array([row["label"]], pa.string()), pa.array([row["dim"]], pa.int32()), pa.array([group], pa.int32())]
                yield pa.RecordBatch.from_arrays([*head, *[pa.array([p], pa.binary()) for p in packed]], [c.split()[0] for c in ask_schema.split(", ")])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for k in range(len(batch)) for r in batch.slice(k, 1).to_pylist()):
            block = opened(row, number)
            mine = opened({"dim": row["dim"]} | {c: row[f"{c}_asked"] for c in ("nodes", "copies", "cells", "vectors")}, number)
            node, links, to = verified(grid(row["dim"]), mine | {"x": _scaled(mine["raw"])}, block | {"x": _scaled(block["raw"])})
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (node, links, to)], ["node", "links", "tied"])

    asked = blocks.mapInArrow(asks, ask_schema).join(parts, ["label", "dim", "group"])
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).drop("parts")
    found = written(asked.join(blocks, key).mapInArrow(verify, "node long, links long, tied long"), "found")

    # Numbers of links and components by class, and from there to the rows.
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    ends = written(components(found.select(F.col("node").alias("u"), F.col("tied").alias("v"))), "components")
    linked = classes.join(links, "node", "left").filter("copies > 1 or links is not null").join(ends, "node", "left")
    linked = written(linked.select("label", "h1", "h2", "rep", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")), "linked")
    least = linked.filter("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    named = linked.join(least, "component", "left").select("label", "h1", "h2", "links", F.coalesce("least", "rep").alias("found"))
    own = F.coalesce("found", "vec_id")
    return (
        rows.select("vec_id", "label", "h1", "h2")
        .join(named, ["label", "h1", "h2"], "left")
        .select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"))
    )
