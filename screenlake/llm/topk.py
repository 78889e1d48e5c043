"""Exact top-k search by inner product with a pivot-distance index (operator 1).

Components are turned into integers, floor(scale * x). A vector gets one more coordinate, sqrt(M - |x|^2) for the greatest squared length M, and
a query gets 0; then the squared distance is M + |q|^2 - 2 q.x, so the nearest vectors are those of the greatest inner product.

Index: every vector is keyed by its nearest pivot and its distance from it; a pivot's vectors are cut into annuli at quantiles of that
distance, and an annulus into blocks of about BLOCK_ROWS, each sorted by distance. Search: a query first opens
one block of the annuli around it, nearest first, until it has k scores, which bound its k-th distance. Then it opens every annulus that
the triangle inequality can't rule out, |d(q, p) - d(x, p)| <= bound, and within a block only the rows of that range of distances.

Pivots are fitted on a bounded sample (SAMPLE_ROWS); every vector is indexed. Queries travel in packs, one to a block that they need. Where
nothing is ruled out, that is every pack to every block: packs and blocks are shuffled and merged, never broadcast, and integers travel in as few bytes as the greatest needs.

Vectors that are null, hold a null or a non-finite component, or have a null id take no part. Shorter vectors count as filled up with zeros.
Equal scores go to smaller ids; rows that repeat an id are candidates of their own, but never for a query of that id, and a repeated query is asked
once (its least vector). Components and scores beyond 64 bits saturate; where they may, or where squares are too large for exact bounds, a query opens more annuli than it would need, up to all of them. An empty table gives an empty result. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SAMPLE_ROWS = 4096
PIVOTS = 16
ANNULI = 8
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
MOST_QUERY_ROWS = 1280  # of a pack: several tasks deal them out in turn, so sizes differ a little
LEAST = -(1 << 63)
CUT = float(1 << 62)
ROUNDING = 1e-12  # of sums of squares, relative to their terms


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Centres of the sample by a few rounds of k-means from its first rows."""
    centres = np.unique(sample[:count], axis=0)
    for _ in range(6):
        near = ((sample**2).sum(1)[:, None] - 2 * sample @ centres.T + (centres**2).sum(1)).argmin(1)
        centres = np.stack([sample[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))])
    return centres


def _padded(lists: list, dim: int, kind: np.dtype | type = np.int64) -> np.ndarray:
    out = np.zeros((len(lists), dim), kind)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: by floats where they are exact, else by 64-bit integers, else by Python's, cut to 64 bits."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.vectorize(lambda v: max(LEAST, min(-LEAST - 1, v)), otypes=[np.int64])(exact)


def _distances(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of lifted rows from pivots."""
    return np.sqrt((((x[:, None, :] - pivots[None, :, :-1]) ** 2).sum(2)) + (lift[:, None] - pivots[None, :, -1]) ** 2)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k greatest integer inner products of each query with rows of other ids."""
    spark = vectors.sparkSession

    def whole(df: DataFrame) -> DataFrame:
        x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
        sound = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))
        return df.filter(F.col(id_col).isNotNull() & sound).select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.transform(x, lambda v: F.floor(F.greatest(F.least(v * float(scale), F.lit(9.2e18)), F.lit(-9.2e18))).cast("long")).alias("q"),
        )

    rows = whole(vectors)
    length = F.aggregate("q", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    widest = F.coalesce(F.max(F.aggregate("q", F.lit(0).cast("long"), lambda s, v: F.greatest(s, F.abs(v)))), F.lit(0)).alias("widest")
    narrow = lambda r: np.min_scalar_type(-r["widest"] - 1)
    facts = rows.agg(F.max(length).alias("m"), F.max(F.size("q")).alias("dim"), F.count(F.lit(1)).alias("n"), widest).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top, dim, kind = float(facts["m"]), max(1, facts["dim"]), narrow(facts)
    lifted = lambda x: np.sqrt(np.maximum(0.0, top - (x.astype(float) ** 2).sum(1)))
    sample = _padded([r.q for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect()], dim)
    pivots = _pivots(np.column_stack([sample, lifted(sample)]).astype(float), PIVOTS)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                x = _padded(part.column(1).to_pylist(), dim)
                d = _distances(x, lifted(x), pivots)
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(x)), near])], ["vec_id", "q", "pivot", "distance"]
                )

    keyed = written(rows.mapInArrow(key, "vec_id long, q array<long>, pivot int, distance double"), "keyed")
    cuts = [i / ANNULI for i in range(1, ANNULI)]
    bounds = keyed.groupBy("pivot").agg(F.percentile_approx("distance", F.array(*map(F.lit, cuts)), 2000).alias("cuts"))
    annulus = (F.col("pivot") * ANNULI + F.size(F.filter("cuts", lambda c: c < F.col("distance")))).cast("int")
    placed = keyed.join(F.broadcast(bounds), "pivot").select("vec_id", "q", "pivot", "distance", annulus.alias("annulus"))  # a row for each pivot
    sizes = placed.groupBy("annulus").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))  # PIVOTS * ANNULI rows at most

    def pack(name: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["distance", "vec_id"])
        d = rows["distance"].to_numpy()
        return pd.DataFrame(
            [(name[0], name[1], rows["pivot"].iloc[0], len(rows), d[0], d[-1], rows["vec_id"].to_numpy().tobytes(), d.tobytes(), _padded(list(rows["q"]), dim, kind).tobytes())],
            columns=["annulus", "block", "pivot", "n", "low", "high", "ids", "distances", "vectors"],
        )

    index = written(
        placed.join(F.broadcast(sizes), "annulus")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.col("blocks")).cast("int"))
        .groupBy("annulus", "block")
        .applyInPandas(pack, "annulus int, block int, pivot int, n long, low double, high double, ids binary, distances binary, vectors binary"),
        "index",
    )
    rings = (
        index.groupBy("annulus", "pivot")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("block").alias("last"), F.max(F.struct("n", "block")).alias("seed"))
        .select("annulus", "pivot", "low", "high", "last", "seed.n", "seed.block")
        .toPandas()
        .sort_values("annulus")
    )

    asked = written(whole(queries).groupBy("vec_id").agg(F.min("q").alias("q")), "queries")
    facts = asked.agg(F.count(F.lit(1)).alias("n"), widest).first()
    packs, asked_kind = max(1, -(-facts["n"] // QUERY_ROWS)), narrow(facts)

    def requests(first: bool):
        """Packs of the queries that need a block, with the score that each has already."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                step = max(1, -(-len(batch) // max(1, -(-len(batch) // MOST_QUERY_ROWS))))
                for start in range(0, len(batch), step):
                    part = batch.slice(start, step)
                    ids, x = part.column(0).to_numpy(), _padded(part.column(1).to_pylist(), dim)
                    d = _distances(x, np.zeros(len(x)), pivots)[:, rings["pivot"].to_numpy()]
                    gap = np.maximum(0.0, np.maximum(d - rings["high"].to_numpy(), rings["low"].to_numpy() - d))
                    if first:
                        order = np.argsort(gap, axis=1, kind="stable")
                        before = np.cumsum(rings["n"].to_numpy()[order], axis=1) - rings["n"].to_numpy()[order]
                        need = np.zeros(gap.shape, bool)
                        np.put_along_axis(need, order, before <= k, axis=1)
                        had, reach = np.full(len(x), LEAST), np.full(len(x), np.inf)
                    else:
                        had = part.column(2).to_numpy()
                        own = (x.astype(float) ** 2).sum(1)
                        squared = top + own - 2 * had.astype(float)
                        # What rounding may do to the terms that cancel out; and scores that may be cut at 64 bits bound nothing.
                        slack = ROUNDING * (top + own + 2 * np.abs(had.astype(float)))
                        reach = np.where((had > LEAST) & (np.sqrt(top * own) < CUT), np.sqrt(np.maximum(0, squared) + slack) * (1 + 1e-7) + 1e-3 + np.sqrt(ROUNDING * top), np.inf)
                        need = gap <= reach[:, None]
                    for r, ring in enumerate(rings.itertuples()):
                        who = np.flatnonzero(need[:, r])
                        if not len(who):
                            continue
                        for block in [ring.block] if first else range(ring.last + 1):
                            yield pa.RecordBatch.from_pydict(
                                {
                                    "annulus": pa.array([ring.annulus], pa.int32()), "block": pa.array([block], pa.int32()), "ids_asked": [ids[who].tobytes()], "asked": [x[who].astype(asked_kind).tobytes()],
                                    "had": [had[who].astype(np.int64).tobytes()], "from_pivot": [d[who, r].tobytes()], "reach": [reach[who].tobytes()],
                                }
                            )

        return run

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                row = batch.slice(n, 1).to_pylist()[0]
                ids, d = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["distances"], float)
                x = np.frombuffer(row["vectors"], kind).reshape(-1, dim).astype(np.int64)
                mine, q = np.frombuffer(row["ids_asked"], np.int64), np.frombuffer(row["asked"], asked_kind).reshape(-1, dim).astype(np.int64)
                had, from_pivot, reach = np.frombuffer(row["had"], np.int64), np.frombuffer(row["from_pivot"], float), np.frombuffer(row["reach"], float)
                low, high = np.searchsorted(d, from_pivot - reach, "left"), np.searchsorted(d, from_pivot + reach, "right")
                if not (high > low).any():
                    continue
                begin, end = int(low.min()), int(high.max())
                scores = _products(q, x[begin:end])
                out: tuple[list, list, list] = ([], [], [])
                for i in range(len(q)):
                    own = slice(int(low[i]) - begin, max(int(low[i]), int(high[i])) - begin)
                    s, names = scores[i, own], ids[begin:end][own]
                    good = np.flatnonzero((s >= had[i]) & (names != mine[i]))
                    if len(good) > k:
                        good = good[np.lexsort((names[good], -np.unique(s[good], return_inverse=True)[1]))[:k]]  # whole numbers, so equal ones are equal
                    out[0].extend([mine[i]] * len(good))
                    out[1].extend(names[good])
                    out[2].extend(s[good])
                yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in out], ["query_id", "vec_id", "score"])

    wanted = "annulus int, block int, ids_asked binary, asked binary, had binary, from_pivot binary, reach binary"

    def scores(from_: DataFrame, first: bool) -> DataFrame:
        # The planner knows nothing of how large a pack is and would send all of them through the driver.
        sent = from_.repartition(packs).mapInArrow(requests(first), wanted)
        return sent.hint("merge").join(index, ["annulus", "block"]).mapInArrow(answer, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    seeds = scores(asked, True).withColumn("place", F.row_number().over(best)).filter(F.col("place") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("had"))
    bounded = written(asked.join(seeds, "vec_id", "left").select("vec_id", "q", F.coalesce("had", F.lit(LEAST)).alias("had")), "bounded")
    return (
        scores(bounded, False)
        .withColumn("rank", F.row_number().over(best).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
