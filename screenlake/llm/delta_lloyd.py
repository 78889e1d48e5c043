"""Centroid clustering by Lloyd's rounds over differences (operator 13).

Vectors of the wanted length become whole numbers, floor(scale * x). Their owners are kept in a table of the shared folder and the clusters' sums and sizes on the driver (a few
rows). A round compares a vector only with the centroids that moved since the last one, beside the distance from its own that is kept with it; a vector whose own centroid moved
is compared with all. Only vectors that change hands are aggregated then: what they take from one sum and bring to another, as signed whole numbers. When no centroid
moves any more, later rounds can't change anything and are left out. A round's table replaces the last one, which is deleted when the next is whole.

Seeds are the vectors with the smallest sha256 of "<salt>:<id>", nearest ones win, ties go to smaller numbers; empty centroids stay. Sums are exact: in 64 bits where they fit, else decimal.

Vectors of another length, null ones, and those with null or non-finite components take no part, nor do rows without an id. Rows that repeat an id are vectors of their own; a tie of
seeds goes to the least vector. With fewer vectors than clusters each one is a seed. Components are cut at 2**58, distances and inertia at the largest 64-bit number. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, scratch_path

MOST = 1 << 58  # of a component
NARROW = 1 << 25  # components within it have squared distances in 64 bits
LARGEST = (1 << 63) - 1
ROWS_TOGETHER = 4096


def _distances(x: np.ndarray, centroids: list[list[int]], which: list[int]) -> np.ndarray:
    """Squared distances of rows from some centroids, exact: of 64 bits, or Python's numbers where x has them."""
    out = np.empty((len(x), len(which)), x.dtype)
    for k, c in enumerate(which):
        d = x - np.array(centroids[c], x.dtype)
        out[:, k] = (d * d).sum(1)
    return out


def reassigned(x: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: list[list[int]], moved: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Owners and distances after the centroids in moved have moved. owner -1: not assigned yet. Ties go to smaller numbers."""
    owner, distance = owner.copy(), distance.copy()
    lost = np.isin(owner, [*moved, -1])
    if lost.any():
        d = _distances(x[lost], centroids, list(range(len(centroids))))
        owner[lost] = d.argmin(1)
        distance[lost] = d.min(1)
    if moved and not lost.all():
        held = np.flatnonzero(~lost)
        d = _distances(x[held], centroids, moved)
        near = d.argmin(1)  # moved is in order, so the smallest number of equal ones
        least, number = d[np.arange(len(held)), near], np.array(moved)[near]
        take = (least < distance[held]) | ((least == distance[held]) & (number < owner[held]))
        owner[held[take]], distance[held[take]] = number[take], least[take]
    return owner, distance


def clustered(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, salt: str = "3", id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """For each vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    sound = F.coalesce((F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))), F.lit(False))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.least(v * float(scale), F.lit(float(MOST))), F.lit(float(-MOST)))).cast("long"))
    rows = vectors.filter(F.col(id_col).isNotNull() & sound).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("x"))
    rows = rows.select("*", F.lit(-1).alias("owner"), F.lit(-1).alias("before"), F.lit(0).cast("long").alias("distance"))
    schema = rows.schema

    def saved(df: DataFrame, label: str) -> tuple[DataFrame, str]:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(schema).parquet(path), path

    table, path = saved(rows, "vectors")
    facts = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("most")).first()
    if not facts["n"]:
        return spark.createDataFrame([], out)
    exact = object if facts["most"] > NARROW else np.int64
    number = "long" if facts["n"] * facts["most"] < 1 << 62 else "decimal(20,0)"
    code = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    centroids = [list(r.x) for r in table.orderBy(code, "x").limit(clusters).select("x").collect()]
    sums, sizes = [[0] * dim for _ in centroids], [0] * len(centroids)

    def step(centroids: list[list[int]], moved: list[int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, len(batch), ROWS_TOGETHER):
                    part = batch.slice(at, ROWS_TOGETHER)
                    x = part.column("x").flatten().to_numpy().reshape(-1, dim).astype(exact)
                    owner = part.column("owner").to_numpy()
                    known = part.column("distance").to_numpy().astype(exact)
                    if exact is object:  # what is kept may be cut at 64 bits
                        for c in np.unique(owner[owner >= 0]):
                            known[owner == c] = _distances(x[owner == c], centroids, [int(c)])[:, 0]
                    now, distance = reassigned(x, owner, known, centroids, moved)
                    distance = np.minimum(distance, LARGEST).astype(np.int64)
                    columns = [part.column("vec_id"), part.column("x"), pa.array(now.astype(np.int32)), pa.array(owner), pa.array(distance)]
                    yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "owner", "before", "distance"])

        return run

    def transfers(table: DataFrame) -> list:
        """What each cluster gains: rows and components, signed. A row for each cluster."""
        gone = F.struct(F.col("before").alias("cluster"), F.lit(-1).alias("sign"))
        come = F.struct(F.col("owner").alias("cluster"), F.lit(1).alias("sign"))
        moves = table.filter("owner != before").select("x", F.explode(F.array(gone, come)).alias("m")).filter("m.cluster >= 0")
        each = [F.sum(F.element_at("x", k + 1).cast(number) * F.col("m.sign")).alias(f"x{k}") for k in range(dim)]
        return moves.groupBy("m.cluster").agg(F.sum("m.sign").alias("rows"), *each).collect()

    moved = list(range(len(centroids)))
    for r in range(rounds + 1):
        if r and not moved:
            break
        last, (table, path) = path, saved(table.mapInArrow(step(centroids, moved), schema), f"round-{r}")
        dropped(spark, last)
        if r == rounds:
            break
        for t in transfers(table):
            sizes[t["cluster"]] += t["rows"]
            sums[t["cluster"]] = [s + int(t[f"x{k}"]) for k, s in enumerate(sums[t["cluster"]])]
        after = [[s // sizes[c] for s in sums[c]] if sizes[c] else centroids[c] for c in range(len(centroids))]
        moved = [c for c in range(len(centroids)) if after[c] != centroids[c]]
        centroids = after

    inertia = {r["cluster"]: int(r["s"]) for r in table.groupBy(F.col("owner").alias("cluster")).agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    code = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    totals = [(c, min(inertia.get(c, 0), LARGEST), min(sum(inertia.values()), LARGEST), code[c]) for c in range(len(centroids))]
    totals = spark.createDataFrame(totals, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # a row for each cluster
    return table.select("vec_id", F.col("owner").alias("cluster"), "distance").join(F.broadcast(totals), "cluster").select(*[c.split()[0] for c in out.split(", ")])
