"""Centroid clustering (Lloyd's rounds) over integer vectors, with a vantage-point tree over the centroids.

Each round the centroids are put into a vantage-point tree: a node's vantage point is one of its centroids, the
others are parted at the median distance from it, and both parts keep the range of their distances. The tree is
rebuilt and broadcast; it holds the centroids alone, whose number is a parameter. Every vector runs its own best-first
branch and bound: the open part with the least possible distance is next, and it ends when that is above the best
distance found. A part at exactly the best distance is still opened (with a margin for rounded roots), so a centroid of
equal distance and smaller number is never missed. Distances that decide are exact integers. A batch of vectors takes
its steps together, each on its own queue. Tasks add up their vectors per cluster before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

#: Components are below this in size, so that squared distances of 64 of them, and sums of them, fit 64 bits.
LIMIT = 1 << 26
#: Cells of a batch's queues.
_CELLS = 2_000_000
_MARGIN = 1e-9


@dataclass(frozen=True)
class Tree:
    """Nodes in an order where parents come first: the vantage centroid of each, and its children (-1: none) with the
    least and largest distance of their centroids from it."""

    centroids: np.ndarray
    vantage: np.ndarray
    child: np.ndarray  # (nodes, 2)
    least: np.ndarray
    most: np.ndarray


def build_tree(centroids: np.ndarray) -> Tree:
    """The vantage-point tree of integer centroids, one a row."""
    k = len(centroids)
    vantage, child = np.zeros(k, dtype=np.int64), np.full((k, 2), -1, dtype=np.int64)
    least, most = np.zeros((k, 2)), np.zeros((k, 2))
    todo, used = [(np.arange(k), -1, 0)], 0
    while todo:
        members, parent, side = todo.pop()
        node, used = used, used + 1
        if parent >= 0:
            child[parent, side] = node
        vantage[node] = members[0]
        rest = members[1:]
        away = np.sqrt(((centroids[rest] - centroids[members[0]]) ** 2).sum(1).astype(np.float64))
        by_distance = np.argsort(away, kind="stable")
        half = (len(rest) + 1) // 2
        for s, part in enumerate((by_distance[:half], by_distance[half:])):
            if len(part):
                least[node, s], most[node, s] = away[part[0]], away[part[-1]]
                todo.append((rest[np.sort(part)], node, s))
    return Tree(centroids, vantage, child, least, most)


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each integer vector, ties to the smaller number; and the distances computed."""
    rows = max(1, _CELLS // max(1, len(tree.vantage)))
    parts = [_nearest(tree, vectors[a:a + rows]) for a in range(0, len(vectors), rows)]
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), sum(p[2] for p in parts)


def _nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    n, nodes = len(vectors), len(tree.vantage)
    bound = np.full((n, nodes), np.inf)  # each vector's queue: the least possible distance of its open nodes
    bound[:, 0] = 0.0
    best = np.full(n, np.iinfo(np.int64).max)
    which = np.full(n, -1, dtype=np.int64)
    active, computed = np.arange(n), 0
    while len(active):
        node = bound[active].argmin(1)
        open_ = bound[active, node]
        # inclusive: a part at the best distance may hold a smaller number
        on = (open_ < np.inf) & (open_ <= np.sqrt(best[active].astype(np.float64)) * (1 + _MARGIN) + _MARGIN)
        active, node, open_ = active[on], node[on], open_[on]
        if not len(active):
            break
        bound[active, node] = np.inf
        centre = tree.vantage[node]
        distance = ((vectors[active] - tree.centroids[centre]) ** 2).sum(1)
        computed += len(active)
        better = (distance < best[active]) | (distance == best[active]) & (centre < which[active])
        best[active[better]], which[active[better]] = distance[better], centre[better]
        away = np.sqrt(distance.astype(np.float64))
        for side in (0, 1):
            child = tree.child[node, side]
            has = child >= 0
            low = np.maximum(tree.least[node, side] - away, away - tree.most[node, side])[has]
            slack = _MARGIN * (1 + away[has])  # rounding of the roots never closes a part too early
            bound[active[has], child[has]] = np.maximum(open_[has], low - slack)
    return which, best, computed


def integer_vectors(vectors: DataFrame, dim: int, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors of exactly ``dim`` components, none null or not finite, as integers floor(scale * x).
    A component that gives ``LIMIT`` or more in size is an error, as distances would no longer be exact."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def whole(c: Column) -> Column:
        return F.when(F.abs(c * scale) < LIMIT - 1, F.floor(c * scale).cast("int")).otherwise(F.raise_error(
            F.concat(F.lit("component too large for exact distances: "), c.cast("string"))).cast("int"))

    kept = (vectors.select(F.col(id_col).alias("vec_id"), x.alias("x"))
            .where(F.col("x").isNotNull() & (F.size("x") == dim) & finite))
    return kept.select("vec_id", F.transform("x", whole).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest digests of ``<seed>:<id>``, in that order (then by id and components)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    top = rows.select(digest.alias("digest"), "v").orderBy("digest", "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in top], dtype=np.int64)


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dim)


def _partial_sums(tree, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tree.value
        k = len(t.centroids)
        sums, counts = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for b in batches:
            if b.num_rows:
                v = _matrix(b, dim)
                which, _, _ = nearest(t, v)
                order = np.argsort(which, kind="stable")
                held, first = np.unique(which[order], return_index=True)
                sums[held] += np.add.reduceat(v[order], first, axis=0)
                counts += np.bincount(which, minlength=k)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(held, pa.int32()), "n": counts[held],
                                          "sums": pa.array(sums[held].tolist(), pa.list_(pa.int64()))})
    return run


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: vectors to their nearest centroid, and each centroid to floor(sum / count) of its vectors; one
    without vectors stays. Tasks hand on a row per cluster, and the driver a row per cluster of them all."""
    k, dim = centroids.shape
    tree = rows.sparkSession.sparkContext.broadcast(build_tree(centroids))
    partial = rows.select("v").mapInArrow(_partial_sums(tree, dim), "cluster int, n long, sums array<long>")
    total = partial.groupBy("cluster").agg(F.sum("n").alias("n"),
                                           F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(dim)]).alias("sums"))
    out = centroids.copy()
    for r in total.collect():  # at most k rows
        out[r["cluster"]] = np.array(r["sums"], dtype=np.int64) // r["n"]
    tree.unpersist()
    return out


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of (vec_id, v)."""
    tree, dim = rows.sparkSession.sparkContext.broadcast(build_tree(centroids)), centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                which, distance, _ = nearest(tree.value, _matrix(b, dim))
                yield pa.RecordBatch.from_pydict({"vec_id": b.column("vec_id"), "cluster": pa.array(which, pa.int32()),
                                                  "distance": distance})

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0, seed: int = 1,
             id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, of another length, or hold null or non-finite components are left out; zero vectors stay.
    Repeated rows are vectors each, null ids are kept, equal distances go to the smaller cluster number. Fewer than
    ``k`` kept vectors give as many centroids; without any the result is empty; other columns are not read."""
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(integer_vectors(vectors, dim, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in
                           ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids)
    assigned = stored(assign(rows, centroids), "clusters")
    per_cluster = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(
        F.sum("distance").alias("inertia")).collect()}  # at most k rows
    sums = spark.createDataFrame(
        [(c, per_cluster.get(c, 0), sum(per_cluster.values()),
          hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c in range(len(centroids))],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(sums), "cluster").select(  # a row per cluster
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
