"""Approximate nearest neighbours by collision-counting hashing.

Nearness is the inner product. Every vector gets one more coordinate that brings all to the same length, so the
nearest by inner product is the nearest by distance. A hash is a single random projection; an index block keeps, for
each projection, its vectors sorted by their projected value. A query opens a window around its own projected value
in each of the arrays; the windows widen round by round (virtual rehashing: the same arrays serve every radius). A
vector that lies in the windows of at least ``threshold`` projections is verified: its inner product is computed
from the original vectors. A query is done in a block when its k-th best is nearer than the round's radius allows
unseen vectors to be, or when nothing is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored


@dataclass(frozen=True)
class Settings:
    """``projections`` arrays; a vector is verified at ``threshold`` collisions. The first window spans ``width``
    times the vectors' common length, each further one is ``growth`` times wider. A query stops in a block when its
    k-th best distance is at most ``stop`` times the round's radius, the distance at which a vector collides in as
    many projections as the threshold asks for on average. A vector at the k-th distance has then reached the threshold
    with a chance of about 0.98, nearer ones with a higher one (at ``stop`` 0.95 it would be 0.7)."""

    projections: int = 32
    threshold: int = 20
    width: float = 1.0
    growth: float = 1.2
    stop: float = 0.75
    seed: int = 5


class Block:
    """Sorted projection arrays over a block's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, s: Settings):
        self.ids, self.vectors, self.s, self.longest = ids, vectors, s, longest
        rng = np.random.default_rng([s.seed, vectors.shape[1]])
        self.directions = rng.standard_normal((vectors.shape[1] + 1, s.projections))
        extra = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(1), 0.0))
        projected = np.hstack([vectors, extra[:, None]]) @ self.directions / longest
        self.order = np.ascontiguousarray(np.argsort(projected, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(projected.T, self.order, 1)

    def nearest(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query its (ids, inner products) in the block, best first, ties to the smaller id."""
        s, n = self.s, len(self.ids)
        unit = queries / np.sqrt((queries ** 2).sum(1))[:, None]
        centre = unit @ self.directions[:-1]
        # share of projections in which vectors at distance r collide in a window of half-width h is about
        # P(|N(0, 1)| <= h / r); the radius of a round is where that meets the threshold
        z = _normal_quantile(0.5 + s.threshold / s.projections / 2)
        rounds = [s.width]
        while rounds[-1] < 4 * z:  # unit vectors are at most 2 apart
            rounds.append(rounds[-1] * s.growth)
        half = np.array(rounds) / 2
        # where each round's windows begin and end in the sorted arrays: (query, round, projection)
        low, high = (np.stack([np.searchsorted(self.sorted[j], centre[:, j, None] + sign * half, side)
                               for j in range(s.projections)], axis=2) for sign, side in ((-1, "left"), (1, "right")))
        scale = np.sqrt((queries ** 2).sum(1)) * self.longest
        return [self._nearest(queries[q], own[q], k, low[q], high[q], scale[q], half / z) for q in range(len(queries))]

    def _nearest(self, query: np.ndarray, own: int, k: int, low: np.ndarray, high: np.ndarray, scale: float,
                 radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One query's search; ``low`` and ``high`` bound its windows by round and projection."""
        s, n = self.s, len(self.ids)
        hits = np.zeros(n, dtype=np.int64)
        unseen = self.ids != own
        found, scores = np.empty(0, dtype=np.int64), np.empty(0)
        arrays = list(self.order)
        for r in range(len(radius)):
            if r == 0:
                parts = [o[a:b] for o, a, b in zip(arrays, low[0].tolist(), high[0].tolist())]
            else:
                parts = [o[a:b] for o, a, b in zip(arrays, low[r].tolist(), low[r - 1].tolist())]
                parts += [o[a:b] for o, a, b in zip(arrays, high[r - 1].tolist(), high[r].tolist())]
            hits += np.bincount(np.concatenate(parts), minlength=n)
            last = r == len(radius) - 1  # the widest windows: whatever hasn't collided often enough is verified too
            new = np.flatnonzero(unseen if last else (hits >= s.threshold) & unseen)
            if len(new):
                unseen[new] = False
                found, scores = np.r_[found, new], np.r_[scores, self.vectors[new] @ query]
            if len(found) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                if np.sqrt(max(0.0, 2 - 2 * kth / scale)) <= s.stop * radius[r]:
                    break
        if len(found) > k:  # with a margin for how products were rounded above; summed in order below
            found = found[scores >= np.partition(scores, len(scores) - k)[len(scores) - k] - 1e-9 * scale]
        scores = inner(self.vectors[found], query)
        best = np.lexsort((self.ids[found], -scores))[:k]
        return self.ids[found[best]], scores[best]


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each summed in the order of the components."""
    return np.add.accumulate(vectors * query, axis=1)[:, -1] if len(vectors) else np.empty(0)


def _normal_quantile(p: float) -> float:
    from statistics import NormalDist

    return NormalDist().inv_cdf(min(p, 1 - 1e-9))


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, dim, norm): vectors as doubles; null, empty and zero ones and those with null or non-finite
    components are left out, and so are rows without an id. Rows that repeat an id and vector count once."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
            .withColumn("norm", norm).withColumn("dim", F.size("v")).where("norm > 0").distinct())


def _search(k: int, settings: Settings):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": np.array([], "int64"), "vec_id": np.array([], "int64"), "score": []})
        block = Block(left["vec_id"].to_numpy(), np.stack(left["v"].to_list()).astype(float),
                      float(left["longest"].iloc[0]), settings)
        queries = right["query_id"].to_numpy()
        found = block.nearest(np.stack(right["query"].to_list()).astype(float), queries, k)
        return pd.DataFrame({"query_id": np.repeat(queries, [len(i) for i, _ in found]),
                             "vec_id": np.concatenate([i for i, _ in found]),
                             "score": np.concatenate([x for _, x in found])})[columns]
    return run


def nearest_neighbours(vectors: DataFrame, query_condition, k: int = 20, settings: Settings = Settings(),
                       block_rows: int = 8192, query_rows: int = 4096, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query, out of all rows but those of its id.

    ``query_condition`` is a column condition on ``vec_id``. Index blocks hold about ``block_rows`` vectors and
    queries come in blocks of about ``query_rows``; each pair of blocks is one bounded task, and each returns k rows
    per query at most. Vectors of another length than the query's are no candidates. An empty table, or one without
    valid vectors, gives an empty result; columns other than id and vector are not read."""
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(valid_vectors(vectors, id_col, vector_col), "vectors")
    asked = rows.where(query_condition)
    sizes = (rows.groupBy("dim").agg(F.max("norm").alias("longest"), F.count("*").alias("n"),
                                     F.sum(F.when(query_condition, 1).otherwise(0)).alias("q"))
             .select("dim", "longest", F.ceil(F.col("n") / block_rows).alias("blocks"),
                     F.greatest(F.lit(1), F.ceil(F.col("q") / query_rows)).alias("query_blocks")))

    def dealt(df: DataFrame, own: str, blocks: str, other: str, others: str) -> DataFrame:
        return (df.join(sizes, "dim")
                .withColumn(own, F.pmod(F.xxhash64(F.lit(own), "vec_id"), F.col(blocks)))
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))))

    index = dealt(rows, "block", "blocks", "query_block", "query_blocks")
    queries = dealt(asked, "query_block", "query_blocks", "block", "blocks").select(
        *(F.col(c).alias(f"q_{c}") for c in ("dim", "block", "query_block")), F.col("vec_id").alias("query_id"),
        F.col("v").alias("query"))
    key = ["dim", "block", "query_block"]
    found = (index.select(*key, "vec_id", "v", "longest").groupBy(*key)
             .cogroup(queries.groupBy(*(f"q_{c}" for c in key)))
             .applyInPandas(_search(k, settings), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
