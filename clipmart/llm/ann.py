"""Approximate nearest neighbours by collision-counting hashing.

Vectors are projected on ``PROJECTIONS`` random lines and each line keeps its
values as one sorted array.  A query opens a window around its own value on
every line and widens all windows by the same factor, the last time only as far
as the k-th best asks for (virtual rehashing: a wider window is a coarser hash
of the same array).  A vector in the windows of
at least ``threshold()`` lines is verified: its exact inner product is
computed.  A query stops once its windows are ``WIDTH`` times as wide as its
k-th best distance; a vector at least that near then lies in each window with
probability ``chance()``, so few are missed.  Otherwise it goes on until every
vector is verified: there is no cap on candidates.

The largest inner product becomes the smallest distance by one more
coordinate, which brings all vectors to the length of the longest.

Queries are the vectors whose id is divisible by ``QUERY_EVERY``.  They meet
all vectors in blocks: a cell holds at most about ``BLOCK`` vectors and
``QUERIES`` queries, works alone and gives its best k per query; the best of
all cells are the answer.

Defined cases: vectors that are null, empty or zero or hold a null or
non-finite component, and rows with a null id, take no part; rows that share an
id, or all they hold, are candidates (and queries) like others, and a query leaves
out its own row only; a query meets only vectors of its own length; equal scores are
ordered by id; with fewer than k candidates all are returned.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipmart.llm.common import only, staged

K, QUERY_EVERY = 20, 20
PROJECTIONS, SEED = 64, 4
WIDTH = 1.0  # half a window in multiples of the distance that it must find
SURE = 2.0  # standard deviations by which a near vector may fall short of its expected collisions
GROWTH = 1.2  # of the windows from one round to the next
BLOCK, QUERIES = 8192, 1024


def chance() -> float:
    """That a vector at a distance lies in a window of half that width on one line, times WIDTH."""
    return math.erf(WIDTH / math.sqrt(2))


def threshold() -> int:
    p = chance()
    return max(1, math.floor(PROJECTIONS * p - SURE * math.sqrt(PROJECTIONS * p * (1 - p))))


class Index:
    """The sorted arrays of one block."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, longest: float):
        self.ids, self.rows, self.vectors, self.longest = ids, rows, vectors, longest
        rest = np.sqrt(np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        rng = np.random.default_rng(SEED)
        self.lines = rng.standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        values = (vectors @ self.lines[:-1] + rest[:, None] * self.lines[-1]).T
        self.order = np.argsort(values, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(values, self.order, axis=1)
        # each vector's place on each line, narrow so that a whole window is counted by a few wide instructions
        self.places = np.empty(self.order.shape, np.uint16 if len(ids) < 2**16 else np.uint32)
        np.put_along_axis(self.places, self.order, np.arange(len(ids), dtype=self.places.dtype)[None, :], axis=1)

    def collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """On how many lines each vector stands in the window from place ``low``
        up to ``high``.  Places before the window wrap round to large numbers."""
        kind = self.places.dtype
        return ((self.places - low.astype(kind)[:, None]) < (high - low).astype(kind)[:, None]).sum(0, dtype=np.int16)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best per query, its ``own`` row left out."""
        at = queries @ self.lines[:-1]
        size = np.einsum("ij,ij->i", queries, queries)
        rounds: list[tuple[float, np.ndarray, np.ndarray]] = []
        first = self.first_width(queries, k)

        def window(r: int):
            while len(rounds) <= r:
                h = first * GROWTH**len(rounds)
                low = np.empty(at.shape, np.int64)
                high = np.empty(at.shape, np.int64)
                for j, v in enumerate(self.values):
                    low[:, j] = np.searchsorted(v, at[:, j] - h, "left")
                    high[:, j] = np.searchsorted(v, at[:, j] + h, "right")
                rounds.append((h, low, high))
            return rounds[r]

        return [self.one(i, queries[i], at[i], own[i], size[i], k, window) for i in range(len(queries))]

    def first_width(self, queries: np.ndarray, k: int) -> float:
        """Where windows start: half the width that some queries need, if their
        neighbours were the best of a few vectors."""
        some, few = queries[:32], self.vectors[:512]
        scores = np.sort(some @ few.T, axis=1)[:, -min(k, len(few))]
        d2 = self.longest**2 + np.einsum("ij,ij->i", some, some) - 2 * scores
        return max(0.5 * WIDTH * math.sqrt(max(float(np.median(d2)), 0)), 1e-9 * max(self.longest, 1e-300))

    def one(self, i: int, q: np.ndarray, at: np.ndarray, own: int, size: float, k: int, window) -> tuple[np.ndarray, np.ndarray]:
        """The k best of one query, whose places on the lines are ``at``."""
        least = threshold()
        waiting = self.rows != own
        ids, scores = np.empty(0, np.int64), np.empty(0)
        goal = math.inf  # the width that the k-th best asks for
        for r in range(10_000):
            h, low, high = window(r)
            if h <= goal:
                low, high = low[i], high[i]
            else:  # no wider than needed
                h = goal
                low = np.array([v.searchsorted(x - h, "left") for v, x in zip(self.values, at)])
                high = np.array([v.searchsorted(x + h, "right") for v, x in zip(self.values, at)])
            found = np.flatnonzero(waiting & (self.collisions(low, high) >= least))
            if len(found):
                waiting[found] = False
                ids = np.concatenate([ids, self.ids[found]])
                scores = np.concatenate([scores, np.einsum("ij,j->i", self.vectors[found], q)])
                if len(ids) > k:  # ties with the k-th best stay until ids decide
                    near = scores >= np.partition(scores, -k)[-k]
                    ids, scores = ids[near], scores[near]
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if len(ids) >= k:
                goal = WIDTH * math.sqrt(max(self.longest**2 + size - 2 * scores[k - 1], 0))
                if h >= goal:
                    break
            if not waiting.any():
                break
        return ids, scores


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v, dim): the rows that take part, with components in double precision."""
    given = only(vectors, id=vec_id, v=embedding).where("id IS NOT NULL AND v IS NOT NULL")
    given = given.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    given = given.where(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    return given.withColumn("dim", F.size("v"))


def neighbours(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K,
               every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest per query."""
    # written with the rows, so that every reader sees the same numbers
    rows = staged(usable(vectors, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()), "ann-vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    n, queries, longest = rows.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1)), F.max(norm)).head()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-queries // QUERIES))
    longest = float(longest or 0)
    spread = lambda m, seed: F.pmod(F.xxhash64(F.lit(seed), "id", "row"), F.lit(m))
    # a stated query set against all rows, in blocks
    data = (rows.withColumn("block", spread(blocks, 1))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    asked = (rows.where(F.col("id") % every == 0).withColumn("part", spread(parts, 2))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    asked = asked.withColumn("part", F.col("part").cast("int")).withColumn("block", F.col("block").cast("long"))
    data = data.withColumn("part", F.col("part").cast("int"))

    def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, row = t.column("id").to_numpy(), t.column("row").to_numpy()
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        by_id = np.lexsort((row, ids))
        return ids[by_id], row[by_id], flat.reshape(len(ids), -1)[by_id]

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["row", "query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        ids, own, q = matrix(left)
        found = Index(*matrix(right), longest).search(q, own, k)
        each = [len(i) for i, _ in found]
        return pa.table([pa.array(np.repeat(own, each)), pa.array(np.repeat(ids, each)),
                         pa.array(np.concatenate([i for i, _ in found])),
                         pa.array(np.concatenate([s for _, s in found]))], names)

    key = ["dim", "block", "part"]
    pairs = (asked.select("id", "row", "v", *key).groupBy(*key).cogroup(data.select("id", "row", "v", *key).groupBy(*key))
             .applyInArrow(cell, "row long, query_id long, vec_id long, score double"))
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return (pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
