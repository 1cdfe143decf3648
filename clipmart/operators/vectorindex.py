"""Stored vector index: a coarse quantiser whose cells are folders.

``build`` learns centroids (k-means on a bounded sample of the vectors), gives
every vector to its nearest centroid, and writes the vectors partitioned by
cell with their distance to the centroid.  A cell with many vectors is spread
over several files.  ``cells`` keeps per cell the centroid, the number of
vectors and the radius (the largest such distance).

``nearest`` answers one vector: it reads the folders of the cells whose
centroids are nearest (partition pruning), and ranks what they hold exactly.
That is approximate.  The exact way goes on: with the k-th distance u found so
far, a cell can only hold something nearer if its centroid is no further than
u + radius (triangle inequality); just those cells are read too.

``join`` answers many vectors exactly, in the same two rounds, as jobs over
pairs of (block of near cells, query): the second round meets only the cells
that the bound leaves, and inside a cell only vectors whose distance to the
centroid is within u of the query's.  How much that leaves out depends on the vectors:
little where all are about equally far from each other.

Distances are euclidean, computed directly in double precision on the stored
vectors; equal ones by id.  Null vectors are not indexed.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart.functions import vectors as vx
from clipmart.session import materialize

# Most cells (folders, and centroids on the driver); vectors per cell that k-means learns from.
MAX_CELLS, SAMPLED = 4096, 64
# Vectors of a file or block, queries that meet a block in one task, rows of a matrix of distances.
FILE_ROWS, QUERY_ROWS, MATRIX_ROWS = 50_000, 16_384, 64
# Room for rounding in bounds on distances.
SLACK = 1e-9


class VectorIndex(NamedTuple):
    vectors: DataFrame
    cells: DataFrame


def _near_cells(centroids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Distances of vectors (rows) to centroids (columns)."""
    d2 = (vectors**2).sum(1)[:, None] + (centroids**2).sum(1)[None, :] - 2 * vectors @ centroids.T
    return np.sqrt(np.maximum(d2, 0))


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of lists as a matrix, without an object for each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def build(vectors: DataFrame, path: str, cells: int | None = None, id_col: str = "chunk_id", seed: int = 7) -> VectorIndex:
    """Index ``vectors`` (id, embedding) under ``path``; by default with about
    as many cells as the square root of the vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    spark = vectors.sparkSession
    # counted, sampled and placed: read once from where they come from
    rows = materialize(vectors.where(F.col("embedding").isNotNull()).select(
        F.col(id_col).alias("id"), F.col("embedding").cast("array<double>").alias("embedding")))
    n = rows.count()
    cells = min(MAX_CELLS, cells or max(1, round(n**0.5)))
    every = max(1, n // (cells * SAMPLED))
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)
    if n:
        model = KMeans(k=cells, seed=seed, maxIter=10, featuresCol="v").fit(sample.select(array_to_vector("embedding").alias("v")))
        centroids = np.array(model.clusterCenters())
    else:
        centroids = np.zeros((1, 1))
    placed_as = T.StructType([rows.schema["id"], rows.schema["embedding"], T.StructField("cell", T.IntegerType()),
                              T.StructField("away", T.DoubleType())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, MATRIX_ROWS):
                part = b.slice(a, MATRIX_ROWS)
                m = _rows(part.column("embedding"))
                cell = _near_cells(centroids, m).argmin(1)
                away = np.sqrt(((m - centroids[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype("int32")), pa.array(away)], placed_as.names)

    found = materialize(rows.mapInArrow(placed, placed_as))
    sizes = found.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()  # one row a cell
    centroid = {r["cell"]: [float(x) for x in centroids[r["cell"]]] for r in sizes}
    about = spark.createDataFrame([(r["cell"], r["n"], r["radius"], centroid[r["cell"]]) for r in sizes],
                                  "cell int, n long, radius double, centroid array<double>")
    files = about.select("cell", F.ceil(F.col("n") / FILE_ROWS).cast("int").alias("files"))
    (found.join(F.broadcast(files), "cell").withColumn("file", F.pmod(F.xxhash64("id"), F.col("files")))
     .repartition("cell", "file").sortWithinPartitions("cell", "away").drop("files", "file")
     .write.mode("overwrite").partitionBy("cell").parquet(os.path.join(path, "vectors")))
    about.coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "cells"))
    return load(spark, path, placed_as)


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> VectorIndex:
    reader = spark.read.schema(schema) if schema else spark.read
    return VectorIndex(reader.parquet(os.path.join(path, "vectors")), spark.read.parquet(os.path.join(path, "cells")))


def _in_cells(index: VectorIndex, cells: Sequence[int], qvec: Sequence[float], k: int) -> DataFrame:
    """The k best of some cells: a filter on the partition column, so no other folder is opened."""
    rows = index.vectors.where(F.col("cell").isin([int(c) for c in cells]))
    return rows.select("id", "cell", vx.l2_distance("embedding", list(qvec)).alias("distance")) \
        .orderBy("distance", "id").limit(k)


def nearest(index: VectorIndex, qvec: Sequence[float], k: int, probes: int = 8, exact: bool = True) -> tuple[DataFrame, list[int]]:
    """(id, distance of the k nearest vectors; the cells that were read).  At
    least ``probes`` cells are read, more until they hold k vectors."""
    about = index.cells.collect()  # at most MAX_CELLS rows
    if not about:
        return index.vectors.select("id", F.lit(None).cast("double").alias("distance")).limit(0), []
    q = np.asarray(qvec, np.float64)
    away = [float(np.sqrt(((np.array(r["centroid"]) - q) ** 2).sum())) for r in about]
    order = sorted(range(len(about)), key=lambda i: (away[i], about[i]["cell"]))
    first, held = [], 0
    for i in order:
        if len(first) >= probes and held >= k:
            break
        first.append(i)
        held += about[i]["n"]
    read = [about[i]["cell"] for i in first]
    found = _in_cells(index, read, qvec, k)
    if exact and len(first) < len(about):
        best = found.collect()  # k rows
        u = best[-1]["distance"] if len(best) == k else float("inf")
        more = [about[i]["cell"] for i in order[len(first):] if away[i] - about[i]["radius"] <= u + SLACK]
        if more:
            found = found.unionByName(_in_cells(index, more, qvec, k)).orderBy("distance", "id").limit(k)
            read += more
    return found.select("id", "distance"), read


def _blocks(about: list) -> list[tuple[int, int, int]]:
    """(cell, block, parts) of every cell: near cells share a block of
    at most FILE_ROWS vectors, a larger cell has a block for each part."""
    m = np.array([r["centroid"] for r in about])
    m = m - m.mean(0)
    along = m @ np.linalg.svd(m, full_matrices=False)[2][0] if len(m) > 1 else np.zeros(len(m))
    out, block, held = [], 0, 0
    for i in np.argsort(along, kind="stable"):
        n = about[i]["n"]
        if held and held + n > FILE_ROWS:
            block, held = block + 1, 0
        parts = -(-n // FILE_ROWS)
        out.append((about[i]["cell"], block, parts))
        block, held = (block + parts, 0) if parts > 1 else (block, held + n)
    return out


def _nearest_of(q: np.ndarray, v: np.ndarray, within: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row of q, rows of v, distances): for every query what may be among the
    k nearest of the vectors ``within`` it.  The expansion of the square picks
    them with room for its rounding; distances are computed directly."""
    qq, vv = (q**2).sum(1), (v**2).sum(1)
    d2 = np.where(within, qq[:, None] + vv[None, :] - 2 * q @ v.T, np.inf)
    kth = np.partition(d2, min(k, len(v)) - 1, axis=1)[:, min(k, len(v)) - 1]
    for i in np.flatnonzero(within.any(1)):
        rows = np.flatnonzero(within[i] & (d2[i] <= kth[i] + 1e-9 * (qq[i] + vv.max())))
        yield i, rows, np.sqrt(((v[rows] - q[i]) ** 2).sum(1))


def _meet(pairs: DataFrame, index: VectorIndex, about: list, k: int) -> DataFrame:
    """query_id, id, distance, compared, block of the k best of every (query,
    block) pair.  ``pairs`` has query_id, embedding, block, cells (those the
    query meets there) and most (no vector's distance to its centroid differs
    by more from the query's).  Queries of a block are split, so a task holds
    a bounded number of queries and of vectors, as plain matrices."""
    spark = pairs.sparkSession
    centroid = {r["cell"]: r["centroid"] for r in about}
    placed = spark.createDataFrame(_blocks(about), "cell int, block int, parts int")  # one row a cell
    met = F.broadcast(pairs.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).cast("int").alias("q_parts")))  # one row a block
    left = pairs.join(met, "block").withColumn("qp", F.pmod(F.xxhash64("query_id"), F.col("q_parts")).cast("int")).drop("q_parts")
    right = (index.vectors.join(F.broadcast(placed), "cell")
             .withColumn("block", (F.col("block") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int")).join(met, "block")
             .withColumn("qp", F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)))
             .select("id", F.col("embedding").alias("vector"), "cell", F.col("away").alias("out"), "block", "qp"))
    schema = T.StructType([pairs.schema["query_id"], index.vectors.schema["id"], T.StructField("distance", T.DoubleType()),
                           T.StructField("compared", T.LongType()), T.StructField("block", T.IntegerType())])

    def best(q: pa.Table, v: pa.Table) -> pa.Table:
        found, vid, distance, compared = [], [], [], []
        if q.num_rows and v.num_rows:
            v = v.take(pc.sort_indices(v, [("id", "ascending")]))
            m, out, cell = _rows(v.column("vector")), v.column("out").to_numpy(), v.column("cell").to_numpy()
            here = np.unique(cell)
            at = np.searchsorted(here, cell)
            centroids = np.array([centroid[c] for c in here.tolist()])
            vectors, most, cells = _rows(q.column("embedding")), q.column("most").to_numpy(), q.column("cells")
            for a in range(0, len(vectors), MATRIX_ROWS):
                part = vectors[a:a + MATRIX_ROWS]
                asked = np.zeros((len(part), len(here)), bool)
                for i, c in enumerate(cells[a:a + MATRIX_ROWS].to_pylist()):
                    asked[i, np.flatnonzero(np.isin(here, c))] = True
                room = most[a:a + MATRIX_ROWS, None] + 1e-6
                within = asked[:, at] & (np.abs(out[None, :] - _near_cells(centroids, part)[:, at]) <= room)
                for i, rows, d in _nearest_of(part, m, within, k):
                    order = np.lexsort((rows, d))[:k]  # the rows are in the order of their ids
                    found.append(np.full(len(order), a + i))
                    vid.append(rows[order])
                    distance.append(d[order])
                    compared.append(np.full(len(order), within[i].sum()))
        whole = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        n = sum(map(len, vid))
        return pa.table({"query_id": q.column("query_id").take(pa.array(whole(found, np.int64))), "id": v.column("id").take(pa.array(whole(vid, np.int64))),
                         "distance": whole(distance, float), "compared": whole(compared, np.int64),
                         "block": np.full(n, q.column("block")[0].as_py() if n else 0, np.int32)})

    return left.groupBy("block", "qp").cogroup(right.groupBy("block", "qp")).applyInArrow(best, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def join(index: VectorIndex, queries: DataFrame, k: int, probes: int = 2) -> DataFrame:
    """query_id, id, distance, rank: the k nearest indexed vectors of every
    query (query_id, embedding), exactly."""
    return _ranked(joined(index, queries, k, probes).select("query_id", "id", "distance"), k)


def joined(index: VectorIndex, queries: DataFrame, k: int, probes: int = 2) -> DataFrame:
    """The candidates of both rounds with ``compared``: how many vectors of
    a block a query was compared with in a round."""
    about = index.cells.collect()  # at most MAX_CELLS rows
    q = queries.where(F.col("embedding").isNotNull()).select("query_id", F.col("embedding").cast("array<double>").alias("embedding"))
    if not about:
        return q.select("query_id", F.lit(None).cast(index.vectors.schema["id"].dataType).alias("id"),
                        F.lit(None).cast("double").alias("distance"), F.lit(0).cast("long").alias("compared"),
                        F.lit(0).alias("block"), F.lit(0).alias("round")).limit(0)
    centroids = np.array([r["centroid"] for r in about])
    cells, n, radius = (np.array([r[c] for r in about]) for c in ("cell", "n", "radius"))
    blocks_of = {c: range(block, block + parts) for c, block, parts in _blocks(about)}
    home = T.StructField("home", T.ArrayType(T.IntegerType()))
    pair = T.StructType([q.schema["query_id"], q.schema["embedding"], T.StructField("block", T.IntegerType()),
                         T.StructField("cells", T.ArrayType(T.IntegerType())), T.StructField("most", T.DoubleType())])
    by_block: dict[int, list[int]] = {}
    for i, c in enumerate(cells.tolist()):
        for block in blocks_of[c]:
            by_block.setdefault(block, []).append(i)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Some queries at a time, with their distances to all centroids."""
        for b in batches:
            for a in range(0, b.num_rows, MATRIX_ROWS):
                part = b.slice(a, MATRIX_ROWS)
                yield part, _near_cells(centroids, _rows(part.column("embedding")))

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest cells of every query, ``probes`` or as many as hold k vectors."""
        for part, away in slices(batches):
            order = np.argsort(away, axis=1, kind="stable")
            before = np.cumsum(n[order], axis=1) - n[order]
            take = (np.arange(len(cells)) < probes) | (before < k)
            got = [cells[o[t]].tolist() for o, t in zip(order, take)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.list_(pa.int32()))], ["query_id", "embedding", "home"])

    def meets(part: pa.RecordBatch, which: np.ndarray, most: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A row per query and block with a cell of it."""
        for block, own in by_block.items():
            rows = np.flatnonzero(which[:, own].any(1))
            if len(rows):
                met = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [met.column("query_id"), met.column("embedding"), pa.array(np.full(len(rows), block, np.int32)),
                     pa.array([cells[own][w].tolist() for w in which[np.ix_(rows, own)]], pa.list_(pa.int32())), pa.array(most[rows], pa.float64())],
                    pair.names)

    def known(part: pa.RecordBatch) -> np.ndarray:
        return np.stack([np.isin(cells, c) for c in part.column("home").to_pylist()])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, MATRIX_ROWS):
                part = b.slice(a, MATRIX_ROWS)
                yield from meets(part, known(part), np.full(part.num_rows, np.inf))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, away in slices(batches):
            most = part.column("u").to_numpy()
            # the expansion behind `away` loses some digits: more slack than for direct distances
            yield from meets(part, ~known(part) & (away - radius <= most[:, None] + 1e-6), most + 1e-6)

    asked = materialize(q.mapInArrow(homes, T.StructType([*q.schema, home])))
    near = materialize(_meet(materialize(asked.mapInArrow(first, pair)), index, about, k))
    bound = _ranked(near, k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.max("distance")).otherwise(float("inf")).alias("u"))
    more = materialize(asked.join(bound, "query_id").mapInArrow(second, pair))
    return near.withColumn("round", F.lit(1)).unionByName(_meet(more, index, about, k).withColumn("round", F.lit(2)))


def pairs_compared(index: VectorIndex, queries: DataFrame, k: int, probes: int = 2) -> tuple[int, int]:
    """(pairs whose distance the join computes in blocks that gave it a
    candidate; all pairs)."""
    done = joined(index, queries, k, probes).select("query_id", "block", "round", "compared").distinct().agg(F.sum("compared")).first()[0]
    total = queries.where(F.col("embedding").isNotNull()).count() * (index.cells.agg(F.sum("n")).first()[0] or 0)
    return int(done or 0), int(total)


