"""Serving queries: filtered clip search, keyword / tenant scope, vector
top-k (exact and approximate), batch semantic join and BM25 text ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from clipmart.functions import text as tx
from clipmart.functions import vectors as vx
from clipmart.session import materialize

# Largest (query, term) table shipped to every task.
MAX_QUERY_TERMS = 2_000_000
# Scores that a task holds at once, and (document, term) entries summed up at once.
SCORES, PRODUCTS = 400_000, 20_000

CLIP_COLUMNS = ["chunk_id", "asset_id", "asset_name", "start_sec", "end_sec", "standalone_score",
                "chunk_theme", "sentiment", "transcript_segment"]


def clips(fact: DataFrame, asset: DataFrame, theme: str | None = None, sentiment: str | None = None,
          min_score: int | None = None, contains: str | None = None, order: bool = True) -> DataFrame:
    """only supplied predicates apply (they reach the parquet scan as
    pushed filters).  ``contains`` is wrapped in % unescaped, so % and _ act
    as wildcards, as in the reference.  Ordered by score desc, start asc
    (NULLs last), chunk_id as the final tie-break."""
    c = fact
    if theme is not None:
        c = c.where(F.col("chunk_theme") == theme)
    if sentiment is not None:
        c = c.where(F.col("sentiment") == sentiment)
    if min_score is not None:
        c = c.where(F.col("standalone_score") >= min_score)
    if contains:
        c = c.where(F.col("transcript_segment").ilike(f"%{contains}%"))
    out = c.join(asset.select("asset_id", "asset_name"), "asset_id").select(*CLIP_COLUMNS)
    if order:
        out = out.orderBy(F.col("standalone_score").desc_nulls_last(),
                          F.col("start_sec").asc_nulls_last(), "chunk_id")
    return out


def by_keyword(fact: DataFrame, keyword_bridge: DataFrame, keyword: str) -> DataFrame:
    """Chunks carrying a keyword (left semi join: each chunk once)."""
    hits = keyword_bridge.where(F.col("keyword") == keyword).select("chunk_id")
    return fact.join(hits, "chunk_id", "left_semi")


def scope(fact: DataFrame, asset: DataFrame, client_id: str) -> DataFrame:
    """Chunks of one tenant, reached through the asset dimension."""
    if not client_id:
        raise ValueError("client_id is required")
    owned = asset.where(F.col("client_id") == client_id).select("asset_id")
    return fact.join(owned, "asset_id", "left_semi")


def serving_view(fact: DataFrame, name: str | None = None) -> DataFrame:
    """Read-only serving shape: chunks that have a vector."""
    v = fact.where(F.col("embedding").isNotNull()).select(
        "chunk_id", "asset_id", "transcript_segment", "chunk_theme", "sentiment",
        "standalone_score", "embedding")
    if name:
        v.createOrReplaceTempView(name)
    return v


def nearest(fact: DataFrame, qvec: Sequence[float], k: int, metric: str = "l2", keep: Sequence[str] = ()) -> DataFrame:
    """Exact top-k against one query vector.  ``orderBy().limit(k)``
    plans as TakeOrderedAndProject: each partition keeps k rows, so only
    k x partitions rows ever reach the final merge.  ``keep`` names further
    columns of the fact to return."""
    v = fact.where(F.col("embedding").isNotNull())
    if metric == "l2":
        s = vx.l2_distance("embedding", list(qvec))
        return v.select("chunk_id", *keep, s.alias("distance")) \
            .orderBy(F.col("distance").asc_nulls_last(), "chunk_id").limit(k)
    s = vx.cosine_similarity("embedding", list(qvec))
    return v.select("chunk_id", *keep, s.alias("similarity")) \
        .orderBy(F.col("similarity").desc_nulls_last(), "chunk_id").limit(k)


def hits(found: DataFrame, fact: DataFrame, asset: DataFrame) -> DataFrame:
    """What a reader sees of the chunks that a top-k search found: asset name,
    times, score, theme and text beside the measure.  ``found`` has k rows."""
    shown = [c for c in CLIP_COLUMNS if c not in ("chunk_id", "asset_id", "sentiment")]
    return (fact.join(F.broadcast(found), "chunk_id").join(asset.select("asset_id", "asset_name"), "asset_id")
            .select(*found.columns, *shown))


def _topk_block(qids: np.ndarray, qmat: np.ndarray, ids: np.ndarray, cmat: np.ndarray, k: int,
                metric: str) -> pd.DataFrame:
    """The k best corpus rows for every query; equal scores by id.  Distances
    are computed directly (sum of squared differences in float64) rather than
    by the dot-product expansion, which loses digits."""
    by_id = np.argsort(ids, kind="stable")
    ids, cmat = ids[by_id], cmat[by_id]
    qnorm, cnorm = np.linalg.norm(qmat, axis=1), np.linalg.norm(cmat, axis=1)
    kk = min(k, len(ids))
    out_c, out_s = [], []
    for q, n in zip(qmat, qnorm):
        if metric == "l2":
            score = np.sqrt(((cmat - q) ** 2).sum(axis=1))
            order = np.argsort(score, kind="stable")[:kk]
        else:
            with np.errstate(divide="ignore", invalid="ignore"):
                score = (cmat @ q) / (cnorm * n)
            order = np.argsort(-score, kind="stable")[:kk]
        out_c.append(ids[order])
        out_s.append(score[order])
    return pd.DataFrame({"query_id": np.repeat(qids, kk), "chunk_id": pd.Series(np.concatenate(out_c), dtype=object),
                         "score": np.concatenate(out_s)})


def semantic_join(queries: DataFrame, fact: DataFrame, k: int, metric: str = "l2",
                  query_block: int = 4096, corpus_block: int = 20_000) -> DataFrame:
    """M3: top-k corpus chunks for many query vectors.

    One plan at every size: both sides are hashed into blocks of bounded size
    (row counts set the number of blocks), each (query block, corpus block)
    pair is scored in one ``cogroup().applyInPandas`` task that keeps k rows
    per query, and a window over k x blocks candidates per query picks the
    final k.  Nothing passes through the driver but the two counts."""
    qcols = queries.select("query_id", "embedding").where(F.col("embedding").isNotNull())
    corpus = fact.where(F.col("embedding").isNotNull()).select("chunk_id", "embedding")
    schema = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType),
                           T.StructField("chunk_id", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    qb, cb = max(1, -(-qcols.count() // query_block)), max(1, -(-corpus.count() // corpus_block))
    c = corpus.withColumn("cb", F.pmod(F.xxhash64("chunk_id"), F.lit(cb))) \
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(qb - 1)).cast("array<bigint>")))
    q = qcols.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(qb))) \
        .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(cb - 1)).cast("array<bigint>")))

    def pair(qpdf: pd.DataFrame, cpdf: pd.DataFrame) -> pd.DataFrame:
        if qpdf.empty or cpdf.empty:
            return pd.DataFrame({"query_id": qpdf["query_id"].to_numpy()[:0], "score": np.empty(0),
                                 "chunk_id": pd.Series([], dtype=object)})[["query_id", "chunk_id", "score"]]
        matrix = lambda x: np.stack(x["embedding"].to_numpy()).astype(np.float64)
        return _topk_block(qpdf["query_id"].to_numpy(), matrix(qpdf), cpdf["chunk_id"].to_numpy(), matrix(cpdf), k, metric)

    cand = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInPandas(pair, schema)
    order = F.col("score").asc() if metric == "l2" else F.col("score").desc()
    w = Window.partitionBy("query_id").orderBy(order, F.col("chunk_id"))
    return cand.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def ann(fact: DataFrame, qvec: Sequence[float], k: int, bucket_length: float = 2.0,
        num_tables: int = 4, seed: int = 7) -> DataFrame:
    """M4: approximate nearest neighbours with MLlib random-projection LSH,
    then an exact re-rank of the candidates.  Recall is measured against
    ``nearest`` by ``ann_recall``."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors

    v = fact.where(F.col("embedding").isNotNull()) \
        .select("chunk_id", array_to_vector("embedding").alias("features"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes",
                                        bucketLength=bucket_length, numHashTables=num_tables,
                                        seed=seed).fit(v)
    key = Vectors.dense([float(x) for x in qvec])
    got = model.approxNearestNeighbors(v, key, k, distCol="distance")
    return got.select("chunk_id", F.round("distance", 6).alias("distance")) \
        .orderBy("distance", "chunk_id")


def ann_recall(approx: DataFrame, exact: DataFrame) -> float:
    """Share of exact top-k ids found by the approximate search."""
    e = exact.select("chunk_id")
    hit = e.join(approx.select("chunk_id"), "chunk_id", "left_semi").count()
    total = e.count()
    return hit / total if total else 1.0


def bm25(docs: DataFrame, queries: DataFrame, k: int, k1: float = 1.2, b: float = 0.75,
         doc_id: str = "chunk_id", text: str = "transcript_segment") -> DataFrame:
    """M2: Okapi BM25 of every query against every document, top-k each.

    Tokens are lower-cased letter/digit runs; no stemming, no stop words.

    Plan: the corpus is read and cut into tokens once.  Token rows are
    hash-partitioned by document; term frequencies and the list of every
    document's terms keep that partitioning.  The query side is bounded by the
    query text, not the corpus, and counted: each task sums up the (query,
    document) scores of a block of documents as arrays (``scored``), so the
    fan-out is never rows and never shuffled.  The per-query
    top-k is a ``row_number() <= k`` window (WindowGroupLimit: k rows per
    task and query cross the final shuffle).  Scores are sums whose order of
    addition varies from run to run; nine decimals are kept, so that copies of
    a document tie and come in order of their ids."""
    # read twice: for the mean length and for the counts per term
    toks = materialize(docs.select(F.col(doc_id).alias("doc_id"), tx.tokens(F.col(text)).alias("toks")))
    st = toks.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("toks")).alias("avgdl")).first()
    n_docs, avgdl = float(st["n"] or 0), float(st["avgdl"] or 0.0)
    qterms = queries.select("query_id", F.explode(F.array_distinct(tx.tokens("query_text"))).alias("term"))
    # Query-side sizes are counted on the queries alone (cheap).
    small = qterms.count() <= MAX_QUERY_TERMS
    vocab = qterms.select("term").distinct()
    vocab = F.broadcast(vocab) if small else vocab
    # fixed partition count: AQE must not coalesce the scoring by its small input size
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tf = (toks.repartition(parts, "doc_id")
          .select("doc_id", F.size("toks").alias("dl"), F.explode("toks").alias("term"))
          .join(vocab, "term", "left_semi")
          .groupBy("doc_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf")))
    norm = F.lit(k1) * (1 - b + b * F.col("dl") / F.nullif(F.lit(avgdl), F.lit(0.0)))
    impact = F.col("tf") * (k1 + 1) / (F.col("tf") + norm)
    # read twice: for the terms' idf and for the scores
    held = materialize(tf.groupBy("doc_id").agg(F.collect_list(F.struct("term", impact.alias("impact"))).alias("terms")))
    df = held.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0) + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = qterms.join(df, "term").select("query_id", "term", idf.alias("idf"))
    return ranked(scored(held, terms, k, small).select("doc_id", "query_id", "score"), k).withColumnRenamed("doc_id", doc_id)


def scored(held: DataFrame, terms: DataFrame, k: int, small: bool = True,
           keep: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None) -> DataFrame:
    """query_id, doc_id, score: per task, the k best documents of every query.

    ``held`` has a row per document with its terms and their impact, ``terms``
    the idf of every query's terms.  A small query side goes to every task,
    which sums up the products of a block of documents at once; a large one is
    joined, and then every pair that shares a term is returned.  ``keep`` leaves
    out rows of a batch of ``held``, if the query side is small."""
    if not small:
        return held.select("doc_id", F.explode("terms").alias("t")).select("doc_id", "t.term", "t.impact").join(terms, "term") \
            .groupBy("doc_id", "query_id").agg(F.round(F.sum(F.col("idf") * F.col("impact")), 9).alias("score"))
    rows = terms.collect()  # at most MAX_QUERY_TERMS
    names = sorted({r["term"] for r in rows})
    place = {t: i for i, t in enumerate(names)}
    queries = list(dict.fromkeys(r["query_id"] for r in rows))
    number = {q: i for i, q in enumerate(queries)}
    rows.sort(key=lambda r: place[r["term"]])
    of = np.array([place[r["term"]] for r in rows], np.int64)
    asked, idf = np.array([number[r["query_id"]] for r in rows], np.int64), np.array([r["idf"] for r in rows])
    starts = np.searchsorted(of, np.arange(len(names) + 1))
    block = max(1, SCORES // max(1, len(queries)))
    id_type, query_type = to_arrow_type(held.schema["doc_id"].dataType), to_arrow_type(terms.schema["query_id"].dataType)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = pa.array(names, pa.string()), pa.array(queries, query_type)
        for b in batches:
            b = b if keep is None else keep(b)
            for a in range(0, b.num_rows, block):
                part = b.slice(a, block)
                part = part.take(pc.sort_indices(part.column("doc_id"), null_placement="at_start"))
                lists = part.column("terms")
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
                flat = lists.flatten()
                term = pc.fill_null(pc.index_in(flat.field("term"), known), -1).to_numpy()
                doc, impact, term = doc[term >= 0], flat.field("impact").to_numpy()[term >= 0], term[term >= 0]
                sums = np.zeros((part.num_rows, len(queries)))
                for c in range(0, len(doc), PRODUCTS):
                    d, w, t = (x[c:c + PRODUCTS] for x in (doc, impact, term))
                    n = starts[t + 1] - starts[t]
                    at = np.arange(n.sum()) + np.repeat(starts[t] - (np.cumsum(n) - n), n)
                    sums += np.bincount(np.repeat(d, n) * len(queries) + asked[at], np.repeat(w, n) * idf[at],
                                        minlength=sums.size).reshape(sums.shape)
                order = np.argsort(-np.round(sums, 9), axis=0, kind="stable")[:k]  # equal scores by id
                i, q = order.T.ravel(), np.repeat(np.arange(len(queries)), len(order))
                i, q = i[sums[i, q] > 0], q[sums[i, q] > 0]
                yield pa.RecordBatch.from_arrays([numbers.take(pa.array(q)), part.column("doc_id").take(pa.array(i)).cast(id_type), pa.array(sums[i, q])],
                                                 ["query_id", "doc_id", "score"])

    schema = T.StructType([T.StructField("query_id", terms.schema["query_id"].dataType), T.StructField("doc_id", held.schema["doc_id"].dataType),
                           T.StructField("score", T.DoubleType())])
    return (held if keep else held.select("doc_id", "terms")).mapInArrow(best, schema).withColumn("score", F.round("score", 9))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best documents of every query with their rank, equal scores by id."""
    win = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id"))
    return found.withColumn("rank", F.row_number().over(win).cast("long")).where(F.col("rank") <= k)
