"""Stored text index for ranked search: posting blocks with bounds, and a
top-k that leaves out the blocks which can't hold a result.

Layout under one folder, all Parquet:

``documents``  number, doc_id and its terms with their impact: the BM25
               factor tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl)),
               without the term's idf.
``postings``   one row per block of a term: the block's number, the impact level
               (impacts are cut into LEVELS levels), the block's highest
               impact, and at most BLOCK (number, impact) entries, so a term that
               stands in a third of all documents has many bounded rows.
``terms``      term, document frequency, idf, highest impact, and the block
               that search starts with.

Terms are counted and postings grouped as arrays, many documents at once.  Parts
of the postings are dealt out by hash of term and level; a task hands on a row
of packed entries to each part.  Full blocks are handed on as they are, each by
a hash of its own; only what is left over of a term's level meets that of other
tasks.

Search for the k best documents of every query:

1. The first blocks of the query's terms give partial scores; the best few
   documents of these are scored in full, and the k-th score is a floor that
   every result reaches.
2. A document below the floor in all its terms together can't enter.  Terms
   are taken by rising bound (idf * highest impact) while their bounds sum up
   to less than the floor: documents that hold only these can't enter either.
   What is left of the floor is shared out over the other terms in proportion
   to their bounds; a document enters only if it reaches its share in at least
   one of them.  So blocks whose highest impact is below the share are skipped.
3. The documents that are left are scored in full from ``documents``.

The result equals that of scoring everything.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart.functions import text as tx
from clipmart.operators import search as search_
from clipmart.session import bounded_broadcast, materialize

# Entries of a block, at most; impact levels per unit (an impact is below k1 + 1).
BLOCK, LEVELS = 256, 16
# Entries that a task groups at once, and tokens of a part of the postings, about.
HELD, PART = 2_000_000, 1_000_000
# Documents for which a bit each is sent to every task.
MARKED = 200_000_000
# A first block is the best of those with this many entries, if a term has one.
FIRST = 32
# What sums of the same weights in another order may differ by, and more.
SLACK = 1e-6


class TextIndex(NamedTuple):
    documents: DataFrame
    postings: DataFrame
    terms: DataFrame


def build(docs: DataFrame, path: str, doc_id: str = "chunk_id", text: str = "transcript_segment",
          k1: float = 1.2, b: float = 0.75) -> TextIndex:
    """Index ``docs`` (one row per document) under ``path``."""
    spark = docs.sparkSession
    # read twice: for the mean length and for the counts per term
    # no token holds a space, and a text is read far faster than a list
    toks = materialize(docs.select(F.col(doc_id).alias("doc_id"), tx.tokens(F.col(text)).alias("toks"))
                       .select("doc_id", F.size("toks").alias("dl"), F.array_join("toks", " ").alias("toks")))
    stats = toks.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"), F.sum("dl").alias("all")).first()
    n_docs, avgdl = float(stats["n"] or 0), float(stats["avgdl"] or 0.0)
    norm = F.lit(k1) * (1 - b + b * F.col("dl") / F.nullif(F.lit(avgdl), F.lit(0.0)))
    # an id that stands in several rows is one document
    again = materialize(toks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("again")))
    held = toks.where("dl > 0")
    if again.isEmpty():
        held = _counted(held, avgdl, k1, b)
    else:
        same, few = F.col("doc_id").eqNullSafe(F.col("again")), bounded_broadcast(again)
        held = _counted(held.join(few, same, "left_anti"), avgdl, k1, b).union(_summed(held.join(few, same, "left_semi"), avgdl, k1, b))
    # numbers are written with the documents, so that every reader sees the same
    held.select(F.monotonically_increasing_id().alias("number"), "doc_id", "terms") \
        .write.mode("overwrite").parquet(os.path.join(path, "documents"), compression="zstd")
    documents = spark.read.parquet(os.path.join(path, "documents"))

    parts = max(1, -(-(stats["all"] or 0) // PART))
    (documents.select("number", "terms").mapInArrow(_packed(parts), PACKED).repartitionById(parts, "part")
     .mapInArrow(_blocks, "term string, level int, top double, n long, entries array<struct<number: long, impact: double>>")
     .select(F.monotonically_increasing_id().alias("block"), "*")
     .write.mode("overwrite").parquet(os.path.join(path, "postings"), compression="zstd"))
    postings = spark.read.parquet(os.path.join(path, "postings"))

    best = F.least("n", F.lit(FIRST)) * (1 << 32) + F.col("level")
    (postings.groupBy("term").agg(F.sum("n").alias("df"), F.max("top").alias("top"), F.max_by("block", best).alias("first"))
     .withColumn("idf", F.log(F.lit(1.0) + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5)))
     .sortWithinPartitions("term").write.mode("overwrite").parquet(os.path.join(path, "terms")))
    return load(spark, path)


def _counted(toks: DataFrame, avgdl: float, k1: float, b: float) -> DataFrame:
    """doc_id, terms (term, impact) of every row of ``toks`` (doc_id, dl, toks; none empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in _portions(b, b.column(1).to_numpy())):
            dl = batch.column(1).to_numpy()
            coded = pc.split_pattern(batch.column(2), " ").flatten().dictionary_encode()
            n = len(coded.dictionary)
            found, tf = np.unique(np.repeat(np.arange(len(dl)), dl) * n + coded.indices.to_numpy(), return_counts=True)
            row, term = np.divmod(found, n)
            impact = tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[row] / avgdl))
            ends = np.cumsum(np.bincount(row, minlength=len(dl)))
            terms = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(term)), pa.array(impact)], ["term", "impact"])
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ends, terms)], ["doc_id", "terms"])

    terms = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("impact", T.DoubleType())]))
    return toks.select("doc_id", "dl", "toks").mapInArrow(run, T.StructType([T.StructField("doc_id", toks.schema["doc_id"].dataType),
                                                                       T.StructField("terms", terms)]))


def _portions(batch: pa.RecordBatch, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about HELD entries, ``n`` in each row; none without a row."""
    ends = [*np.flatnonzero(np.diff((np.cumsum(n, dtype=np.int64) - 1) // HELD)) + 1, batch.num_rows] if batch.num_rows else []
    yield from (batch.slice(a, z - a) for a, z in zip([0, *ends], ends))


def _summed(toks: DataFrame, avgdl: float, k1: float, b: float) -> DataFrame:
    """The same of rows that share ids: a row per id, rows of equal length counted together."""
    norm = F.lit(k1) * (1 - b + b * F.col("dl") / F.nullif(F.lit(avgdl), F.lit(0.0)))
    tf = (toks.select("doc_id", "dl", F.explode(F.split("toks", " ")).alias("term"))
          .groupBy("doc_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf")))
    impact = F.col("tf") * (k1 + 1) / (F.col("tf") + norm)
    return tf.groupBy("doc_id").agg(F.collect_list(F.struct("term", impact.alias("impact"))).alias("terms"))


def _lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)


def _cut(starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run and the start of each piece of at most BLOCK entries, of runs side by side."""
    pieces = -(-n // BLOCK)
    run = np.repeat(np.arange(len(n)), pieces)
    return run, starts[run] + BLOCK * (np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces))


def _along(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of runs' entries, run after run."""
    return np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n)


def _bytes(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    """A binary row of ``values`` up to each of ``ends``."""
    at = np.concatenate([[0], ends]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


PACKED = "part int, term array<string>, level binary, n binary, number binary, impact binary"


def _packed(parts: int):
    """Documents (number, terms) -> a row per part: the terms, levels and sizes
    of its runs of at most BLOCK entries, and the numbers and impacts of these."""
    def grouped(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        numbers = pa.concat_arrays([b.column(0) for b in held]).to_numpy()
        lists = pa.concat_arrays([b.column(1) for b in held])
        flat = lists.flatten()
        number, impact = np.repeat(numbers, pc.list_value_length(lists).to_numpy()), flat.field("impact").to_numpy()
        coded = flat.field("term").dictionary_encode()
        level = np.floor(impact * LEVELS).astype(np.int64)
        width = level.max() + 1
        key = coded.indices.to_numpy() * width + level
        order = np.argsort(key, kind="stable")
        key, number, impact = key[order], number[order], impact[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        _, at = _cut(first, np.diff(first, append=len(key)))
        n = np.diff(at, append=len(key))
        term, level = np.divmod(key[at], width)
        mark = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False))[term] + level.astype(np.uint64)
        mark += np.where(n < BLOCK, 0, number[at] + 1).astype(np.uint64) << np.uint64(32)
        mark = (mark ^ mark >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        part = (mark >> np.uint64(32)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        part, at, n, term, level = part[order].astype(np.int32), at[order], n[order], term[order], level[order]
        along = _along(at, n)
        rows = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))  # where the runs of each row end
        ends = np.cumsum(n)[rows - 1]
        return pa.RecordBatch.from_arrays([pa.array(part[rows - 1]), _lists(rows, coded.dictionary.take(pa.array(term))), _bytes(rows, level.astype(np.int32)),
                                           _bytes(rows, n.astype(np.int32)), _bytes(ends, number[along]), _bytes(ends, impact[along])],
                                          ["part", "term", "level", "n", "number", "impact"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in (x for b in batches for x in _portions(b, pc.list_value_length(b.column(1)).to_numpy())):
            entries = pc.sum(pc.list_value_length(batch.column(1))).as_py() or 0
            if entries:
                held, size = [*held, batch], size + entries
            if size >= HELD:
                yield grouped(held)
                held, size = [], 0
        if held:
            yield grouped(held)

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed rows of one part -> its blocks by term and level: what is
    left over in full blocks as far as it goes."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    plain = lambda c, kind: np.concatenate([np.frombuffer(v.as_buffer(), kind) for b in rows for v in b.column(c)])
    coded = pa.concat_arrays([b.column(1).flatten() for b in rows]).dictionary_encode()
    level, n, number, impact = plain(2, np.int32), plain(3, np.int32).astype(np.int64), plain(4, np.int64), plain(5, np.float64)
    del rows
    by_term = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(by_term), np.int64)
    rank[by_term] = np.arange(len(by_term))
    key, whole = rank[coded.indices.to_numpy()] * (int(level.max()) + 1) + level, n >= BLOCK
    order = np.lexsort((whole, key))
    along = _along((np.cumsum(n) - n)[order], n[order])
    key, whole, n, number, impact = key[order], whole[order], n[order], number[along], impact[along]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | whole[1:]]))
    starts = (np.cumsum(n) - n)[first]
    run, at = _cut(starts, np.diff(starts, append=len(number)))
    ends = np.append(at[1:], len(number))
    term, level = np.divmod(key[first[run]], int(level.max()) + 1)
    out = pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(by_term[term])), pa.array(level, pa.int32()), pa.array(np.maximum.reduceat(impact, at)),
                                      pa.array(ends - at, pa.int64()),
                                      _lists(ends, pa.StructArray.from_arrays([pa.array(number), pa.array(impact)], ["number", "impact"]))],
                                     ["term", "level", "top", "n", "entries"])
    for a in range(0, out.num_rows, 10_000):
        yield out.slice(a, 10_000)


def load(spark: SparkSession, path: str) -> TextIndex:
    return TextIndex(*(spark.read.parquet(os.path.join(path, t)) for t in TextIndex._fields))


def _scored(index: TextIndex, pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """query_id, doc_id, score of (query, document) pairs over all terms they share."""
    held = index.documents.where(F.col("doc_id").isNotNull()).join(pairs, "number").select("query_id", "doc_id", F.explode("terms").alias("t")) \
        .select("query_id", "doc_id", "t.term", "t.impact")
    return held.join(terms.select("query_id", "term", "idf"), ["query_id", "term"]) \
        .groupBy("query_id", "doc_id").agg(F.sum(F.col("idf") * F.col("impact")).alias("score"))


def _best(scored: DataFrame, k: int, last: str = "doc_id") -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), last)
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def plan(index: TextIndex, queries: DataFrame, k: int) -> DataFrame:
    """query_id, term, idf, bound (idf * highest impact), df and ``least``: the
    impact from which on the term's documents may enter (null: none may
    through this term)."""
    words = queries.select("query_id", F.explode(F.array_distinct(tx.tokens("query_text"))).alias("term"))
    terms = materialize(bounded_broadcast(words).join(index.terms, "term").withColumn("bound", F.col("idf") * F.col("top")))
    side = bounded_broadcast(terms)
    lead = index.postings.join(side.select("query_id", "term", "idf", F.col("first").alias("block")), ["term", "block"])
    seen = lead.select("query_id", "idf", F.explode("entries").alias("e")).groupBy("query_id", F.col("e.number").alias("number")) \
        .agg(F.sum(F.col("idf") * F.col("e.impact")).alias("score"))
    tried = materialize(_best(seen, 4 * k, "number").select("query_id", "number"))
    # fewer than k documents give no floor
    floor = _best(_scored(index, bounded_broadcast(tried), side), k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score") - SLACK).otherwise(0.0).alias("floor"))
    rising = Window.partitionBy("query_id").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("query_id")
    out = terms.join(floor, "query_id", "left").fillna(0.0, ["floor"]).withColumn("up_to", F.sum("bound").over(rising))
    out = out.withColumn("open", F.col("up_to") >= F.col("floor"))
    left_out = F.sum(F.when(F.col("open"), 0.0).otherwise(F.col("bound"))).over(whole)
    shared = F.sum(F.when(F.col("open"), F.col("bound")).otherwise(0.0)).over(whole)
    share = (F.col("floor") - left_out) * F.col("bound") / shared
    return out.withColumn("least", F.when(F.col("open"), F.greatest(share / F.col("idf") - SLACK, F.lit(0.0)))) \
        .select("query_id", "term", "idf", "bound", "df", "least")


def candidates(index: TextIndex, planned: DataFrame) -> DataFrame:
    """The (query_id, number) pairs that may enter."""
    open_ = bounded_broadcast(planned.where("least IS NOT NULL").select("query_id", "term", "least"))
    blocks = index.postings.join(open_, "term").where(F.col("top") >= F.col("least"))
    return blocks.select("query_id", "least", F.explode("entries").alias("e")) \
        .where(F.col("e.impact") >= F.col("least")).select("query_id", F.col("e.number").alias("number")).distinct()


def _marked(numbers: DataFrame):
    """Which rows of a batch have one of ``numbers``, held as a bit per
    document: so documents stay where they are."""
    bits = numbers.groupBy(F.shiftright("number", 15).alias("run")).agg(
        F.bitmap_construct_agg(F.col("number").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).orderBy("run").collect()
    runs, bits = np.array([r["run"] for r in bits], np.int64), b"".join(r["bits"] for r in bits)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        number = batch.column("number").to_numpy()
        at = np.searchsorted(runs, number >> 15)
        known = np.append(runs, -1)[at] == number >> 15
        place = np.where(known, (at << 15) + (number & (1 << 15) - 1), 0)
        held = np.frombuffer(bits, np.uint8)
        return batch.filter(pa.array(known & (held[place >> 3] >> (place & 7) & 1 == 1) if len(held) else known))

    return keep


def search(index: TextIndex, queries: DataFrame, k: int, doc_id: str = "chunk_id") -> DataFrame:
    """query_id, ``doc_id``, score (nine decimals, as sums vary in the digits
    behind), rank: the k best documents of every query (query_id, query_text),
    ties by id."""
    planned = materialize(plan(index, queries, k))
    # a document that may enter for some query is scored for every one that it shares a term with
    enter, held = candidates(index, planned).select("number").distinct(), index.documents.where(F.col("doc_id").isNotNull())
    small, keep = planned.count() <= search_.MAX_QUERY_TERMS, None
    if small and index.documents.count() <= MARKED:
        keep = _marked(enter)
    else:
        held = held.join(enter, "number", "left_semi")
    scored = search_.scored(held, planned.select("query_id", "term", "idf"), k, small, keep)
    return _best(scored, k).select("query_id", F.col("doc_id").alias(doc_id), "score", "rank")


def work(index: TextIndex, queries: DataFrame, k: int) -> DataFrame:
    """query_id, postings (entries of all its terms: what scoring everything
    reads), read (entries of the blocks that are not skipped), scored
    (documents scored in full)."""
    planned = materialize(plan(index, queries, k))
    open_ = bounded_broadcast(planned.where("least IS NOT NULL").select("query_id", "term", "least"))
    read = index.postings.join(open_, "term").where(F.col("top") >= F.col("least")).groupBy("query_id").agg(F.sum("n").alias("read"))
    found = candidates(index, planned).groupBy("query_id").agg(F.count(F.lit(1)).alias("scored"))
    return planned.groupBy("query_id").agg(F.sum("df").alias("postings")).join(read, "query_id", "left") \
        .join(found, "query_id", "left").fillna(0)
