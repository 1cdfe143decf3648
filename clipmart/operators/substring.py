"""Substring search over a stored trigram index.

``build`` numbers the texts and stores, per trigram of the lower-cased texts,
the numbers of those that hold it, in blocks of bounded size.  ``search``
takes a pattern as ``contains`` of the clip search does (% and _ are
wildcards).  Every literal part of three characters or more gives trigrams
that each result must hold; of these the few rarest select candidates, and
``ilike`` verifies these on the texts alone.  So the texts that are read are
those of the candidates.

A pattern without a literal part of three characters, or with a backslash
(which escapes), selects nothing and is answered by a scan: the same rows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipmart.session import bounded_broadcast

# Ids of a block, about; trigrams that select.
BLOCK, SELECT = 1024, 4
# Characters whose trigrams a task sorts at once, about.
PIECE_CHARS = 1_000_000


class GramIndex(NamedTuple):
    grams: DataFrame
    postings: DataFrame
    rows: DataFrame


def _held(numbers: np.ndarray, texts: list[str]) -> pa.RecordBatch:
    """gram, n, numbers: the trigrams of some texts, each with the texts that
    hold it.  Linear in the characters but for sorting."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    whole = row[:-2] == row[2:]
    keys, code = np.unique((chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:])[whole], return_inverse=True)
    pair = np.unique(code * len(texts) + row[:-2][whole])
    starts = np.searchsorted(pair, np.arange(len(keys) + 1) * len(texts))
    letters = np.stack([keys >> 42, keys >> 21 & 0x1FFFFF, keys & 0x1FFFFF], axis=1).astype("<u4")
    spelt = letters.tobytes().decode("utf-32-le", "surrogatepass")
    return pa.RecordBatch.from_arrays(
        [pa.array([spelt[i:i + 3] for i in range(0, len(spelt), 3)], pa.string()), pa.array(np.diff(starts), pa.int64()),
         pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(numbers[pair % len(texts)], pa.int64()))],
        ["gram", "n", "numbers"])


def _pieces(rows: DataFrame) -> DataFrame:
    """gram, n, numbers of every piece of the rows: BLOCK texts at most."""
    block, most = BLOCK, PIECE_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, texts = b.column(0).to_numpy(), b.column(1).to_pylist()
            first, size = 0, 0
            for i, t in enumerate(texts):
                size += len(t)
                if i + 1 == len(texts) or i + 1 - first == block or size >= most:
                    if size >= 3:
                        yield _held(numbers[first:i + 1], texts[first:i + 1])
                    first, size = i + 1, 0

    return rows.select("number", "low").mapInArrow(run, "gram string, n long, numbers array<long>")


def build(texts: DataFrame, path: str, id_col: str = "chunk_id", text: str = "transcript_segment") -> GramIndex:
    """Index ``texts`` under ``path``."""
    spark = texts.sparkSession
    at = lambda name: os.path.join(path, name)
    # written with the rows, so that every reader sees the same numbers
    texts.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("id"),
                 F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low")).write.mode("overwrite").parquet(at("rows"), compression="zstd")
    _pieces(spark.read.parquet(at("rows"))).write.mode("overwrite").parquet(at("pieces"), compression="zstd")
    pieces = spark.read.parquet(at("pieces"))
    pieces.groupBy("gram").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(at("grams"))
    # a common trigram is dealt to as many blocks as it needs
    many = spark.read.parquet(at("grams")).where(F.col("n") > BLOCK).select("gram", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    (pieces.join(bounded_broadcast(many), "gram", "left")
     .withColumn("block", F.coalesce(F.pmod(F.xxhash64(F.col("numbers")[0]), F.col("blocks")), F.lit(0)).cast("int"))
     .groupBy("gram", "block").agg(F.flatten(F.collect_list("numbers")).alias("numbers"))
     .sortWithinPartitions("gram").write.mode("overwrite").parquet(at("postings"), compression="zstd"))
    return load(spark, path)


def load(spark: SparkSession, path: str) -> GramIndex:
    return GramIndex(*(spark.read.parquet(os.path.join(path, t)) for t in GramIndex._fields))


def needed(pattern: str) -> list[str]:
    """Trigrams that every match of ``contains=pattern`` holds, lower-cased."""
    if "\\" in pattern:
        return []
    parts = [p.lower() for p in re.split("[%_]", pattern)]
    return sorted({p[i:i + 3] for p in parts for i in range(len(p) - 2)})


def candidates(index: GramIndex, pattern: str) -> DataFrame | None:
    """The ids of the texts that hold the rarest trigrams of the pattern (none
    where one stands in no text), or None where the pattern selects nothing."""
    wanted = needed(pattern)
    if not wanted:
        return None
    known = index.grams.where(F.col("gram").isin(wanted)).orderBy("n", "gram").limit(SELECT).collect()  # SELECT rows
    if index.grams.where(F.col("gram").isin(wanted)).count() < len(wanted):
        return index.rows.select("id").limit(0)
    chosen = [r["gram"] for r in known]
    held = index.postings.where(F.col("gram").isin(chosen)).select(F.explode("numbers").alias("number"))
    all_ = held.groupBy("number").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(chosen)).select("number")
    return index.rows.select("number", "id").join(all_, "number", "left_semi").select("id").distinct()


def search(index: GramIndex, fact: DataFrame, pattern: str, id_col: str = "chunk_id", text: str = "transcript_segment") -> DataFrame:
    """The rows of ``fact`` whose text contains the pattern, regardless of case."""
    ids = candidates(index, pattern)
    rows = fact if ids is None else fact.join(bounded_broadcast(ids.withColumnRenamed("id", id_col)), id_col, "left_semi")
    return rows.where(F.col(text).ilike(f"%{pattern}%"))
