"""A corpus pipeline over ``documents``: language ID, quality rules, SimHash
near-dedup, mixing sources to target weights, SentencePiece ids.

Each stage takes what its predecessor kept, as (spark, docs, sf_dir), and
returns the columns of documents; the last returns ids.  ``run`` writes every
stage as Parquet into the shared folder and reads it back for the next.

Every stage tells rows apart by more than their ids: rows without an id and
different texts under one id are documents like others.  Near-dedup leaves one
row of each group of near copies.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipmart.llm import langid, mixing, quality, simhash, spm
from clipmart.llm.common import WORD, staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a sufficient margin."""
    return langid.predict(docs, langid.fit(docs), keep=COLUMNS).where(~F.col("rejected")).select(COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    stats = staged(quality.statistics(docs), "quality-statistics")
    forest = quality.fit(stats, table(spark, sf_dir, "labels"))
    return quality.kept(docs, forest).select(COLUMNS)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest id, of
    equal ids or without one by hash of the row."""
    # written with the rows, so that every reader sees the same numbers
    rows = staged(docs.select(*COLUMNS, F.xxhash64("text", "lang", "source", "n_chars").alias("mark"),
                              F.monotonically_increasing_id().alias("row")), "dedup-rows", "zstd")
    found = simhash.near_duplicates(rows, keep=("mark", "row"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "mark", "row")
    first = found.groupBy("root").agg(F.min(order).alias("first")).select("first.row")
    return rows.join(first, "row", "left_semi").select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the schedule takes, in its order: a row per whole pass
    over a document, and one with the leading words of a document that the
    target cuts.  So any stretch of the rows holds the sources near their shares."""
    got = mixing.passes(*mixing.mix(docs)).select(
        F.col("doc_id").alias("got_id"), F.col("source").alias("got_source"), F.col("h").alias("got_h"),
        F.when(F.col("words") < F.col("size"), F.col("words")).alias("words"), "slot", "at")
    # id, source and hash tell apart what near-dedup leaves, also rows without an id or under one id
    same = ((mixing.row_hash() == F.col("got_h")) & F.col("doc_id").eqNullSafe(F.col("got_id"))
            & F.col("source").eqNullSafe(F.col("got_source")))
    # split keeps every word and drops what stands between them
    lead = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("words").cast("int")), " ")
    out = docs.join(got, same).withColumn("text", F.when(F.col("words").isNull(), F.col("text")).otherwise(lead))
    out = out.withColumn("n_chars", F.when(F.col("words").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.orderBy("slot", "at").select(COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids and whether the ids decode to the text, per row."""
    return spm.encode(docs, verify=True).withColumn("n_ids", F.coalesce(F.array_size("ids"), F.lit(0)).cast("long"))


STAGES = [
    ("language ID", language),
    ("quality rules", rules),
    ("SimHash near-dedup", deduplicated),
    ("mixing", mixed),
    ("SentencePiece", encoded),
]

#: The stages learn models and walk graphs, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
