"""The registered queries: each applies one operator, with production
parameters, to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipmart.llm.common import staged, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_quality_rules(spark, sf):
    from clipmart.llm import quality

    stats = staged(quality.statistics(table(spark, sf, "documents")), "quality-statistics")
    forest = quality.fit(stats, table(spark, sf, "labels"))
    return quality.judged(stats, forest).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "score")


@query
def op7_language_id(spark, sf):
    from clipmart.llm import langid

    docs = table(spark, sf, "documents")
    out = langid.predict(docs, langid.fit(docs), keep=["doc_id"])
    return out.withColumn("held_out", langid.held_out(F.col("doc_id")))


@query
def op8_simhash(spark, sf):
    from clipmart.llm import simhash

    out = simhash.near_duplicates(table(spark, sf, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_mixing(spark, sf):
    from clipmart.llm import mixing

    return mixing.taken(*mixing.mix(table(spark, sf, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "first_slot", "slots")


@query
def op2_sentencepiece(spark, sf):
    from clipmart.llm import spm

    out = spm.encode(table(spark, sf, "documents"), verify=True)
    return out.select("doc_id", F.coalesce(F.array_size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids", "lossless")


@query
def op9_warc(spark, sf):
    from clipmart.llm import warc

    out = warc.archived(table(spark, sf, "pages"))
    return out.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_token_files(spark, sf):
    from clipmart.llm import tokenfile

    return tokenfile.read_files(*tokenfile.written(table(spark, sf, "documents")))


@query
def op10_token_counts(spark, sf):
    from clipmart.llm import editcount

    return editcount.edited_counts(table(spark, sf, "documents"))


@query
def op1_url_filter(spark, sf):
    from clipmart.llm import urlfilter

    return urlfilter.filtered(table(spark, sf, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op4_ann(spark, sf):
    from clipmart.llm import ann

    return ann.neighbours(table(spark, sf, "embeddings"))


@query
def op11_spelling_variants(spark, sf):
    from clipmart.llm import variants

    return variants.grouped(table(spark, sf, "documents"))


@query
def op12_byte_bpe(spark, sf):
    from clipmart.llm import bytebpe

    return bytebpe.digests(table(spark, sf, "documents"))


@query
def op13_collocations(spark, sf):
    from clipmart.llm import collocations

    return collocations.best(collocations.mined(table(spark, sf, "documents")))
