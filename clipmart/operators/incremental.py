"""Only-process-what-is-new operators: unextracted assets, landing TTL plan,
append-only bronze, the content-hash gate for embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart.functions import identity as ident

# The golden prefix is never listed by the TTL job.
GOLDEN_PREFIX = "landing/_golden/"
SECONDS_PER_DAY = 86400


def unextracted(manifest: DataFrame, bronze_ids: DataFrame, client_id: str) -> DataFrame:
    """Landed ids of one client minus extracted ids, sorted."""
    if not client_id:
        raise ValueError("client_id is required")
    landed = manifest.where(F.col("client_id") == client_id).select("asset_id").distinct()
    return landed.join(bronze_ids.select("asset_id"), "asset_id", "left_anti").orderBy("asset_id")


def ttl_plan(landing: DataFrame, clients: DataFrame, bronze_ids: DataFrame, now: str) -> DataFrame:
    """Age in whole elapsed days (floor, not calendar days); younger
    than the client's TTL -> within_ttl; else bronze present -> delete,
    missing -> skip_no_bronze.  The output is a plan; nothing is deleted."""
    l = landing.where(~F.col("key").startswith(GOLDEN_PREFIX))
    age = F.floor((F.unix_timestamp(F.to_timestamp(F.lit(now))) - F.unix_timestamp("last_modified"))
                  / SECONDS_PER_DAY).cast("long")
    j = l.join(clients.select("client_id", "landing_ttl_days"), "client_id") \
        .withColumn("asset_id", ident.path_stem(F.col("key"))) \
        .withColumn("age_days", age)
    b = bronze_ids.select("asset_id").distinct().withColumn("_has", F.lit(True))
    j = j.join(b, "asset_id", "left")
    action = (F.when(F.col("age_days") < F.col("landing_ttl_days"), "within_ttl")
              .when(F.col("_has").isNull(), "skip_no_bronze").otherwise("delete"))
    return j.select("client_id", "key", "asset_id", "age_days", action.alias("action"))


def ttl_summary(plan: DataFrame) -> DataFrame:
    """A9."""
    return plan.groupBy("action").agg(F.count(F.lit(1)).alias("n_objects"))


def one_per_key(batch: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per ``key``: the first by ``order`` (nulls last), of equals the
    one whose row is smallest by hash, so the choice is the same in every run.
    ``min_by`` keeps one row per key and task, also of a hot key.  Rows without
    a key are dropped: nothing could tell them apart later."""
    rest = [c for c in batch.columns if c != key]
    first = [F.col(order).isNull(), F.col(order)] if order else []
    rank = F.struct(*(c.alias(f"o{i}") for i, c in enumerate([*first, F.xxhash64(*batch.columns)])))
    one = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), rank).alias("r"))
    return one.select(*(F.col(c) if c == key else F.col(f"r.{c}").alias(c) for c in batch.columns))


def new_bronze(batch: DataFrame, existing: DataFrame | None) -> DataFrame:
    """K2: one row (the earliest) of every asset not yet in bronze
    (append-only, no overwrite)."""
    new = one_per_key(batch, "asset_id", "load_ts" if "load_ts" in batch.columns else None)
    return new if existing is None else new.join(existing.select("asset_id"), "asset_id", "left_anti").select(*batch.columns)


def append_bronze(batch: DataFrame, path: str) -> int:
    """K2 sink: anti join against what is stored, then append.  Returns the
    number of rows appended."""
    spark = batch.sparkSession
    from clipmart.session import materialize, path_exists

    existing = spark.read.schema(batch.schema).parquet(path) if path_exists(spark, path) else None
    new = materialize(new_bronze(batch, existing))
    n = new.count()
    if n:
        new.write.mode("append").parquet(path)
    return n


# --- content-hash gated embedding (C3) -----------------------------------------

def hash_embedder(dim: int = 64) -> Callable[[pd.Series], np.ndarray]:
    """Default deterministic embedding: lower-cased whitespace tokens hashed
    into ``dim`` buckets (pandas' fixed-key vectorised hash), counted and
    L2-normalised.  A stand-in for a remote model; swap in any function
    ``texts -> (n, dim) array``."""

    def fn(texts: pd.Series) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float64)
        toks = texts.fillna("").astype(str).str.lower().str.split()
        lens = toks.str.len().to_numpy()
        if lens.sum():
            flat = np.concatenate([np.asarray(t, dtype=object) for t in toks if len(t)])
            rows = np.repeat(np.arange(len(texts)), lens)
            cols = (pd.util.hash_array(flat) % np.uint64(dim)).astype(np.int64)
            np.add.at(out, (rows, cols), 1.0)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        norms[norms == 0] = 1.0
        return (out / norms).astype(np.float32)
    return fn


def embed(silver: DataFrame, existing: DataFrame | None, fn=None, batch: int = 20, dim: int = 64) -> DataFrame:
    """Keep a stored vector when (chunk_id, content hash) is unchanged,
    embed the rest in Arrow batches of ``batch`` texts (mapInPandas), and
    return exactly the current Silver chunks with a ``status`` column."""
    if fn is None:  # local default: no API limit, embed whole Arrow batches
        fn, batch = hash_embedder(dim), 1 << 30
    cur = silver.select("chunk_id", "transcript_segment",
                        ident.content_sha256("transcript_segment").alias("content_hash"))
    if existing is None:
        j = cur.withColumn("embedding", F.lit(None).cast("array<float>"))
    else:
        old = existing.select("chunk_id", F.col("content_hash").alias("_old_hash"),
                              F.col("embedding").alias("_old_vec"))
        j = cur.join(old, "chunk_id", "left").select(
            "chunk_id", "transcript_segment", "content_hash",
            F.when(F.col("_old_hash") == F.col("content_hash"), F.col("_old_vec")).alias("embedding"))
    kept = j.where(F.col("embedding").isNotNull()).select(
        "chunk_id", "content_hash", "embedding", F.lit("kept").alias("status"))
    todo = j.where(F.col("embedding").isNull()).select("chunk_id", "transcript_segment", "content_hash")
    schema = T.StructType([T.StructField("chunk_id", T.StringType()),
                           T.StructField("content_hash", T.StringType()),
                           T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("status", T.StringType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for s in range(0, len(pdf), batch):
                part = pdf.iloc[s:s + batch]
                vecs = fn(part["transcript_segment"])
                yield pd.DataFrame({"chunk_id": part["chunk_id"].to_numpy(),
                                    "content_hash": part["content_hash"].to_numpy(),
                                    "embedding": [v.astype(np.float32).tolist() for v in vecs],
                                    "status": "new"})

    fresh = todo.mapInPandas(run, schema)
    return kept.unionByName(fresh)
