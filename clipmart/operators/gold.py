"""Silver -> Gold core tables (fact, dims, bridges)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_COLUMNS = ["chunk_id", "asset_id", "chunk_sequence", "start_sec", "end_sec",
                "transcript_segment", "chunk_theme", "sentiment", "standalone_score"]


def fact_chunk(silver: DataFrame, embeddings: DataFrame | None) -> DataFrame:
    """Chunk features + vector by left join; a chunk with no vector keeps
    its row with NULL.  Both sides are keyed by chunk_id, so at scale this is
    one co-partitioned sort-merge join (or broadcast when AQE sees a small
    embedding side)."""
    base = silver.select(*FACT_COLUMNS)
    if embeddings is None:
        return base.withColumn("embedding", F.lit(None).cast("array<float>"))
    return base.join(embeddings.select("chunk_id", "embedding"), "chunk_id", "left") \
        .select(*FACT_COLUMNS, "embedding")


def dim_asset(manifest: DataFrame) -> DataFrame:
    """manifest projection, typed-NULL dq_flag, volatile build time."""
    return manifest.select(
        "asset_id", "client_id", "content_sha256", "parent_asset_id", "asset_name",
        "asset_type", "duration_sec", "source_uri", "ingested_at",
        F.lit(None).cast("string").alias("dq_flag"),
        F.current_timestamp().alias("load_ts"),
    )


def compatibility(silver: DataFrame) -> DataFrame:
    """F8: one row per allowed next theme; empty/NULL arrays give no row,
    NULL elements are kept."""
    return silver.select(
        "chunk_id",
        F.explode("next_compatible_themes").alias("compatible_theme"),
        F.lit(None).cast("decimal(18,3)").alias("theme_match_score"),
    )


def keywords(silver: DataFrame) -> DataFrame:
    """F9."""
    return silver.select("chunk_id", F.explode("keywords").alias("keyword"))


def themes(silver: DataFrame) -> DataFrame:
    """F10."""
    return silver.select("chunk_id", F.col("chunk_theme").alias("theme"))


def lineage(asset: DataFrame) -> DataFrame:
    """Parent -> child asset edges from the manifest's parent column."""
    return asset.where(F.col("parent_asset_id").isNotNull()) \
        .select("parent_asset_id", F.col("asset_id").alias("child_asset_id"))


def extraction_run(run_log: DataFrame) -> DataFrame:
    """Typed projection of the per-run telemetry log."""
    return run_log.select(
        "run_id", "asset_id", "model_version", "prompt_version",
        F.col("tokens_in").cast("long"), F.col("tokens_out").cast("long"),
        F.col("api_cost").cast("decimal(18,3)"),
        F.col("processing_time_sec").cast("decimal(18,3)"),
        F.col("retry_count").cast("int"),
        F.col("extraction_confidence").cast("decimal(18,3)"),
    )


def extraction_summary(run: DataFrame) -> DataFrame:
    """A10: tokens, time and retries by model x prompt version."""
    return run.groupBy("model_version", "prompt_version").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum("tokens_in").alias("tokens_in"),
        F.sum("tokens_out").alias("tokens_out"),
        F.sum("processing_time_sec").alias("processing_time_sec"),
        F.sum("retry_count").cast("long").alias("retries"),
        F.sum("api_cost").alias("api_cost"),
    )


def build_core(bronze: DataFrame, embeddings: DataFrame | None, manifest: DataFrame,
               id_width: int = 3) -> dict[str, DataFrame]:
    """Bronze -> Silver -> the Gold core tables.  Silver is read by five
    consumers, so it is materialised once (reliable checkpoint) instead of
    re-parsing the JSON in each."""
    from clipmart.operators import silver as sv
    from clipmart.session import materialize

    chunks = materialize(sv.clean(sv.explode_chunks(bronze, id_width)))
    asset = dim_asset(manifest)
    return {
        "int_chunk_cleaned": chunks,
        "dim_asset": asset,
        "fact_chunk": fact_chunk(chunks, embeddings),
        "bridge_chunk_compatibility": compatibility(chunks),
        "dim_keyword_bridge": keywords(chunks),
        "dim_theme_bridge": themes(chunks),
        "bridge_asset_lineage": lineage(asset),
    }
