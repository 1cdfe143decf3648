"""Asset identity: type by folder, object keys, near-duplicate flags,
landing -> manifest ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipmart.functions import identity as ident

NEAR_DUP_SECONDS = 5


def uri_parts(df: DataFrame, uri: str = "source_uri") -> DataFrame:
    """bucket, key, file stem (asset id) and extension of object uris."""
    key = ident.uri_key(F.col(uri))
    return df.select("*", ident.uri_bucket(F.col(uri)).alias("bucket"), key.alias("key"),
                     ident.path_stem(key).alias("stem"), ident.extension(key).alias("ext"))


def near_dup(asset: DataFrame, client="client_id", stem="stem", folder="folder",
             duration="duration_sec", tol: int = NEAR_DUP_SECONDS) -> DataFrame:
    """Flag (never merge) assets with another asset of the same client,
    stem and folder whose duration is within ``tol`` seconds.

    Durations are bucketed by ``tol``: two assets in one bucket are always
    within tol; across buckets only the neighbours b-1 / b+1 can be, and
    for them the nearest value (max of b-1, min of b+1) decides.  Bucket
    summaries are partial aggregates, joined back on (group, bucket); no
    pair of assets is ever produced."""
    grp = [client, stem, folder]
    a = asset.where(F.col(duration).isNotNull()).withColumn("_b", F.floor(F.col(duration) / tol))
    s = a.groupBy(*grp, "_b").agg(F.count(F.lit(1)).alias("_n"), F.min(duration).alias("_lo"),
                                  F.max(duration).alias("_hi"))
    prev = s.select(*grp, (F.col("_b") + 1).alias("_b"), F.col("_hi").alias("prev_hi"))
    nxt = s.select(*grp, (F.col("_b") - 1).alias("_b"), F.col("_lo").alias("next_lo"))
    same = s.select(*grp, "_b", "_n")
    j = a.join(same, grp + ["_b"]).join(prev, grp + ["_b"], "left").join(nxt, grp + ["_b"], "left")
    d = F.col(duration)
    flag = (F.col("_n") >= 2) | (F.coalesce(d - F.col("prev_hi") <= tol, F.lit(False))) \
        | (F.coalesce(F.col("next_lo") - d <= tol, F.lit(False)))
    out = j.withColumn("near_dup", flag)
    return out.drop("_b", "_n", "prev_hi", "next_lo") \
        .unionByName(asset.where(F.col(duration).isNull()).withColumn("near_dup", F.lit(False)))


def ingest(landing: DataFrame, manifest: DataFrame | None, bucket: str, ingested_at: str,
           position: str = "page_id") -> DataFrame:
    """Landed objects -> manifest rows for assets not seen before
    (anti join against the manifest) and not repeated inside the batch
    (first position wins)."""
    new = landing.select(
        position, "asset_id", "client_id", "content_sha256",
        F.col("name").alias("asset_name"),
        ident.asset_type(F.col("folder")).alias("asset_type"),
        F.lit(None).cast("string").alias("parent_asset_id"),
        (F.col("duration_ms") / 1000).cast("long").cast("int").alias("duration_sec"),
        ident.s3_uri(bucket, ident.landing_key(F.col("client_id"), F.col("asset_id"),
                                                ident.extension(F.col("name")))).alias("source_uri"),
        F.to_timestamp(F.lit(ingested_at)).alias("ingested_at"))
    if manifest is not None:
        new = new.join(manifest.select("asset_id"), "asset_id", "left_anti")
    first = new.groupBy("asset_id").agg(F.min(position).alias(position))
    return new.join(first, ["asset_id", position], "left_semi")
