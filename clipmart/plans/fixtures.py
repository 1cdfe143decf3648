"""The reference's input tables, derived from the driver tables.

Every fixture is a pure function of ``/root/testdata/sf*/`` so its size grows
with the data.  The same rules are written once more as DuckDB SQL in
``plans/oracle.py``; the oracle never reuses this code.

Rules (see FIXTURES.md section 3):
* a document is an asset; each line of its text is one chunk, 1-based;
* chunk features come from arithmetic on (doc_id, seq);
* ads are event users, platforms come from event_id parity, days from ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipmart import schemas
from clipmart.functions import identity
from clipmart.functions.text import keywords as keyword_list
from clipmart.session import spread

# Fixture chunk id width (longest document has 406 lines).
ID_WIDTH = 5
# Sentiment vocabulary, in index order.
SENTIMENTS = ["energetic", "frustrated", "aspirational", "neutral", "urgent", "calm"]
# Chunk roles accepted in an edit decision list.
ROLES = ["hook", "body", "social_proof", "cta"]
# Platform seed rows (id, name, hook window seconds, milestones).
PLATFORMS = [("meta", "meta", 3, "25,50,75,100"), ("tiktok", "tiktok", 6, "25,50,75,100")]
# Provenance constants of the fixture capture.
MODEL_VERSION, PROMPT_VERSION = "fixture-model-1", "v1"
LOAD_TS = "2026-01-01 00:00:00"
BUCKET = "lake"
# The landing clock and TTL of the page-based landing fixture.
LANDING_NOW = "2026-01-31 00:00:00"
LANDING_TTL_DAYS = 30
# Landing folder names, picked by page_id % 5.
LANDING_FOLDERS = ["raw_video", "Edited Cuts", "winning_video", "WINNERS 2026", "misc"]
# Clients left out of the client seed (exercise the orphan-tenant rule).
UNSEEDED_CLIENTS = ("src18", "src19")


# Tables whose rows carry heavy per-row work (text, html, events).
SPREAD_TABLES = ("documents",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in SPREAD_TABLES else df


def _step(doc_id: Column) -> Column:
    return F.lit(2) + doc_id % 5


def chunk_theme(doc_id: Column, seq: Column) -> Column:
    m = (doc_id + seq) % 40
    return (F.when(m < 20, "Problem").when(m < 28, "Hook").when(m < 34, "CTA")
            .when(m < 37, "Solution").when(m < 39, "Social Proof").otherwise("Offer"))


def sentiment(doc_id: Column, seq: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SENTIMENTS]),
                        ((doc_id + 2 * seq) % 6 + 1).cast("int"))


def score(doc_id: Column, seq: Column) -> Column:
    return (F.lit(1) + (3 * doc_id + seq) % 5).cast("int")


def next_themes(theme: Column, doc_id: Column, seq: Column) -> Column:
    return (F.when(theme == "Hook", F.array(F.lit("Problem")))
            .when(theme == "Problem",
                  F.when((doc_id + seq) % 2 == 0, F.array(F.lit("Solution"), F.lit("Social Proof")))
                  .otherwise(F.array(F.lit("Solution"))))
            .when(theme.isin("Solution", "Social Proof", "Offer"), F.array(F.lit("CTA")))
            .otherwise(F.array().cast("array<string>")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def asset_key(doc_id: Column) -> Column:
    return F.concat(F.lit("doc"), doc_id.cast("string"))


def bronze_asset_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One verbatim ``{"chunks": [...]}`` answer per document.  Built with a
    higher-order ``transform`` over the split lines: no explode, no shuffle,
    no collect_list, so element order is the line order by construction."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    doc = F.col("doc_id")
    step = _step(doc)

    def element(line, i):
        seq = i + 1
        theme = chunk_theme(doc, seq)
        return F.struct(
            (i * step).cast("double").alias("start_sec"),
            (seq * step).cast("double").alias("end_sec"),
            line.alias("transcript_segment"),
            theme.alias("chunk_theme"),
            sentiment(doc, seq).alias("sentiment"),
            score(doc, seq).alias("standalone_score"),
            next_themes(theme, doc, seq).alias("next_compatible_themes"),
            keyword_list(line).alias("keywords"),
        )

    chunks = F.transform(_lines(F.col("text")), element)
    return d.select(
        asset_key(doc).alias("asset_id"),
        F.col("source").alias("client_id"),
        F.to_json(F.struct(chunks.alias("chunks"))).alias("raw_response"),
        F.lit(MODEL_VERSION).alias("model_version"),
        F.lit(PROMPT_VERSION).alias("prompt_version"),
        identity.content_sha256("text").alias("content_sha256"),
        F.size(_lines(F.col("text"))).cast("int").alias("chunk_count"),
        F.to_timestamp(F.lit(LOAD_TS)).alias("load_ts"),
    )


def asset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows: one per document.  EDITED docs (doc_id % 3 = 0) point to
    the RAW doc ``doc_id + 2`` when it exists (left join, no broadcast)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    parents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("parent_doc"))
    doc = F.col("doc_id")
    j = d.join(parents, (doc % 3 == 0) & (F.col("parent_doc") == doc + 2), "left")
    n_lines = F.size(_lines(F.col("text")))
    return j.select(
        asset_key(doc).alias("asset_id"),
        F.col("source").alias("client_id"),
        identity.content_sha256("text").alias("content_sha256"),
        F.concat(asset_key(doc), F.lit(".mp4")).alias("asset_name"),
        F.when(doc % 3 == 2, "RAW").otherwise("EDITED").alias("asset_type"),
        F.when(F.col("parent_doc").isNotNull(), asset_key(F.col("parent_doc"))).alias("parent_asset_id"),
        F.when(n_lines >= 0, _step(doc) * n_lines).cast("int").alias("duration_sec"),
        F.concat(F.lit(f"s3://{BUCKET}/landing/"), F.col("source"), F.lit("/video/"),
                 asset_key(doc), F.lit(".mp4")).alias("source_uri"),
        F.to_timestamp(F.lit(LOAD_TS)).alias("ingested_at"),
    )


def identity_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest written the way ingest writes it: content hash of the text,
    tenant-scoped sha256 id, uri ``s3://lake/landing/<client>/video/<id>.mp4``.
    Exact copies of a text within one client give repeated ids (R6).
    Each hash is its own projection, so it is computed once per row."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", "source", identity.content_sha256("text").alias("content_sha256"))
    d = d.select("*", identity.asset_id(F.col("source"), F.col("content_sha256")).alias("asset_id"))
    return d.select(
        "doc_id", "asset_id",
        F.col("source").alias("client_id"),
        "content_sha256",
        F.concat(asset_key(F.col("doc_id")), F.lit(".mp4")).alias("asset_name"),
        F.when(F.col("doc_id") % 3 == 2, "RAW").otherwise("EDITED").alias("asset_type"),
        F.concat(F.lit(f"s3://{BUCKET}/landing/"), F.col("source"), F.lit("/video/"), F.col("asset_id"),
                 F.lit(".mp4")).alias("source_uri"),
    )


def dim_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client seed: every document source except the unseeded ones."""
    src = table(spark, sf_dir, "documents").select("source").distinct() \
        .where(~F.col("source").isin(*UNSEEDED_CLIENTS))
    return src.select(
        F.col("source").alias("client_id"),
        F.upper("source").alias("client_name"),
        F.lit("owner@agency").alias("account_support_owner"),
        F.concat(F.lit("folder_"), F.col("source")).alias("drive_folder_id"),
        F.lit(LANDING_TTL_DAYS).cast("int").alias("landing_ttl_days"),
        F.lit("active").alias("status"),
    )


def dim_platform(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLATFORMS, schemas.DIM_PLATFORM)


def chunk_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors for the first chunk of documents whose id has a vector."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    first_line = F.element_at(_lines(F.col("text")), 1)
    j = e.join(d, e.vec_id == d.doc_id).where(F.size(_lines(F.col("text"))) >= 1)
    return j.select(
        identity.chunk_id(asset_key(F.col("doc_id")), F.lit(1), ID_WIDTH).alias("chunk_id"),
        identity.content_sha256(first_line).alias("content_hash"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    )


def bronze_ad_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ad x platform counters from events (partial + final aggregate)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    et, eid = F.col("event_type"), F.col("event_id")
    purchase = et == "purchase"
    g = ev.groupBy(
        F.concat(F.lit("ad"), F.col("user_id").cast("string")).alias("ad_id"),
        F.to_date("ts").alias("perf_date"),
        F.when(eid % 2 == 0, "meta").otherwise("tiktok").alias("platform_native"),
    ).agg(
        F.count(F.lit(1)).alias("impressions"),
        F.count_if(et.isin("view", "click", "purchase")).alias("plays_3s"),
        F.count_if(et.isin("click", "purchase")).alias("plays_25"),
        F.count_if(purchase).alias("plays_50"),
        F.count_if(purchase & (eid % 4 < 2)).alias("plays_75"),
        F.count_if(purchase & (eid % 8 < 2)).alias("plays_100"),
        F.count_if(et == "view").alias("play_count"),
        F.count_if(et == "click").alias("link_clicks"),
        F.count_if(purchase).alias("results"),
        F.sum(eid % 30).cast("decimal(18,3)").alias("sum_watch_time_sec"),
        F.sum(F.col("value").cast("decimal(12,2)")).cast("decimal(18,2)").alias("spend"),
    )
    return g.select(
        "ad_id", "perf_date", "platform_native", *schemas.COUNTERS,
        "sum_watch_time_sec", "spend",
        F.to_timestamp(F.lit(LOAD_TS)).alias("load_ts"),
        F.lit("events.parquet").alias("source_file"),
        F.sha2(F.concat_ws("|", "ad_id", "platform_native", F.col("perf_date").cast("string")), 256)
        .alias("content_hash"),
    )


def map_ad_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event user is an ad cut from the document with the same number;
    users with ``user_id % 3 = 2`` stay unmapped."""
    u = table(spark, sf_dir, "events").select("user_id").where(F.col("user_id") % 3 != 2).distinct()
    return u.select(F.concat(F.lit("ad"), F.col("user_id").cast("string")).alias("ad_id"),
                    asset_key(F.col("user_id")).alias("asset_id"))


def edit_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks of the ad's own document.  Role: hook at 1,
    cta at the last, body at 2, else social_proof.  A planted typo on the
    second row of every 50th document gives the orphan check work."""
    m = map_ad_asset(spark, sf_dir).select("ad_id", F.expr("cast(substr(ad_id, 3) as bigint)").alias("doc_id"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    j = m.join(d, "doc_id").select("ad_id", "doc_id",
                                   F.size(_lines(F.col("text"))).alias("n"))
    j = j.where(F.col("n") >= 1).select("ad_id", "doc_id", "n",
                                         F.explode(F.sequence(F.lit(1), F.col("n"))).alias("seq"))
    doc, seq, step = F.col("doc_id"), F.col("seq"), _step(F.col("doc_id"))
    cid = identity.chunk_id(asset_key(doc), seq, ID_WIDTH)
    return j.select(
        "ad_id",
        F.when((doc % 50 == 0) & (seq == 2), F.concat(cid, F.lit("_typo"))).otherwise(cid).alias("chunk_id"),
        F.when(seq == 1, "hook").when(seq == F.col("n"), "cta").when(seq == 2, "body")
        .otherwise("social_proof").alias("chunk_role"),
        seq.cast("int").alias("position_in_ad"),
        ((seq - 1) * step).cast("double").alias("start_sec"),
        (seq * step).cast("double").alias("end_sec"),
    )


def landing_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing objects from ``pages``: html bytes are the object, the url's
    host names the client, mtime = LANDING_NOW minus (page_id % 60) days."""
    p = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.length("html").cast("long").alias("length"),
        F.concat(F.lit("client"), (F.col("page_id") % 3).cast("string")).alias("client_id"),
        identity.content_sha256(F.col("html").cast("binary")).alias("content_sha256"))
    p = p.select("*", identity.asset_id(F.col("client_id"), F.col("content_sha256")).alias("asset_id"))
    return p.select(
        "page_id", "url", "client_id", "content_sha256", "asset_id",
        identity.landing_key(F.col("client_id"), F.col("asset_id"),
                             identity.extension(F.regexp_extract("url", r"^[^?#]*", 0))).alias("key"),
        (F.to_timestamp(F.lit(LANDING_NOW)) - F.make_dt_interval(F.col("page_id") % 60))
        .alias("last_modified"),
        "length",
        (F.col("page_id") % 4 != 0).alias("has_bronze"),
        F.regexp_extract(F.regexp_extract("url", r"^[^?#]*", 0), r"([^/]*)$", 1).alias("name"),
        F.element_at(F.array(*[F.lit(f) for f in LANDING_FOLDERS]),
                     (F.col("page_id") % len(LANDING_FOLDERS) + 1).cast("int")).alias("folder"),
        (F.col("length") * 10).cast("long").alias("duration_ms"),
    )


def landing_clients(spark: SparkSession) -> DataFrame:
    rows = [(f"client{i}", LANDING_TTL_DAYS) for i in range(3)]
    return spark.createDataFrame(rows, "client_id string, landing_ttl_days int")


def extraction_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One telemetry record per extraction run (one per document)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang")
    doc = F.col("doc_id")
    return d.select(
        F.concat(F.lit("run"), doc.cast("string")).alias("run_id"),
        asset_key(doc).alias("asset_id"),
        F.lit(MODEL_VERSION).alias("model_version"),
        F.concat(F.lit("v"), (F.lit(1) + doc % 2).cast("string")).alias("prompt_version"),
        (F.col("n_chars") * 2).alias("tokens_in"),
        (F.col("n_chars") / 4).cast("long").alias("tokens_out"),
        (F.col("n_chars") / 100000).cast("decimal(18,3)").alias("api_cost"),
        ((doc % 17) + 1.5).cast("decimal(18,3)").alias("processing_time_sec"),
        (doc % 3).cast("int").alias("retry_count"),
        (F.lit(0.5) + (doc % 50) / 100).cast("decimal(18,3)").alias("extraction_confidence"),
        F.to_timestamp(F.lit(LOAD_TS)).alias("load_ts"),
    )


def direct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunk table computed straight from the documents (no JSON round
    trip): the hand-written answer key for golden / reconcile checks."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    x = d.select("doc_id", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    doc, seq = F.col("doc_id"), (F.col("pos") + 1).cast("long")
    step = _step(doc)
    return x.select(
        identity.chunk_id(asset_key(doc), seq, ID_WIDTH).alias("chunk_id"),
        asset_key(doc).alias("asset_id"),
        seq.alias("chunk_sequence"),
        ((seq - 1) * step).cast("double").alias("start_sec"),
        (seq * step).cast("double").alias("end_sec"),
        F.col("line").alias("transcript_segment"),
        chunk_theme(doc, seq).alias("chunk_theme"),
        sentiment(doc, seq).alias("sentiment"),
        score(doc, seq).alias("standalone_score"),
    )


def drifted_run(chunks: DataFrame) -> DataFrame:
    """A second extraction of the same assets: every 7th document scores one
    higher (wrapping 5 -> 1), every 11th loses the last word of each line."""
    doc = F.expr("cast(substr(asset_id, 4) as bigint)")
    return chunks.withColumn(
        "standalone_score",
        F.when(doc % 7 == 0, (F.col("standalone_score") % 5 + 1).cast("int")).otherwise(F.col("standalone_score"))
    ).withColumn(
        "transcript_segment",
        F.when(doc % 11 == 0, F.regexp_replace("transcript_segment", r"\s*\S+$", ""))
        .otherwise(F.col("transcript_segment")))
