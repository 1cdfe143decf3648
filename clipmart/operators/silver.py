"""Bronze envelope -> Silver chunks.

One bronze row holds the verbatim model answer for one asset,
``{"chunks": [...]}``.  Silver has one row per element with a 1-based
position.  The explode is narrow (no shuffle): every task parses and explodes
its own bronze rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipmart import schemas
from clipmart.functions import identity
from clipmart.functions.text import normalised_theme

CHUNK_COLUMNS = [f.name for f in schemas.SILVER_CHUNK.fields]


def parse_envelope(raw: Column) -> Column:
    """``from_json`` with the declared envelope schema; malformed text gives a
    NULL struct instead of failing the batch (quarantined by dq.json_gate)."""
    return F.from_json(raw, schemas.ENVELOPE, {"mode": "PERMISSIVE"})


def to_int(text: Column) -> Column:
    """JSON scalar text -> int, rounding half away from zero ('4.5' -> 5);
    text that is not a number, or none that fits, becomes NULL and is
    quarantined later."""
    return F.round(text.try_cast("double")).try_cast("int")


def explode_chunks(bronze: DataFrame, id_width: int = 3, keep_versions: bool = True) -> DataFrame:
    """One row per chunk.  Empty, missing or unparsable arrays give no
    rows (the asset shows up in dq.json_gate / dq.row gates instead)."""
    extra = ["model_version", "prompt_version"] if keep_versions else []
    # Explode the envelope as element texts, then parse each element: the
    # envelope is parsed once per asset and never re-inlined per field.
    parsed = bronze.select("asset_id", *extra,
                           F.from_json(F.col("raw_response"), schemas.ENVELOPE_TEXT).alias("env"))
    texts = parsed.select("asset_id", *extra, F.posexplode("env.chunks").alias("pos", "j"))
    exploded = texts.select("asset_id", *extra, "pos",
                            F.from_json(F.col("j"), schemas.CHUNK_ELEMENT).alias("c"))
    seq = (F.col("pos") + 1).cast("long")
    return exploded.select(
        identity.chunk_id("asset_id", seq, id_width).alias("chunk_id"),
        "asset_id",
        seq.alias("chunk_sequence"),
        F.col("c.start_sec").try_cast("double").alias("start_sec"),
        F.col("c.end_sec").try_cast("double").alias("end_sec"),
        F.col("c.transcript_segment").alias("transcript_segment"),
        F.col("c.chunk_theme").alias("chunk_theme"),
        F.col("c.sentiment").alias("sentiment"),
        to_int(F.col("c.standalone_score")).alias("standalone_score"),
        F.col("c.next_compatible_themes").alias("next_compatible_themes"),
        F.col("c.keywords").alias("keywords"),
        *extra,
    )


def clean(chunks: DataFrame, filler: list[str] | None = None) -> DataFrame:
    """Silver projection (drops model/prompt version).  The optional
    filler list is removed from the transcript; off by default for parity."""
    out = chunks.select(*CHUNK_COLUMNS)
    if filler:
        pattern = r"(?i)\b(" + "|".join(filler) + r")\b\s*"
        out = out.withColumn("transcript_segment",
                             F.trim(F.regexp_replace("transcript_segment", pattern, "")))
    return out


def theme_vocabulary(silver: DataFrame) -> DataFrame:
    """How many raw spellings fold into one normalised theme."""
    return (silver.where(F.col("chunk_theme").isNotNull())
            .groupBy(normalised_theme("chunk_theme").alias("theme_normalised"))
            .agg(F.count_distinct("chunk_theme").alias("n_spellings"),
                 F.count(F.lit(1)).alias("n_chunks"),
                 F.array_sort(F.collect_set("chunk_theme")).alias("spellings")))
