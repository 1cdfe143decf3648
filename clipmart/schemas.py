"""Declared schemas.  Nothing in the library infers a schema."""

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()
DEC = T.DecimalType(18, 3)
MONEY = T.DecimalType(18, 2)
STRS = T.ArrayType(S)
VEC = T.ArrayType(T.FloatType())


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# One element of the model answer.  Scalars are read as *strings* and cast
# afterwards, so "4.5", 4.5 and "x" all survive parsing (see silver.py).
CHUNK_ELEMENT = _struct(
    ("start_sec", S), ("end_sec", S), ("transcript_segment", S),
    ("chunk_theme", S), ("sentiment", S), ("standalone_score", S),
    ("next_compatible_themes", STRS), ("keywords", STRS),
)
ENVELOPE = _struct(("chunks", T.ArrayType(CHUNK_ELEMENT)))
# The envelope with each element kept as its JSON text (parsed after the
# explode, so the optimizer has no nested field to push below the generator).
ENVELOPE_TEXT = _struct(("chunks", T.ArrayType(S)))

BRONZE_ASSET_RAW = _struct(
    ("asset_id", S), ("client_id", S), ("raw_response", S), ("model_version", S),
    ("prompt_version", S), ("content_sha256", S), ("chunk_count", I), ("load_ts", TS),
)

SILVER_CHUNK = _struct(
    ("chunk_id", S), ("asset_id", S), ("chunk_sequence", L), ("start_sec", D),
    ("end_sec", D), ("transcript_segment", S), ("chunk_theme", S), ("sentiment", S),
    ("standalone_score", I), ("next_compatible_themes", STRS), ("keywords", STRS),
)

ASSET_MANIFEST = _struct(
    ("asset_id", S), ("client_id", S), ("content_sha256", S), ("asset_name", S),
    ("asset_type", S), ("parent_asset_id", S), ("duration_sec", I), ("source_uri", S),
    ("ingested_at", TS),
)

DIM_CLIENT = _struct(
    ("client_id", S), ("client_name", S), ("account_support_owner", S),
    ("drive_folder_id", S), ("landing_ttl_days", I), ("status", S),
)

DIM_PLATFORM = _struct(
    ("platform_id", S), ("platform_name", S), ("hook_window_sec", I), ("hold_milestones", S),
)

EDIT_DECISION_LIST = _struct(
    ("ad_id", S), ("chunk_id", S), ("chunk_role", S), ("position_in_ad", I),
    ("start_sec", D), ("end_sec", D),
)

MAP_AD_ASSET = _struct(("ad_id", S), ("asset_id", S))

COUNTERS = ("impressions", "plays_3s", "plays_25", "plays_50", "plays_75", "plays_100",
            "play_count", "link_clicks", "results")

PERF_CANONICAL = ("ad_id", "perf_date") + COUNTERS[:6] + ("sum_watch_time_sec",) + COUNTERS[6:] + ("spend",)

BRONZE_AD_PERF = _struct(
    ("ad_id", S), ("perf_date", DT), ("platform_native", S),
    *[(c, L) for c in COUNTERS],
    ("sum_watch_time_sec", DEC), ("spend", MONEY),
    ("load_ts", TS), ("source_file", S), ("content_hash", S),
)

CHUNK_EMBEDDING = _struct(("chunk_id", S), ("content_hash", S), ("embedding", VEC))

EXTRACTION_RUN_LOG = _struct(
    ("run_id", S), ("asset_id", S), ("model_version", S), ("prompt_version", S),
    ("tokens_in", L), ("tokens_out", L), ("api_cost", DEC), ("processing_time_sec", DEC),
    ("retry_count", I), ("extraction_confidence", DEC), ("load_ts", TS),
)
