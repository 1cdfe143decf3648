"""Data-quality checks.

A check is ``(check_id, severity, failing rows)``.  ``run`` evaluates a list
of checks in one pass per check and returns the metrics table (check,
failed, severity, status) plus the failing rows tagged with the check id
(the audit table, K7).  ``warn`` logs and continues; ``error`` fails the
run when asked to enforce.  NULL passes every value rule, as in the
reference's tests.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted value lists of the reference's column tests.
SENTIMENTS = ["energetic", "frustrated", "aspirational", "neutral", "urgent", "calm"]
CHUNK_ROLES = ["hook", "body", "social_proof", "cta"]
ASSET_TYPES = ["RAW", "EDITED"]
PLATFORMS = ["meta", "tiktok"]
COUNTERS = ["impressions", "plays_3s", "plays_25", "plays_50", "plays_75", "plays_100", "sum_watch_time_sec",
            "play_count", "link_clicks", "results", "spend"]
REGIMES = ["BLOCK", "DIRECTIONAL", "SUGGESTIVE"]
# Silver promotion threshold (share of rows passing all gates).
PROMOTE_AT = 0.95


@dataclass
class Check:
    check_id: str
    severity: str
    failing: DataFrame


def not_null(df: DataFrame, col: str) -> DataFrame:
    """D1."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Each repeated value once with its count (partial aggregate)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows")) \
        .where(F.col("n_rows") > 1)


def accepted_values(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """D3: non-NULL values outside the list."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*values))


def between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """One- or two-sided, inclusive; NULL passes."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return df.where(c.isNotNull() & bad)


def relationships(child: DataFrame, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Child rows with a non-NULL key absent from the parent."""
    keys = parent.select(F.col(pcol).alias(col)).where(F.col(col).isNotNull())
    return child.where(F.col(col).isNotNull()).join(keys, col, "left_anti")


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """D6."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def row_count_floor(df: DataFrame, n: int = 1) -> DataFrame:
    """One row (the count) when the table has fewer than n rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") < n)


def orphans(child: DataFrame, parent: DataFrame, col: str) -> DataFrame:
    """Child rows that an inner join on ``col`` would drop.  A NULL
    key is an orphan too (the reference tests it with a left join)."""
    keys = parent.select(col).where(F.col(col).isNotNull())
    return child.join(keys, col, "left_anti")


def assembly_safe(ends: DataFrame, fact: DataFrame, min_score: int = 4) -> DataFrame:
    """Chunks that stand at an end of some assembled pair
    (``assemble.endpoints``) and score below the floor.  A pair is unsafe
    exactly if one of its ends is, so no pair has to be built."""
    low = fact.where((F.col("standalone_score") < min_score) | F.col("standalone_score").isNull())
    return ends.join(low.select("chunk_id", "standalone_score"), "chunk_id").select("chunk_id", "role", "standalone_score")


def json_gate(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Envelopes that do not parse (or carry no chunk array) go to
    quarantine with a reason; the batch goes on.  An empty array is legal."""
    from clipmart.operators.silver import parse_envelope

    p = bronze.withColumn("_env", parse_envelope(F.col("raw_response")))
    reason = (F.when(F.col("raw_response").isNull(), "null_envelope")
              .when(F.try_parse_json("raw_response").isNull(), "unparsable_envelope")
              .when(F.col("_env.chunks").isNull(), "missing_chunks"))
    p = p.withColumn("reason", reason).drop("_env")
    return p.where(F.col("reason").isNull()).drop("reason"), p.where(F.col("reason").isNotNull())


def _reasons(df: DataFrame) -> Column:
    """Row rules; the two list fields are optional, so their absence breaks none."""
    rules = [
        (F.col("standalone_score").isNull(), "score_missing_or_malformed"),
        (~F.col("standalone_score").between(1, 5), "score_out_of_range"),
        (F.col("sentiment").isNotNull() & ~F.col("sentiment").isin(*SENTIMENTS), "sentiment_not_accepted"),
        (F.col("chunk_theme").isNull() | (F.trim(F.col("chunk_theme")) == ""), "theme_empty"),
        (F.col("start_sec").isNull() | F.col("end_sec").isNull(), "time_missing_or_malformed"),
        (F.col("end_sec") < F.col("start_sec"), "time_reversed"),
    ]
    arr = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for cond, name in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def quarantine(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One scan computes the reason array; rows with reasons are
    quarantined, the rest pass."""
    r = silver.withColumn("reasons", _reasons(silver))
    return r.where(F.size("reasons") == 0).drop("reasons"), r.where(F.size("reasons") > 0)


def pass_rate(silver: DataFrame) -> DataFrame:
    """Share of rows passing all row gates, and the promotion verdict."""
    ok = (F.size(_reasons(silver)) == 0).cast("int")
    return silver.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(ok).alias("n_pass"),
                      F.avg(ok).alias("pass_rate")) \
        .withColumn("promote", F.coalesce(F.col("pass_rate") >= PROMOTE_AT, F.lit(False)))


def perf_release(kpi: DataFrame, fact_perf: DataFrame, mc: DataFrame, mart: DataFrame,
                 asset: DataFrame, ad_map: DataFrame, bridge: DataFrame, captured: DataFrame,
                 alignment: DataFrame, shown: DataFrame | None = None) -> DataFrame:
    """Release gates of the performance marts, one row per violation
    (rule, key).  Gates on what was left out compare with the input of the
    step that leaves it out: ``captured`` (all ad rows, for the mapping),
    ``alignment`` (for the coverage) and ``shown`` (what readers get, by
    default ``perf.surfaced``, for the sample-size gate)."""
    from clipmart.operators import perf

    def broken(df: DataFrame, rule: str, *key) -> DataFrame:
        return df.select(F.lit(rule).alias("rule"), F.concat_ws("|", *key).alias("key"))

    def entries(df: DataFrame, cols: list[str], *keep: str) -> DataFrame:
        return df.select(*keep, F.explode(F.array(*(
            F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols))).alias("x"))

    per_metric = ["ad_id", "platform_id", "metric_name"]
    rates = entries(kpi, ["hook_rate", "hold_rate_25", "ctr_link", "cvr"], "ad_id", "platform_id")
    counters = entries(fact_perf, [c for c in perf.CANONICAL if c in COUNTERS], "ad_id", "platform_id", "perf_date")
    edited = asset.where(F.col("asset_type") == "EDITED").select("asset_id")
    ads = fact_perf.select("ad_id", "asset_id").distinct()
    shown = perf.surfaced(mart) if shown is None else shown
    value = ["platform_id", "metric_name", "feature_dim", "feature_value"]
    low = alignment.where(~F.col("coverage_confidence").isin("HIGH", "MEDIUM")).select(*per_metric, "chunk_id")
    found = [
        broken(rates.where(~F.col("x.value").between(0, 1)), "rate_in_unit_interval", "ad_id", "platform_id", "x.name"),
        broken(counters.where(F.col("x.value") < 0), "counter_not_negative", "ad_id", "platform_id", "perf_date", "x.name"),
        broken(fact_perf.where(~F.col("platform_id").isin(*PLATFORMS)), "platform_accepted", "ad_id", "platform_id"),
        broken(bridge.where(~F.col("chunk_role").isin(*CHUNK_ROLES)), "role_accepted", "ad_id", "chunk_id", "chunk_role"),
        broken(ads.join(edited, "asset_id", "left_anti"), "edited_only_fk", "ad_id", "asset_id"),
        broken(ads.select("ad_id").distinct().join(bridge.select("ad_id"), "ad_id", "left_anti"), "ad_has_chunk", "ad_id"),
        broken(captured.select("ad_id").distinct().join(ad_map.where(F.col("asset_id").isNotNull()).select("ad_id"),
                                                        "ad_id", "left_anti"), "no_unmapped_ad", "ad_id"),
        broken(mc.groupBy(*per_metric).count().where(F.col("count") != 1), "one_row_per_metric", *per_metric),
        broken(mc.join(low, [*per_metric, "chunk_id"], "left_semi"), "low_coverage_excluded", *per_metric),
        broken(shown.join(mart.where(F.col("n_ads") < perf.BLOCK_BELOW).select(*value), value, "left_semi"),
               "block_never_surfaced", *value),
    ]
    out = found[0]
    for d in found[1:]:
        out = out.unionByName(d)
    return out


def row_diff(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Exact multiset diff both ways, tagged by side."""
    cols = expected.columns
    a = actual.select(*cols)
    return a.exceptAll(expected).withColumn("side", F.lit("unexpected")).unionByName(
        expected.exceptAll(a).withColumn("side", F.lit("missing")))


def drift(run_a: DataFrame, run_b: DataFrame, key: str = "chunk_id",
          fields=("chunk_theme", "sentiment", "standalone_score", "start_sec", "end_sec",
                  "transcript_segment")) -> DataFrame:
    """Two extractions of the same assets compared by chunk; one row
    per chunk that appears on one side only or has changed fields.  Drift
    is reported, never blocking."""
    a = run_a.select(key, *[F.col(f).alias(f"a_{f}") for f in fields]).withColumn("_a", F.lit(True))
    b = run_b.select(key, *[F.col(f).alias(f"b_{f}") for f in fields]).withColumn("_b", F.lit(True))
    j = a.join(b, key, "full")
    changed = [F.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), F.lit(f)) for f in fields]
    j = j.select(key, F.coalesce(F.col("_a"), F.lit(False)).alias("in_a"),
                 F.coalesce(F.col("_b"), F.lit(False)).alias("in_b"),
                 F.filter(F.array(*changed), lambda x: x.isNotNull()).alias("changed"))
    j = j.withColumn("changed", F.when(F.col("in_a") & F.col("in_b"), F.col("changed"))
                     .otherwise(F.array().cast("array<string>")))
    return j.where(~F.col("in_a") | ~F.col("in_b") | (F.size("changed") > 0)) \
        .withColumn("n_changed", F.size("changed").cast("long"))


def run(checks: list[Check], run_ts=None) -> tuple[DataFrame, DataFrame]:
    """Evaluate checks: (metrics, failures).  Failing rows are kept as JSON
    text with the check id so one audit table holds every check."""
    assert checks, "no checks"
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    fails = None
    for c in checks:
        f = c.failing.select(F.lit(c.check_id).alias("check_id"), F.lit(c.severity).alias("severity"),
                             F.to_json(F.struct(*c.failing.columns)).alias("failing_row"))
        fails = f if fails is None else fails.unionByName(f)
    fails = fails.withColumn("run_ts", ts)
    spark = checks[0].failing.sparkSession
    ids = spark.createDataFrame([(c.check_id, c.severity) for c in checks], "check_id string, severity string")
    counts = fails.groupBy("check_id").agg(F.count(F.lit(1)).alias("failed"))
    metrics = ids.join(counts, "check_id", "left").fillna(0, ["failed"]).withColumn(
        "status", F.when(F.col("failed") == 0, "pass")
        .when(F.col("severity") == "error", "fail").otherwise("warn"))
    return metrics, fails


def enforce(metrics: DataFrame) -> None:
    """Raise when any error-severity check failed (warn never blocks)."""
    bad = metrics.where(F.col("status") == "fail").select("check_id").collect()
    if bad:
        raise RuntimeError("data-quality errors: " + ", ".join(r.check_id for r in bad))


# Golden agreement thresholds (token Jaccard, score tolerance,
# share of agreeing chunks for a pass).
GOLDEN_JACCARD, GOLDEN_SCORE_TOL, GOLDEN_PASS = 0.8, 1, 0.8


def golden_agreement(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Chunks of a new run matched to the golden answer by chunk_id;
    a chunk agrees when the token Jaccard of the transcripts is at least
    0.8 and the score is within +-1.  An asset passes at >= 80 % agreeing
    chunks (missing chunks count as disagreeing)."""
    from clipmart.functions.text import tokens

    e = expected.select("chunk_id", "asset_id", F.array_distinct(tokens("transcript_segment")).alias("te"),
                        F.col("standalone_score").alias("se"))
    a = actual.select("chunk_id", F.array_distinct(tokens("transcript_segment")).alias("ta"),
                      F.col("standalone_score").alias("sa"))
    j = e.join(a, "chunk_id", "left")
    inter = F.size(F.array_intersect("te", "ta"))
    union = F.size(F.array_union("te", "ta"))
    jac = F.when(union == 0, F.lit(1.0)).otherwise(inter / union)
    agree = F.col("ta").isNotNull() & (jac >= GOLDEN_JACCARD) & \
        (F.abs(F.col("se") - F.col("sa")) <= GOLDEN_SCORE_TOL)
    per = j.groupBy("asset_id").agg(F.count(F.lit(1)).alias("n_chunks"),
                                    F.count_if(agree).alias("n_agree"))
    return per.withColumn("agreement", F.col("n_agree") / F.col("n_chunks")) \
        .withColumn("passed", F.col("agreement") >= GOLDEN_PASS)
