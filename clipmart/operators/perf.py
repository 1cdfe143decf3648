"""Ad-platform performance: staging, union, daily fact, KPI ratios, metric
-> chunk alignment, the per-platform correlation mart and its readers.

Scale notes
* The fact is day-grained and additive: every aggregate is a partial
  (map-side) + final hash aggregate.
* Seeds (platform rows, milestone percentages) are fixed-size and broadcast;
  everything data-sized joins by key and is left to AQE (which broadcasts
  only what its runtime statistics prove small, and splits skewed keys).
* Alignment picks one chunk per (ad, platform, metric) with ``min_by`` over
  a struct of sort keys: a partial aggregate instead of a sort of every
  candidate of a hot ad inside one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipmart import schemas
from clipmart.session import materialize

# Caveat attached to every surfaced mart row.
HONESTY_NOTE = "Among winning ads only - within-platform ranking, correlation not causation"
# Evidence regime thresholds on distinct ads (n < 5, n < 12).
BLOCK_BELOW, DIRECTIONAL_BELOW = 5, 12
# Hold anchors as built (metric name, share of edited duration).
HOLD_ANCHORS = (("hold_rate_25", 0.25),)
# Coverage levels that feed the mart.
USABLE_COVERAGE = ("HIGH", "MEDIUM")
# Native export column names per platform -> canonical name.
EXPORT_COLUMNS = {
    "meta": {
        "ad_id": "ad_id", "date": "perf_date", "impressions": "impressions",
        "video_3_sec_watched_actions": "plays_3s", "video_p25_watched_actions": "plays_25",
        "video_p50_watched_actions": "plays_50", "video_p75_watched_actions": "plays_75",
        "video_p100_watched_actions": "plays_100",
        "video_avg_time_watched_actions": "avg_watch_time_sec",
        "video_play_actions": "play_count", "inline_link_clicks": "link_clicks",
        "actions_purchase": "results", "spend": "spend",
    },
    "tiktok": {
        "ad_id": "ad_id", "stat_time_day": "perf_date", "impressions": "impressions",
        "video_views_p_3s": "plays_3s", "video_views_p25": "plays_25",
        "video_views_p50": "plays_50", "video_views_p75": "plays_75",
        "video_views_p100": "plays_100", "total_watch_time": "sum_watch_time_sec",
        "video_views": "play_count", "clicks_destination": "link_clicks",
        "conversions": "results", "spend": "spend",
    },
}

#: Canonical columns without which an export row says nothing.
EXPORT_KEYS = ("ad_id", "perf_date")
CANONICAL = list(schemas.PERF_CANONICAL)


def stage(bronze: DataFrame, platform: str) -> DataFrame:
    """rows of one platform in the canonical 13 columns."""
    return bronze.where(F.col("platform_native") == platform).select(*CANONICAL)


def _typed(canonical: str):
    """How the text of a canonical (or averaged) export column is read; null where it isn't of that type."""
    kind = {"ad_id": "string", "perf_date": "date", "sum_watch_time_sec": "decimal(18,3)", "avg_watch_time_sec": "double",
            "spend": "decimal(18,2)"}.get(canonical, "long")
    return lambda c: c.try_cast(kind)


def malformed(export: DataFrame, platform: str) -> Column:
    """Array of the native columns of ``export`` that hold text of another
    type, or nothing where a key (ad, day) belongs."""
    mapping = EXPORT_COLUMNS[platform]
    bad = []
    for c in export.columns:
        if c in mapping:
            value = F.col(f"`{c}`")
            wrong = _typed(mapping[c])(value).isNull()
            bad.append(F.when(wrong if mapping[c] in EXPORT_KEYS else wrong & value.isNotNull(), F.lit(c)))
    return F.filter(F.array(*bad), lambda x: x.isNotNull())


def conform(export: DataFrame, platform: str) -> DataFrame:
    """native export columns, by name -> canonical; when only the average
    watch time exists, ``sum_watch_time_sec = avg x plays``.  A value that isn't
    of its column's type becomes null (``malformed`` names it)."""
    mapping = EXPORT_COLUMNS[platform]
    df = export.select(*(_typed(mapping[c])(F.col(f"`{c}`")).alias(mapping[c]) for c in export.columns if c in mapping))
    if "sum_watch_time_sec" not in df.columns and "avg_watch_time_sec" in df.columns:
        df = df.withColumn("sum_watch_time_sec",
                           (F.col("avg_watch_time_sec") * F.col("play_count")).cast("decimal(18,3)"))
    for c in CANONICAL:
        if c not in df.columns:
            df = df.withColumn(c, _typed(c)(F.lit(None).cast("string")))
    return df.select(*CANONICAL)


def union(meta: DataFrame, tiktok: DataFrame) -> DataFrame:
    """UNION ALL with a platform tag."""
    return meta.select(F.lit("meta").alias("platform_name"), *CANONICAL).unionByName(
        tiktok.select(F.lit("tiktok").alias("platform_name"), *CANONICAL))


def latest_pull(df: DataFrame, keys=("ad_id", "platform_native", "perf_date"), ts: str = "load_ts") -> DataFrame:
    """Keep the latest pull of each (ad, platform, day).  ``max_by``
    over a struct is a partial aggregate (no per-key sort); ties on the
    timestamp are broken by the highest content hash."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(F.col(ts), F.col("content_hash"))).alias("r"))
    return picked.select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*df.columns)


def fact(unioned: DataFrame, platform: DataFrame, ad_map: DataFrame) -> DataFrame:
    """Unioned rows -> platform id (2-row seed, broadcast) -> asset via
    the ad map.  Unmapped ads vanish, a duplicated map row multiplies, as in
    the reference."""
    p = F.broadcast(platform.select("platform_id", "platform_name"))
    j = unioned.join(p, "platform_name").join(ad_map.select("ad_id", "asset_id"), "ad_id")
    return j.select("ad_id", "platform_id", "perf_date", "asset_id",
                    "impressions", "plays_3s", "plays_25", "plays_50", "plays_75", "plays_100",
                    "sum_watch_time_sec", "play_count", "link_clicks", "results", "spend",
                    F.current_timestamp().alias("load_ts"))


def kpi_sums(fact_perf: DataFrame, keys=("ad_id", "platform_id")) -> DataFrame:
    """A1: sums of the counters per ad x platform (lifetime, or finer by ``keys``)."""
    return fact_perf.groupBy(*keys).agg(
        F.sum("impressions").alias("impressions"), F.sum("plays_3s").alias("plays_3s"),
        F.sum("plays_25").alias("plays_25"), F.sum("plays_50").alias("plays_50"),
        F.sum("sum_watch_time_sec").alias("watch_sec"), F.sum("play_count").alias("play_count"),
        F.sum("link_clicks").alias("link_clicks"), F.sum("results").alias("results"),
        F.sum("spend").alias("spend"))


def _ratio(num: str, den: str) -> Column:
    return F.col(num).cast("double") / F.nullif(F.col(den), F.lit(0))


def kpi(fact_perf: DataFrame, with_hold_50: bool = False, keys=("ad_id", "platform_id")) -> DataFrame:
    """A2: ratio of sums, NULL on a zero denominator (never a division error)."""
    s = kpi_sums(fact_perf, keys)
    cols = [
        _ratio("plays_3s", "impressions").alias("hook_rate"),
        _ratio("plays_25", "plays_3s").alias("hold_rate_25"),
        _ratio("watch_sec", "play_count").alias("avg_play_time_sec"),
        _ratio("link_clicks", "impressions").alias("ctr_link"),
        _ratio("spend", "results").alias("cpa"),
        _ratio("results", "link_clicks").alias("cvr"),
    ]
    if with_hold_50:
        cols.append(_ratio("plays_50", "plays_3s").alias("hold_rate_50"))
    return s.select(*keys, *cols)


def bridge_ad_chunk(edl: DataFrame, fact_chunk: DataFrame) -> DataFrame:
    """Resolve each EDL row's asset from its chunk; unknown chunks drop."""
    fc = fact_chunk.select("chunk_id", "asset_id")
    return edl.join(fc, "chunk_id").select("ad_id", "chunk_id", "asset_id", "chunk_role",
                                           "position_in_ad", "start_sec", "end_sec")


def ad_platforms(fact_perf: DataFrame) -> DataFrame:
    """A5: distinct (ad, platform), aggregated before any join."""
    return fact_perf.select("ad_id", "platform_id").distinct()


def anchors(fact_perf: DataFrame, platform: DataFrame, ad_map: DataFrame, asset: DataFrame,
            holds=HOLD_ANCHORS) -> DataFrame:
    """Hook anchor = platform hook window; hold anchor = pct x
    edited duration.  The milestone list is a fixed literal array exploded
    per row (no cross join)."""
    ap = ad_platforms(fact_perf)
    hook = ap.join(F.broadcast(platform.select("platform_id", "hook_window_sec")), "platform_id") \
        .select("ad_id", "platform_id", F.lit("hook_rate").alias("metric_name"),
                F.col("hook_window_sec").cast("double").alias("anchor_sec"))
    ms = F.array(*[F.struct(F.lit(n).alias("metric_name"), F.lit(p).cast("double").alias("pct"))
                   for n, p in holds])
    hold = (ap.join(ad_map.select("ad_id", "asset_id"), "ad_id")
            .join(asset.select("asset_id", "duration_sec"), "asset_id")
            .select("ad_id", "platform_id", "duration_sec", F.explode(ms).alias("m"))
            .select("ad_id", "platform_id", F.col("m.metric_name").alias("metric_name"),
                    (F.col("m.pct") * F.col("duration_sec")).alias("anchor_sec")))
    return hook.unionByName(hold)


def align(anchor: DataFrame, bridge: DataFrame) -> DataFrame:
    """The one chunk whose [start, end) holds the anchor (HIGH), else
    the nearest (MEDIUM).  Rank keys: contains first; overlap
    ``least(end, a) - greatest(start, a)`` desc (0 inside, minus the gap
    outside); position asc (NULLs last); chunk_id as the final tie-break."""
    j = anchor.join(bridge.select("ad_id", "chunk_id", "chunk_role", "position_in_ad",
                                  "start_sec", "end_sec"), "ad_id")
    a, s, e = F.col("anchor_sec"), F.col("start_sec"), F.col("end_sec")
    inside = (a >= s) & (a < e)
    overlap = F.least(e, a) - F.greatest(s, a)
    key = F.struct(
        F.when(inside, 0).otherwise(1).alias("k0"),
        overlap.isNull().alias("k1n"), (-overlap).alias("k1"),
        F.col("position_in_ad").isNull().alias("k2n"), F.col("position_in_ad").alias("k2"),
        F.col("chunk_id").alias("k3"))
    val = F.struct("chunk_id", "chunk_role",
                   F.when(inside, "HIGH").otherwise("MEDIUM").alias("coverage_confidence"))
    picked = j.groupBy("ad_id", "platform_id", "metric_name").agg(F.min_by(val, key).alias("p"))
    return picked.select("ad_id", "platform_id", "metric_name", "p.chunk_id", "p.chunk_role",
                         "p.coverage_confidence")


def align_role(ap: DataFrame, bridge: DataFrame, role: str = "cta",
               metric: str = "ctr_link") -> DataFrame:
    """Role-anchored metric -> first chunk with that role; ads with no
    such chunk get no row."""
    b = bridge.where(F.col("chunk_role") == role)
    j = ap.join(b.select("ad_id", "chunk_id", "chunk_role", "position_in_ad"), "ad_id")
    key = F.struct(F.col("position_in_ad").isNull().alias("n"), F.col("position_in_ad").alias("p"),
                   F.col("chunk_id").alias("c"))
    picked = j.groupBy("ad_id", "platform_id").agg(
        F.min_by(F.struct("chunk_id", "chunk_role"), key).alias("p"))
    return picked.select("ad_id", "platform_id", F.lit(metric).alias("metric_name"),
                         "p.chunk_id", "p.chunk_role", F.lit("HIGH").alias("coverage_confidence"))


def alignment(fact_perf, platform, ad_map, asset, bridge) -> DataFrame:
    """Time-aligned and role-aligned rows together."""
    return align(anchors(fact_perf, platform, ad_map, asset), bridge).unionByName(
        align_role(ad_platforms(fact_perf), bridge))


def named_metric() -> Column:
    """The KPI that ``metric_name`` names."""
    return (F.when(F.col("metric_name") == "hook_rate", F.col("hook_rate"))
            .when(F.col("metric_name") == "hold_rate_25", F.col("hold_rate_25"))
            .when(F.col("metric_name") == "ctr_link", F.col("ctr_link")))


def metric_chunk(al: DataFrame, k: DataFrame, fact_chunk: DataFrame) -> DataFrame:
    """Metric value by name + the owning chunk's features."""
    value = named_metric()
    fc = fact_chunk.select("chunk_id", "chunk_theme", "sentiment", "standalone_score")
    j = al.where(F.col("coverage_confidence").isin(*USABLE_COVERAGE)) \
        .join(k, ["ad_id", "platform_id"]).join(fc, "chunk_id")
    return j.select("ad_id", "platform_id", "metric_name", value.alias("metric_value"),
                    "chunk_id", "chunk_role", "coverage_confidence",
                    "chunk_theme", "sentiment", "standalone_score")


def feature_rows(mc: DataFrame, dims=("chunk_theme",)) -> DataFrame:
    """(platform, metric, feature_dim, feature_value, ad, value) for every
    requested feature dimension, via one explode of literal (dim, value)
    pairs per row."""
    pairs = F.array(*[F.struct(F.lit(d).alias("d"), F.col(d).cast("string").alias("v")) for d in dims])
    return (mc.where(F.col("metric_value").isNotNull())
            .select("platform_id", "metric_name", "ad_id", "metric_value", F.explode(pairs).alias("f"))
            .select("platform_id", "metric_name", F.col("f.d").alias("feature_dim"),
                    F.col("f.v").alias("feature_value"), "ad_id", "metric_value"))


def regime(n: Column) -> Column:
    """Sample-size gate (as coded: n only, not the stricter doc rule)."""
    return (F.when(n < BLOCK_BELOW, "BLOCK").when(n < DIRECTIONAL_BELOW, "DIRECTIONAL")
            .otherwise("SUGGESTIVE"))


def exact_median(df: DataFrame, group: list[str], value: str, alias: str = "median_metric") -> DataFrame:
    """Exact median per group (mean of the two middle values for an even
    count, as DuckDB and Spark's percentile interpolate), without gathering
    a group in one task: tie counts per (group, value), distributed prefix
    sums (stats.rows_before), then the values whose rank interval holds the
    middle positions.  NULL values are ignored; an all-NULL group has a
    NULL median."""
    from clipmart.operators.stats import rows_before

    v = df.where(F.col(value).isNotNull())
    ties = v.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_t"))
    r = rows_before(ties, group, value, count="_t")
    n = ties.groupBy(*group).agg(F.sum("_t").alias("_n"))
    r = r.join(n, group)
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.ceil((F.col("_n") - 1) / 2)
    holds = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("_t"))
    m = r.groupBy(*group).agg(F.max(F.when(holds(lo), F.col(value))).alias("_lo"),
                              F.max(F.when(holds(hi), F.col(value))).alias("_hi"))
    return m.select(*group, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * 0.5).alias(alias))


def rank_descending(df: DataFrame, group: list[str], value: str, alias: str) -> DataFrame:
    """Rank (ties share the lowest, NULLs last) by ``value`` descending in
    each group, without sorting a group in one task: 1 plus the number of
    larger values, from tie counts and distributed prefix sums."""
    from clipmart.operators.stats import rows_before

    ties = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_t"))
    before = rows_before(ties, group, value, count="_t").select(*group, value, (F.col("before") + F.col("_t")).alias("_upto"))
    n = df.groupBy(*group).agg(F.count(value).alias("_n"))
    ranked = df.join(before, [*group, value], "left").join(n, group)
    return ranked.select(*df.columns, (F.col("_n") - F.coalesce("_upto", F.lit(0)) + 1).cast("long").alias(alias))


def correlation(mc: DataFrame, dims=("chunk_theme",), extended: bool = False) -> DataFrame:
    """A3/A4 + W3 + A6: distinct ads and exact median per (platform, metric,
    dim, value); rank by median within (platform, metric) across all dims.

    The exact median is computed with distributed prefix sums
    (``exact_median``), so a feature value that holds a third of all ads is
    never gathered in one task."""
    base = feature_rows(mc, dims)
    key = ["platform_id", "metric_name", "feature_dim", "feature_value"]
    aggs = [F.count_distinct("ad_id").alias("n_ads")]
    if extended:
        aggs += [F.avg("metric_value").alias("mean_metric"), F.min("metric_value").alias("min_metric"),
                 F.max("metric_value").alias("max_metric")]
    g = base.groupBy(*key).agg(*aggs).join(exact_median(base, key, "metric_value"), key)
    cols = key + ["n_ads", "median_metric"] + (["mean_metric", "min_metric", "max_metric"] if extended else [])
    # stored once: the tie counts, the totals and the result all read it
    g = materialize(g.select(*cols))
    return rank_descending(g, ["platform_id", "metric_name"], "median_metric", "rank_in_platform").select(
                    "*",
                    regime(F.col("n_ads")).alias("evidence_regime"),
                    F.lit(HONESTY_NOTE).alias("honesty_note"))


class Models(dict):
    """Tables by name; one that isn't there yet is built from the others when
    it is first read, so a reader pays for what it reads and no more."""

    def __init__(self, how: dict, **given):
        super().__init__(given)
        self.how = how

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.how[name](self)
        return self[name]


#: How each model of the chain follows from others.  Those that several models
#: read (the day-grained fact, the bridge, the metric rows, the mart) are materialised.
CHAIN = {
    "int_ad_perf_unioned": lambda m: union(stage(m["bronze_perf"], "meta"), stage(m["bronze_perf"], "tiktok")),
    "fact_ad_performance": lambda m: materialize(fact(m["int_ad_perf_unioned"], m["platform"], m["ad_map"])),
    "fct_ad_kpi": lambda m: kpi(m["fact_ad_performance"]),
    "bridge_ad_chunk": lambda m: materialize(bridge_ad_chunk(m["edl"], m["fact_chunk"])),
    "int_metric_chunk_alignment": lambda m: alignment(
        m["fact_ad_performance"], m["platform"], m["ad_map"], m["dim_asset"], m["bridge_ad_chunk"]),
    "fct_ad_metric_chunk": lambda m: materialize(
        metric_chunk(m["int_metric_chunk_alignment"], m["fct_ad_kpi"], m["fact_chunk"])),
    "mart_chunk_perf_correlation": lambda m: materialize(correlation(m["fct_ad_metric_chunk"])),
}


def build(bronze_perf, platform, ad_map, asset, edl, fact_chunk) -> Models:
    """C4: the 8-model chain to the correlation mart, built as it is read."""
    return Models(CHAIN, bronze_perf=bronze_perf, platform=platform, ad_map=ad_map, dim_asset=asset, edl=edl,
                  fact_chunk=fact_chunk)


def surfaced(mart: DataFrame, metric: str | None = None, dim: str | None = None) -> DataFrame:
    """F16: never surface BLOCK; keep the caveat column."""
    m = mart.where(F.col("evidence_regime") != "BLOCK")
    if metric:
        m = m.where(F.col("metric_name") == metric)
    if dim:
        m = m.where(F.col("feature_dim") == dim)
    return m.select("platform_id", "metric_name", "feature_dim", "feature_value", "n_ads",
                    F.round("median_metric", 4).alias("median_metric"), "rank_in_platform",
                    "evidence_regime", "honesty_note")


def mine_unused(fact_chunk: DataFrame, asset: DataFrame, mart: DataFrame, bridge: DataFrame,
                metric: str = "hook_rate", top: int = 3, min_score: int = 4) -> DataFrame:
    """RAW-asset chunks whose theme is among the top non-BLOCK themes
    for a metric, score >= min_score, never used in any ad.  The top list is
    a per-platform rank filter (bounded by ``top`` x platforms); NOT IN is
    written as an anti join on non-NULL keys."""
    best = (mart.where((F.col("metric_name") == metric) & (F.col("evidence_regime") != "BLOCK")
                       & (F.col("feature_dim") == "chunk_theme") & (F.col("rank_in_platform") <= top))
            .select(F.col("feature_value").alias("chunk_theme")).distinct())
    raw = asset.where(F.col("asset_type") == "RAW").select("asset_id")
    used = bridge.where(F.col("chunk_id").isNotNull()).select("chunk_id")
    return (fact_chunk.where(F.col("standalone_score") >= min_score)
            .join(raw, "asset_id", "left_semi")
            .join(best, "chunk_theme", "left_semi")
            .join(used, "chunk_id", "left_anti")
            .select("chunk_id", "asset_id", "chunk_theme", "standalone_score", "start_sec", "end_sec", "transcript_segment"))


def rank_agreement(mart: DataFrame, top: int = 3) -> DataFrame:
    """M5: a feature value in the top-n of the same metric on two platforms.
    Only ranks are compared, never pooled numbers.  Self-join on (metric,
    dim, value) of the top-n rows only: at most n rows per platform side."""
    t = mart.where((F.col("rank_in_platform") <= top) & (F.col("evidence_regime") != "BLOCK")) \
        .select("platform_id", "metric_name", "feature_dim", "feature_value", "rank_in_platform")
    a, b = t.alias("a"), t.alias("b")
    j = a.join(b, (F.col("a.metric_name") == F.col("b.metric_name"))
               & (F.col("a.feature_dim") == F.col("b.feature_dim"))
               & (F.col("a.feature_value") == F.col("b.feature_value"))
               & (F.col("a.platform_id") < F.col("b.platform_id")))
    return j.select(F.col("a.metric_name").alias("metric_name"),
                    F.col("a.feature_dim").alias("feature_dim"),
                    F.col("a.feature_value").alias("feature_value"),
                    F.col("a.platform_id").alias("platform_a"),
                    F.col("a.rank_in_platform").alias("rank_a"),
                    F.col("b.platform_id").alias("platform_b"),
                    F.col("b.rank_in_platform").alias("rank_b"))
