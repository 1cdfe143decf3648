"""Mergeable sketches of the correlation mart (the scale option of A3).

The exact mart reads every ad's lifetime numbers again for each period asked
for.  Here every day is summarised once per (platform, metric, feature
dimension, feature value): a KLL sketch of the ads' values that day and an HLL
sketch of the ads.  Days are small rows that merge into any period, so a period
costs its days and not its ads.

Error: the rank of an estimated median is off by at most ``RANK_ERROR`` of all
values, the number of ads by at most ``ADS_ERROR`` of it, both several standard
deviations wide for ``KLL_K`` and ``HLL_BITS``; counts, minimum and maximum are
exact.  NULL values take no part.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipmart.operators import perf

KLL_K, HLL_BITS = 400, 12
RANK_ERROR, ADS_ERROR = 0.02, 0.065
KEY = ["platform_id", "metric_name", "feature_dim", "feature_value"]


def daily_rows(mc: DataFrame, fact_perf: DataFrame, dims=("chunk_theme",)) -> DataFrame:
    """(key, ad, day, value of that day) for the chunks that own a metric."""
    days = perf.kpi(fact_perf, keys=("ad_id", "platform_id", "perf_date"))
    rows = mc.select("ad_id", "platform_id", "metric_name", *dims).join(days, ["ad_id", "platform_id"])
    rows = rows.select("ad_id", "platform_id", "metric_name", "perf_date", perf.named_metric().alias("metric_value"), *dims)
    pairs = F.array(*[F.struct(F.lit(d).alias("d"), F.col(d).cast("string").alias("v")) for d in dims])
    return (rows.where(F.col("metric_value").isNotNull()).withColumn("f", F.explode(pairs))
            .select("platform_id", "metric_name", F.col("f.d").alias("feature_dim"), F.col("f.v").alias("feature_value"),
                    "perf_date", "ad_id", "metric_value"))


def by_day(rows: DataFrame) -> DataFrame:
    """One stored row per key and day; partial aggregates, so a hot value is
    summarised where its rows are."""
    return rows.groupBy(*KEY, "perf_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("metric_value").alias("min_metric"), F.max("metric_value").alias("max_metric"),
        F.kll_sketch_agg_double("metric_value", F.lit(KLL_K)).alias("values"), F.hll_sketch_agg("ad_id", F.lit(HLL_BITS)).alias("ads"))


def merged(days: DataFrame, *period: str) -> DataFrame:
    """Estimates per key, over all days given or per ``period`` column; filter
    ``days`` for a period of any other kind."""
    g = days.groupBy(*KEY, *period).agg(
        F.sum("n_rows").alias("n_rows"), F.min("min_metric").alias("min_metric"), F.max("max_metric").alias("max_metric"),
        F.kll_merge_agg_double("values", F.lit(KLL_K)).alias("values"), F.hll_union_agg("ads").alias("ads"))
    return g.select(*KEY, *period, "n_rows", "min_metric", "max_metric",
                    F.hll_sketch_estimate("ads").alias("n_ads"),
                    F.kll_sketch_get_quantile_double("values", F.lit(0.5)).alias("median_metric"))


def within_bounds(estimates: DataFrame, rows: DataFrame, *period: str) -> DataFrame:
    """The estimates held against all rows: ``n_ads_exact``, and whether the
    median's rank and the number of ads lie within the stated errors."""
    est = estimates.select(*KEY, *period, "n_rows", "min_metric", "max_metric", F.col("n_ads").alias("_ads"),
                           F.col("median_metric").alias("_m"))
    # keys may be null, as a chunk's theme may be
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in [*KEY, *period]]
    each = rows.alias("r").join(est.alias("e"), same).groupBy(*(F.col(f"e.{c}") for c in est.columns)).agg(
        F.count_distinct("r.ad_id").alias("n_ads_exact"),
        F.count_if(F.col("r.metric_value") < F.col("e._m")).alias("_below"),
        F.count_if(F.col("r.metric_value") <= F.col("e._m")).alias("_upto"))
    return each.select(
        *KEY, *period, "n_rows", "min_metric", "max_metric", "n_ads_exact",
        ((F.col("_below") <= (0.5 + RANK_ERROR) * F.col("n_rows")) & (F.col("_upto") >= (0.5 - RANK_ERROR) * F.col("n_rows")))
        .alias("median_within"),
        (F.abs(F.col("_ads") - F.col("n_ads_exact")) <= ADS_ERROR * F.col("n_ads_exact")).alias("n_ads_within"))
