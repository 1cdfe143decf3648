"""Significance of the per-platform winner: Mann-Whitney U per family,
Bonferroni across the families tested in a run, written back as a new
version of the mart.

A family is (platform, metric, feature_dim).  Its test compares the
best-ranked SUGGESTIVE value against every other value of the family.
Ranks are computed without gathering a family in one task: ties are first
counted per (family, value) (map-side partial aggregate), then a
distributed prefix sum over the distinct values (``rows_before``) gives
each value its average rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipmart.functions.pvalues import mwu_pvalue
from clipmart.session import bounded_broadcast, materialize

FAMILY = ["platform_id", "metric_name", "feature_dim"]
MART_KEY = FAMILY + ["feature_value"]
# Significance level after correction.
ALPHA = 0.05


def top_suggestive(mart: DataFrame) -> DataFrame:
    """Best-ranked SUGGESTIVE value per family (ties -> smaller value)."""
    s = mart.where(F.col("evidence_regime") == "SUGGESTIVE")
    return s.groupBy(*FAMILY).agg(
        F.min_by("feature_value", F.struct("rank_in_platform", "feature_value")).alias("top_value"))


def rows_before(ties: DataFrame, family: list[str], value: str, count: str = "t",
                partitions: int | None = None) -> DataFrame:
    """Add ``before`` = number of pooled values smaller than ``value`` in
    its family, for a table with one row per (family, value) and its tie
    count.  Distributed prefix sum: range-partition by (family, value),
    prefix sums inside each (slice, family), then add the totals of the
    earlier slices of the same family (a table of at most families x slices
    rows).  No family is ever gathered in one task.

    The slice of every row is stored with it before anything reads it: range
    bounds come from a sample and partitions may be merged at run time, so
    two readers that each partitioned the rows would not agree on slices."""
    r = ties.repartitionByRange(partitions, *family, value) if partitions \
        else ties.repartitionByRange(*family, value)
    r = materialize(r.withColumn("_pid", F.spark_partition_id()))
    local = Window.partitionBy("_pid", *family).orderBy(value) \
        .rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("_local", F.coalesce(F.sum(count).over(local), F.lit(0)))
    tot = r.groupBy(*family, "_pid").agg(F.sum(count).alias("_tot"))
    prev = Window.partitionBy(*family).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.withColumn("_off", F.coalesce(F.sum("_tot").over(prev), F.lit(0))).drop("_tot")
    return r.join(off, [*family, "_pid"]) \
        .withColumn("before", F.col("_local") + F.col("_off")).drop("_pid", "_local", "_off")


def average_ranks(df: DataFrame, family: list[str], value: str) -> DataFrame:
    """(family, value, t, avg_rank) with average ranks for ties over
    the pooled sample; one row per distinct value."""
    ties = df.groupBy(*family, value).agg(F.count(F.lit(1)).alias("t"))
    return rows_before(ties, family, value).withColumn("avg_rank", F.col("before") + (F.col("t") + 1) / 2.0) \
        .drop("before")


def mann_whitney(base: DataFrame, mart: DataFrame) -> DataFrame:
    """M1: one row per family with n1, n2, U, z-inputs and the raw p-value.
    ``base`` has (platform_id, metric_name, feature_dim, feature_value, ad_id,
    metric_value).  Families with an empty side are skipped; a family whose
    values are all equal has no test (NULL p, not counted)."""
    top = top_suggestive(mart)
    # one row per family; counted before it is broadcast, so that no large family is shuffled to one task
    rows = base.where(F.col("metric_value").isNotNull()).join(bounded_broadcast(top), FAMILY) \
        .withColumn("is_top", F.col("feature_value") == F.col("top_value"))
    ties = rows.groupBy(*FAMILY, "top_value", "metric_value").agg(
        F.count(F.lit(1)).alias("t"), F.count_if("is_top").alias("c1"))
    ranked = rows_before(ties, FAMILY, "metric_value") \
        .withColumn("avg_rank", F.col("before") + (F.col("t") + 1) / 2.0)
    fam = ranked.groupBy(*FAMILY, "top_value").agg(
        F.sum(F.col("c1") * F.col("avg_rank")).alias("r1"),
        F.sum("c1").alias("n1"),
        F.sum("t").alias("n"),
        F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("tie_term"),
        F.max("t").alias("max_t"),
        F.count(F.lit(1)).alias("n_values"))
    fam = fam.withColumn("n2", F.col("n") - F.col("n1")) \
        .where((F.col("n1") >= 1) & (F.col("n2") >= 1))
    u1 = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2.0
    fam = fam.withColumn("u1", u1).withColumn(
        "u", F.greatest(F.col("u1"), F.col("n1") * F.col("n2") - F.col("u1")))
    tested = F.col("n_values") > 1
    p = mwu_pvalue(F.col("n1"), F.col("n2"), F.col("u"), F.col("tie_term"), F.col("max_t") > 1)
    return fam.select(*FAMILY, F.col("top_value").alias("feature_value"),
                      F.col("n1").cast("long").alias("n1"), F.col("n2").cast("long").alias("n2"),
                      F.col("u1"), F.col("u"), F.col("tie_term"),
                      F.when(tested, p).alias("p_raw"))


def bonferroni(tests: DataFrame) -> DataFrame:
    """P x (number of families tested in this run), capped at 1.  The
    count is a global aggregate over the (small) family table."""
    done = tests.where(F.col("p_raw").isNotNull())
    w = Window.partitionBy()  # one row per family: tiny by construction
    n_tests = F.count(F.lit(1)).over(w)
    return done.select(*MART_KEY, "p_raw",
                       F.least(F.col("p_raw") * n_tests, F.lit(1.0)).alias("p_value")) \
        .withColumn("is_significant", F.col("p_value") < ALPHA)


def scored_mart(mart: DataFrame, tests: DataFrame) -> DataFrame:
    """K5: mart + p_value / is_significant (NULL / false for rows not
    tested).  A new version of the table; nothing is updated in place."""
    b = bonferroni(tests).select(*MART_KEY, "p_value", "is_significant")
    return mart.join(b, MART_KEY, "left").withColumn(
        "is_significant", F.coalesce(F.col("is_significant"), F.lit(False)))
