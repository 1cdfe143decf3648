import datetime as dt
import random

from pyspark.sql import functions as F

from clipmart.operators import perf, sketches

ROWS = ("platform_id string, metric_name string, feature_dim string, feature_value string, perf_date date, ad_id string, "
        "metric_value double")


def rows(spark, n=6000, days=10):
    rng = random.Random(3)
    return spark.createDataFrame(
        [("p", "m", "theme", rng.choice(["hot"] * 9 + ["rare", None]), dt.date(2024, 1, 1 + rng.randrange(days)),
          f"ad{rng.randrange(900)}", rng.choice([rng.random(), 0.25])) for _ in range(n)], ROWS)


def test_days_merge_into_any_period_within_the_stated_errors(spark):
    all_rows = rows(spark).cache()
    days = sketches.by_day(all_rows).cache()
    assert days.count() == 30  # three values, ten days
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-03", "2024-01-04"), ("2024-01-07", "2024-01-07")):
        inside = F.col("perf_date").between(first, last)
        part = all_rows.where(inside)
        checked = sketches.within_bounds(sketches.merged(days.where(inside)), part).collect()
        assert len(checked) == 3 and {r.feature_value for r in checked} == {"hot", "rare", None}
        assert all(r.median_within and r.n_ads_within for r in checked)
        want = {r.feature_value: (r.n, r.lo, r.hi) for r in part.groupBy("feature_value").agg(
            F.count("*").alias("n"), F.min("metric_value").alias("lo"), F.max("metric_value").alias("hi")).collect()}
        assert {r.feature_value: (r.n_rows, r.min_metric, r.max_metric) for r in checked} == want


def test_a_wrong_estimate_is_told(spark):
    all_rows = rows(spark, 500)
    wrong = sketches.merged(sketches.by_day(all_rows)).withColumn("median_metric", F.lit(0.99)).withColumn("n_ads", F.lit(1))
    assert not any(r.median_within or r.n_ads_within for r in sketches.within_bounds(wrong, all_rows).collect())


def test_empty(spark):
    none = spark.createDataFrame([], ROWS)
    assert sketches.merged(sketches.by_day(none)).collect() == []


def test_rank_by_prefix_sums_equals_the_window(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(g, rng.choice([None, *map(float, range(12))]), i) for i, g in enumerate("aab" * 60)] + [("c", None, 999)],
                               "g string, v double, id int")
    want = {(r.id, r.k) for r in df.selectExpr(
        "id", "rank() OVER (PARTITION BY g ORDER BY v DESC NULLS LAST) AS k").collect()}
    assert {(r.id, r.k) for r in perf.rank_descending(df, ["g"], "v", "k").collect()} == want
