from pyspark.sql import functions as F

from clipmart.operators import perf


def bridge(spark, rows):
    return spark.createDataFrame(rows, "ad_id string, chunk_id string, asset_id string, chunk_role string, "
                                       "position_in_ad int, start_sec double, end_sec double")


def anchors(spark, rows):
    return spark.createDataFrame(rows, "ad_id string, platform_id string, metric_name string, anchor_sec double")


BR = [("ad", "c1", "a", "hook", 1, 0.0, 3.0), ("ad", "c2", "a", "body", 2, 3.0, 6.0),
      ("ad", "c3", "a", "cta", 3, 6.0, 9.0)]


def pick(spark, a, b=BR):
    r = perf.align(anchors(spark, [("ad", "meta", "m", a)]), bridge(spark, b)).collect()
    assert len(r) == 1
    return r[0].chunk_id, r[0].coverage_confidence


def test_anchor_on_start_and_end_edges(spark):
    assert pick(spark, 3.0) == ("c2", "HIGH")   # start is inside, end is not
    assert pick(spark, 0.0) == ("c1", "HIGH")
    assert pick(spark, 9.0) == ("c3", "MEDIUM")  # after the last: nearest


def test_anchor_before_first_and_gap(spark):
    assert pick(spark, -2.0) == ("c1", "MEDIUM")
    gap = [("ad", "c1", "a", "hook", 1, 0.0, 2.0), ("ad", "c2", "a", "body", 2, 5.0, 6.0)]
    assert pick(spark, 4.0, gap) == ("c2", "MEDIUM")  # 1s to c2 beats 2s to c1


def test_two_chunks_one_position_and_null_times(spark):
    same = [("ad", "cb", "a", "hook", 1, 0.0, 3.0), ("ad", "ca", "a", "hook", 1, 0.0, 3.0)]
    assert pick(spark, 1.0, same) == ("ca", "HIGH")  # chunk_id breaks the tie
    nulls = [("ad", "cn", "a", "hook", 1, None, None), ("ad", "c2", "a", "body", 2, 3.0, 6.0)]
    assert pick(spark, 4.0, nulls) == ("c2", "HIGH")


def test_role_alignment_without_cta_gives_no_row(spark):
    ap = spark.createDataFrame([("ad", "meta"), ("ad2", "meta")], "ad_id string, platform_id string")
    b = bridge(spark, BR + [("ad2", "x1", "a", "hook", 1, 0.0, 1.0)])
    r = perf.align_role(ap, b).collect()
    assert [(x.ad_id, x.chunk_id) for x in r] == [("ad", "c3")]


def test_kpi_zero_denominators_are_null(spark):
    rows = [("ad", "meta", 0, 0, 0, 0, 0, 0, 0, 0, 0)]
    f = spark.createDataFrame(rows, "ad_id string, platform_id string, impressions long, plays_3s long, "
                                    "plays_25 long, plays_50 long, sum_watch_time_sec long, play_count long, "
                                    "link_clicks long, results long, spend long")
    k = perf.kpi(f).collect()[0]
    assert all(k[c] is None for c in ["hook_rate", "hold_rate_25", "avg_play_time_sec", "ctr_link", "cpa", "cvr"])


def test_duplicate_map_row_multiplies_and_unmapped_vanishes(spark):
    u = spark.createDataFrame([("meta", "ad1"), ("meta", "ad2")], "platform_name string, ad_id string")
    for c in perf.CANONICAL[1:]:
        u = u.withColumn(c, F.lit(1))
    plat = spark.createDataFrame([("meta", "meta", 3, "")], "platform_id string, platform_name string, "
                                                             "hook_window_sec int, hold_milestones string")
    m = spark.createDataFrame([("ad1", "a"), ("ad1", "a")], "ad_id string, asset_id string")
    assert perf.fact(u, plat, m).count() == 2


def test_regime_thresholds(spark):
    df = spark.createDataFrame([(4,), (5,), (11,), (12,)], "n int")
    got = [r.r for r in df.select(perf.regime(F.col("n")).alias("r")).collect()]
    assert got == ["BLOCK", "DIRECTIONAL", "DIRECTIONAL", "SUGGESTIVE"]


def test_exact_median_matches_pandas(spark):
    import random
    import statistics
    rnd = random.Random(3)
    rows = [(g, float(rnd.randint(0, 9)) if rnd.random() > 0.1 else None)
            for g, n in (("a", 7), ("b", 8), ("c", 1), ("d", 40)) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median_metric for r in perf.exact_median(df, ["g"], "v").collect()}
    for g in "abcd":
        vals = [v for k, v in rows if k == g and v is not None]
        if vals:
            assert abs(got[g] - statistics.median(vals)) < 1e-12


def test_latest_pull_keeps_the_restated_day(spark):
    import datetime as dt
    rows = [("ad", "meta", dt.date(2024, 1, 1), 10, dt.datetime(2024, 1, 2), "h1"),
            ("ad", "meta", dt.date(2024, 1, 1), 12, dt.datetime(2024, 1, 5), "h2"),
            ("ad", "meta", dt.date(2024, 1, 2), 7, dt.datetime(2024, 1, 3), "h3")]
    df = spark.createDataFrame(rows, "ad_id string, platform_native string, perf_date date, impressions long, "
                                     "load_ts timestamp, content_hash string")
    got = {str(r.perf_date): r.impressions for r in perf.latest_pull(df).collect()}
    assert got == {"2024-01-01": 12, "2024-01-02": 7}


def test_conform_rebuilds_sum_from_average(spark):
    native = spark.createDataFrame(
        [("a1", "2024-01-01", "100", "40", "2.5", "4", "9.99")],
        "ad_id string, date string, impressions string, video_3_sec_watched_actions string, "
        "video_avg_time_watched_actions string, video_play_actions string, spend string")
    r = perf.conform(native, "meta").collect()[0]
    assert (r.impressions, r.plays_3s, r.play_count) == (100, 40, 4)
    assert float(r.sum_watch_time_sec) == 10.0 and float(r.spend) == 9.99
    assert r.plays_25 is None  # absent in the export: NULL, not zero
