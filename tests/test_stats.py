import itertools
import math

from clipmart.functions.pvalues import exact_sf, two_sided_p
from clipmart.operators import stats


def brute_sf(u, m, n):
    hit = tot = 0
    for top in itertools.combinations(range(m + n), m):
        s = set(top)
        U = sum(1 for a in top for b in range(m + n) if b not in s and b < a)
        tot += 1
        hit += U >= u
    return hit / tot


def test_exact_tail_matches_enumeration():
    for m, n in [(2, 3), (3, 5), (4, 4)]:
        for u in range(m * n + 1):
            assert abs(exact_sf(u, m, n) - brute_sf(u, m, n)) < 1e-12


def test_normal_tail_with_ties_hand_computed():
    # n1 = n2 = 10, U = 70, tie term 6 (three pairs of ties)
    n1 = n2 = 10
    n = 20
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - 6 / (n * (n - 1))))
    z = (70 - 50 - 0.5) / sigma
    assert abs(two_sided_p(10, 10, 70.0, 6.0, True) - math.erfc(z / math.sqrt(2))) < 1e-12


def base_rows(spark, top_vals, rest_vals):
    rows = [("meta", "hook_rate", "chunk_theme", "T", f"t{i}", v) for i, v in enumerate(top_vals)]
    rows += [("meta", "hook_rate", "chunk_theme", "R", f"r{i}", v) for i, v in enumerate(rest_vals)]
    return spark.createDataFrame(rows, "platform_id string, metric_name string, feature_dim string, "
                                       "feature_value string, ad_id string, metric_value double")


def mart_rows(spark):
    return spark.createDataFrame(
        [("meta", "hook_rate", "chunk_theme", "T", 12, 0.5, 1, "SUGGESTIVE"),
         ("meta", "hook_rate", "chunk_theme", "R", 12, 0.4, 2, "SUGGESTIVE")],
        "platform_id string, metric_name string, feature_dim string, feature_value string, n_ads int, "
        "median_metric double, rank_in_platform long, evidence_regime string")


def test_rank_sums_and_ties_in_spark(spark):
    top = [1.0, 2.0, 2.0, 5.0]
    rest = [2.0, 3.0, 4.0]
    t = stats.mann_whitney(base_rows(spark, top, rest), mart_rows(spark)).collect()[0]
    # pooled ranks: 1 ->1, 2 x3 -> 3, 3 -> 5, 4 -> 6, 5 -> 7 ; R1 = 1 + 3 + 3 + 7 = 14
    assert t.n1 == 4 and t.n2 == 3
    assert t.u1 == 14 - 10
    assert t.tie_term == 24.0


def test_all_equal_values_give_no_test(spark):
    t = stats.mann_whitney(base_rows(spark, [1.0] * 3, [1.0] * 3), mart_rows(spark)).collect()[0]
    assert t.p_raw is None
    assert stats.bonferroni(stats.mann_whitney(base_rows(spark, [1.0] * 3, [1.0] * 3),
                                               mart_rows(spark))).count() == 0


def test_average_ranks(spark):
    df = spark.createDataFrame([("f", 1.0), ("f", 2.0), ("f", 2.0), ("f", 3.0)], "fam string, v double")
    got = {r.v: r.avg_rank for r in stats.average_ranks(df, ["fam"], "v").collect()}
    assert got == {1.0: 1.0, 2.0: 2.5, 3.0: 4.0}


def test_rows_before_distributed_equals_plain(spark):
    import random
    rnd = random.Random(5)
    rows = [(f, float(rnd.randint(0, 30))) for f in ("a", "b") for _ in range(200)]
    df = spark.createDataFrame(rows, "fam string, v double")
    ties = df.groupBy("fam", "v").count().withColumnRenamed("count", "t")
    got = {(r.fam, r.v): r.before for r in stats.rows_before(ties, ["fam"], "v", partitions=5).collect()}
    want = {}
    for f in ("a", "b"):
        vals = sorted(v for g, v in rows if g == f)
        for v in set(vals):
            want[(f, v)] = sum(1 for x in vals if x < v)
    assert got == want
