"""Cases that once gave wrong answers, lost rows or killed a batch."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipmart.operators import dq, incremental, lineage, perf, silver, stats
from clipmart.sources import io

KEYS = {"spark.sql.adaptive.coalescePartitions.enabled": ("true", "false"), "spark.sql.exchange.reuse": ("true", "false")}


@pytest.mark.parametrize("partitions,coalesce,reuse", [(8, "true", "true"), (32, "false", "false"), (200, "true", "false")])
def test_ranks_and_median_of_one_large_family(spark, partitions, coalesce, reuse):
    n = 500_000
    rng = np.random.default_rng(partitions)
    pdf = pd.DataFrame({"v": np.round(rng.normal(size=n), 5), "top": rng.random(n) < 0.3})
    old = {k: spark.conf.get(k) for k in [*KEYS, "spark.sql.shuffle.partitions"]}
    try:
        for k, v in zip([*KEYS, "spark.sql.shuffle.partitions"], (coalesce, reuse, str(partitions))):
            spark.conf.set(k, v)
        base = spark.createDataFrame(pdf).select(
            F.lit("p").alias("platform_id"), F.lit("m").alias("metric_name"), F.lit("d").alias("feature_dim"),
            F.when(F.col("top"), "x").otherwise("y").alias("feature_value"), F.lit("ad").alias("ad_id"),
            F.col("v").alias("metric_value"))
        mart = spark.createDataFrame([("p", "m", "d", "x", 1, "SUGGESTIVE"), ("p", "m", "d", "y", 2, "SUGGESTIVE")],
                                     "platform_id string, metric_name string, feature_dim string, feature_value string, "
                                     "rank_in_platform long, evidence_regime string")
        ranks = pdf["v"].rank()
        n1 = int(pdf["top"].sum())
        want = ranks[pdf["top"]].sum() - n1 * (n1 + 1) / 2
        for _ in range(2):
            r = stats.mann_whitney(base, mart).collect()
            assert [(x.n1, x.n2, x.u1) for x in r] == [(n1, n - n1, want)]
        m = perf.exact_median(base, ["platform_id"], "metric_value").head()["median_metric"]
        assert m == pytest.approx(pdf["v"].median(), abs=1e-12)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_scores_that_do_not_fit(spark):
    given = ["99999999999", "NaN", "-99999999999", "Infinity", "4.5", "x", None, "3"]
    df = spark.createDataFrame([(t,) for t in given], "t string")
    assert [r.n for r in df.select(silver.to_int(F.col("t")).alias("n")).collect()] == [None, None, None, None, 5, None, None, 3]


def test_envelopes(spark):
    rows = [("a", '{"chunks": []}'), ("b", "{bad"), ("c", '{"other": 1}'), ("d", None), ("e", '{"chunks": [{"keywords": 3}]}')]
    ok, bad = dq.json_gate(spark.createDataFrame(rows, "asset_id string, raw_response string"))
    assert sorted(r.asset_id for r in ok.collect()) == ["a", "e"]
    assert {r.asset_id: r.reason for r in bad.collect()} == {
        "b": "unparsable_envelope", "c": "missing_chunks", "d": "null_envelope"}


def test_optional_lists_may_be_absent(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 1.0, "t", "Hook", "calm", 4, None, None)],
        "chunk_id string, start_sec double, end_sec double, transcript_segment string, chunk_theme string, sentiment string, "
        "standalone_score int, next_compatible_themes array<string>, keywords array<string>")
    ok, bad = dq.quarantine(df)
    assert (ok.count(), bad.count()) == (1, 0)


def test_empty_overwrite_replaces_the_client(spark, tmp_path):
    root = str(tmp_path)
    schema = "asset_id string, client_id string"
    df = spark.createDataFrame([("x", "c1"), ("y", "c/2")], schema)
    io.write_table(df, root, "t")
    io.write_table(spark.createDataFrame([], schema), root, "t", "c1")
    read = lambda: sorted((r.asset_id, r.client_id) for r in spark.read.schema(schema).parquet(f"{root}/t").collect())
    assert read() == [("y", "c/2")]
    io.write_table(spark.createDataFrame([("z", "c/2")], schema), root, "t", "c/2")
    assert read() == [("z", "c/2")]


def test_storage_errors_are_raised(spark, tmp_path):
    path = tmp_path / "bronze"
    path.mkdir()
    (path / "part-0.parquet").write_bytes(b"no parquet")
    df = spark.createDataFrame([("a", 1)], "asset_id string, n int")
    with pytest.raises(Exception):
        incremental.append_bronze(df, str(path))
    with pytest.raises(Exception):
        io.append_manifest(df, str(path))


def test_serving_view_keeps_other_caches(spark, tmp_path):
    kept = spark.range(5).cache()
    kept.count()
    cols = "chunk_id string, asset_id string, transcript_segment string, chunk_theme string, sentiment string, " \
           "standalone_score int, embedding array<float>"
    spark.createDataFrame([("a", "b", "t", "Hook", "calm", 3, [1.0])], cols).write.parquet(str(tmp_path / "f"))
    assert io.serving_view(spark, str(tmp_path / "f")).count() == 1
    assert kept.storageLevel.useMemory


def test_repeated_bronze_ids_do_not_repeat_objects(spark):
    landing = spark.createDataFrame([("c", "landing/c/video/x.mp4")], "client_id string, key string") \
        .withColumn("last_modified", F.to_timestamp(F.lit("2026-01-01 00:00:00")))
    clients = spark.createDataFrame([("c", 1)], "client_id string, landing_ttl_days int")
    bronze = spark.createDataFrame([("x",), ("x",)], "asset_id string")
    assert incremental.ttl_plan(landing, clients, bronze, "2026-03-01 00:00:00").count() == 1


def test_long_chains_and_cycles_are_walked_to_the_end(spark):
    chain = [(str(i), str(i + 1)) for i in range(20)] + [("a", "b"), ("b", "c"), ("c", "a"), (None, "x"), ("a", "b")]
    got = {(r.ancestor, r.descendant): r.depth for r in lineage.closure(
        spark.createDataFrame(chain, "parent_asset_id string, child_asset_id string")).collect()}
    assert got[("0", "20")] == 20 and got[("a", "a")] == 3
    assert len(got) == 20 * 21 // 2 + 9
    assert max(r.depth for r in lineage.closure(spark.createDataFrame(
        chain, "parent_asset_id string, child_asset_id string"), max_depth=2).collect()) == 2


def test_theme_with_a_quote(spark):
    fact = spark.createDataFrame([("1", "Founder's Story", 5), ("2", "CTA", 5)], "chunk_id string, chunk_theme string, standalone_score int")
    compat = spark.createDataFrame([("1", "CTA")], "chunk_id string, compatible_theme string")
    assert [(r.path, r.depth) for r in lineage.theme_walk(fact, compat, "Founder's Story").collect()] == [("Founder's Story > CTA", 1)]


def test_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from clipmart import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(Session())


def test_embeddings_are_guarded(spark, tmp_path):
    from clipmart import schemas

    schema = schemas.CHUNK_EMBEDDING
    empty = {f.name: None for f in schema.fields}
    for name, ids, ok in (("good", ["a", "b"], True), ("twice", ["a", "a"], False), ("null", ["a", None], False)):
        path = str(tmp_path / name)
        spark.createDataFrame([tuple((empty | {"chunk_id": i}).values()) for i in ids], schema).write.parquet(path)
        if ok:
            assert io.read_embeddings(spark, path).count() == 2
        else:
            with pytest.raises(ValueError):
                io.read_embeddings(spark, path)


def test_exact_tail_by_counting_and_for_a_huge_side():
    from itertools import combinations
    from math import comb

    from clipmart.functions.pvalues import asymptotic_sf, exact_sf

    for m, n in ((1, 1), (1, 7), (2, 3), (3, 5), (4, 4), (5, 6), (3, 40)):
        us = [sum(c) - m * (m - 1) // 2 for c in combinations(range(m + n), m)]
        for u in range(-1, m * n + 2):
            assert exact_sf(u, m, n) == pytest.approx(sum(x >= u for x in us) / comb(m + n, m), abs=1e-15)
    assert exact_sf(0, 8, 10**9) == 1.0
    assert exact_sf(4 * 10**9 + 10**9, 8, 10**9) == pytest.approx(asymptotic_sf(5 * 10**9, 8, 10**9, 0), rel=0.05)
