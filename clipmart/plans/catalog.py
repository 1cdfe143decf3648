"""Query catalog: one callable per inventory key, ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through ``plans.fixtures`` and runs the
library operators over the whole tables.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipmart.operators import gold, search, silver, textindex, vectorindex
from clipmart.plans import fixtures as fx
from clipmart.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


# --- shared building blocks ---------------------------------------------------------

def silver_chunks(spark, sf):
    return silver.clean(silver.explode_chunks(fx.bronze_asset_raw(spark, sf), fx.ID_WIDTH))


def fact_chunk(spark, sf):
    return gold.fact_chunk(silver_chunks(spark, sf), fx.chunk_embedding(spark, sf))


def dim_asset(spark, sf):
    return gold.dim_asset(fx.asset_manifest(spark, sf))


# --- 2.2 projections / search ---------------------------------------------------

@query("search")
def q_search(spark, sf):
    return search.clips(fact_chunk(spark, sf), dim_asset(spark, sf), theme="Problem",
                        sentiment="frustrated", min_score=4, contains="an", order=False)


@query("search_ordered")
def q_search_ordered(spark, sf):
    """The first 50 hits in reading order, with their position."""
    hits = search.clips(fact_chunk(spark, sf), dim_asset(spark, sf), theme="Problem", min_score=4).limit(50)
    w = Window.orderBy(F.col("standalone_score").desc_nulls_last(), F.col("start_sec").asc_nulls_last(), "chunk_id")
    return hits.select(F.row_number().over(w).cast("long").alias("position"), *search.CLIP_COLUMNS)


def silver_raw(spark, sf):
    return silver.explode_chunks(fx.bronze_asset_raw(spark, sf), fx.ID_WIDTH)


@query("explode_chunks")
def q_explode_chunks(spark, sf):
    return silver_raw(spark, sf)


@query("chunk_fields")
def q_chunk_fields(spark, sf):
    return silver_raw(spark, sf).select(
        "chunk_id", "start_sec", "end_sec", "standalone_score",
        F.size("next_compatible_themes").alias("n_next_themes"),
        F.size("keywords").alias("n_keywords"))


@query("chunk_id")
def q_chunk_id(spark, sf):
    return silver_raw(spark, sf).select("asset_id", "chunk_sequence", "chunk_id")


@query("chunk_cleaned")
def q_chunk_cleaned(spark, sf):
    return silver_chunks(spark, sf)


@query("dim_asset")
def q_dim_asset(spark, sf):
    return dim_asset(spark, sf).drop("load_ts")


@query("chunk_compatibility")
def q_compat(spark, sf):
    return gold.compatibility(silver_chunks(spark, sf))


@query("keyword_bridge")
def q_keywords(spark, sf):
    return gold.keywords(silver_chunks(spark, sf))


@query("theme_bridge")
def q_themes(spark, sf):
    return gold.themes(silver_chunks(spark, sf))


@query("fact_chunk")
def q_fact_chunk(spark, sf):
    return fact_chunk(spark, sf)


@query("asset_lineage")
def q_lineage(spark, sf):
    return gold.lineage(dim_asset(spark, sf))


@query("theme_vocabulary")
def q_theme_vocabulary(spark, sf):
    return silver.theme_vocabulary(silver_chunks(spark, sf))


# --- performance chain ---------------------------------------------------------------

from clipmart.operators import perf, sketches  # noqa: E402


def perf_chain(spark, sf):
    """The performance marts read chunk features only (no vectors); the
    chunk table and the asset dimension are materialised once for the
    several models that read them, if any of those is asked for."""
    from clipmart.session import materialize

    own = {"fact_chunk": lambda m: materialize(gold.fact_chunk(silver_chunks(spark, sf), None).drop("embedding")),
           "dim_asset": lambda m: materialize(dim_asset(spark, sf).drop("load_ts"))}
    return perf.Models(perf.CHAIN | own, bronze_perf=fx.bronze_ad_performance(spark, sf), platform=fx.dim_platform(spark),
                       ad_map=fx.map_ad_asset(spark, sf), edl=fx.edit_decision_list(spark, sf))


@query("platform_staging")
def q_platform_staging(spark, sf):
    return perf.stage(fx.bronze_ad_performance(spark, sf), "tiktok")


@query("perf_union")
def q_perf_union(spark, sf):
    return perf_chain(spark, sf)["int_ad_perf_unioned"]


@query("fact_ad_performance")
def q_fact_perf(spark, sf):
    return perf_chain(spark, sf)["fact_ad_performance"].drop("load_ts")


@query("kpi_sums")
def q_kpi_sums(spark, sf):
    return perf.kpi_sums(perf_chain(spark, sf)["fact_ad_performance"])


@query("ad_kpi")
def q_ad_kpi(spark, sf):
    k = perf_chain(spark, sf)["fct_ad_kpi"]
    return k.select("ad_id", "platform_id", *[F.round(c, 9).alias(c) for c in k.columns[2:]])


@query("bridge_ad_chunk")
def q_bridge(spark, sf):
    return perf_chain(spark, sf)["bridge_ad_chunk"]


def _anchors(spark, sf, c=None):
    c = c or perf_chain(spark, sf)
    return perf.anchors(c["fact_ad_performance"], fx.dim_platform(spark), fx.map_ad_asset(spark, sf),
                        c["dim_asset"])


@query("hook_anchor")
def q_hook_anchor(spark, sf):
    return _anchors(spark, sf).where(F.col("metric_name") == "hook_rate")


@query("hold_anchor")
def q_hold_anchor(spark, sf):
    return _anchors(spark, sf).where(F.col("metric_name") != "hook_rate")


@query("anchor_alignment")
def q_anchor_alignment(spark, sf):
    c = perf_chain(spark, sf)
    return perf.align(_anchors(spark, sf, c), c["bridge_ad_chunk"])


@query("role_alignment")
def q_role_alignment(spark, sf):
    c = perf_chain(spark, sf)
    return perf.align_role(perf.ad_platforms(c["fact_ad_performance"]), c["bridge_ad_chunk"])


@query("ad_metric_chunk")
def q_ad_metric_chunk(spark, sf):
    mc = perf_chain(spark, sf)["fct_ad_metric_chunk"]
    return mc.withColumn("metric_value", F.round("metric_value", 9))


def _mart_out(m):
    return m.withColumn("median_metric", F.round("median_metric", 9))


@query("chunk_correlation")
def q_chunk_correlation(spark, sf):
    return _mart_out(perf_chain(spark, sf)["mart_chunk_perf_correlation"])


@query("perf_marts")
def q_perf_marts(spark, sf):
    return _mart_out(perf_chain(spark, sf)["mart_chunk_perf_correlation"]).drop("honesty_note")


@query("rank_in_platform")
def q_rank_in_platform(spark, sf):
    return perf_chain(spark, sf)["mart_chunk_perf_correlation"].select(
        "platform_id", "metric_name", "feature_dim", "feature_value", "rank_in_platform")


@query("evidence_regime")
def q_evidence_regime(spark, sf):
    return perf_chain(spark, sf)["mart_chunk_perf_correlation"].select(
        "platform_id", "metric_name", "feature_dim", "feature_value", "n_ads", "evidence_regime")


EXT_DIMS = ("chunk_theme", "sentiment", "chunk_role")


@query("chunk_correlation_ext")
def q_chunk_correlation_ext(spark, sf):
    m = perf.correlation(perf_chain(spark, sf)["fct_ad_metric_chunk"], EXT_DIMS, extended=True)
    return m.select(*[F.round(c, 9).alias(c) if c.endswith("_metric") else F.col(c) for c in m.columns])


def _sketch_rows(spark, sf):
    c = perf_chain(spark, sf)
    return sketches.daily_rows(c["fct_ad_metric_chunk"], c["fact_ad_performance"], EXT_DIMS) \
        .withColumn("perf_month", F.trunc("perf_date", "month"))


def _sketch_days(rows):
    from clipmart.session import materialize
    return materialize(sketches.by_day(rows)).withColumn("perf_month", F.trunc("perf_date", "month"))


@query("perf_sketches")
def q_perf_sketches(spark, sf):
    """A3 by sketches: stored days, merged into months and held against all rows."""
    from clipmart.session import materialize
    rows = materialize(_sketch_rows(spark, sf))
    e = sketches.within_bounds(sketches.merged(_sketch_days(rows), "perf_month"), rows, "perf_month")
    return e.select(*[F.round(c, 9).alias(c) if c in ("min_metric", "max_metric") else F.col(c) for c in e.columns])


@query("surfaced_insights")
def q_surfaced(spark, sf):
    return perf.surfaced(perf_chain(spark, sf)["mart_chunk_perf_correlation"], "hook_rate", "chunk_theme")


@query("mine_unused_chunks")
def q_mine_unused(spark, sf):
    c = perf_chain(spark, sf)
    return perf.mine_unused(c["fact_chunk"], c["dim_asset"], c["mart_chunk_perf_correlation"],
                            c["bridge_ad_chunk"])


@query("rank_agreement")
def q_rank_agreement(spark, sf):
    m = perf.correlation(perf_chain(spark, sf)["fct_ad_metric_chunk"], EXT_DIMS)
    return perf.rank_agreement(m, top=3)


def restated_pulls(spark, sf):
    """Bronze perf plus a later restatement of every day whose day-of-month
    is a multiple of 7 (impressions doubled)."""
    b = fx.bronze_ad_performance(spark, sf)
    later = b.where(F.dayofmonth("perf_date") % 7 == 0).select(
        *[(F.col(c) * 2).alias(c) if c == "impressions" else
          (F.col(c) + F.expr("INTERVAL 1 DAY")).alias(c) if c == "load_ts" else F.col(c)
          for c in b.columns])
    return b.unionByName(later)


@query("restatement_dedup")
def q_restatement(spark, sf):
    return perf.latest_pull(restated_pulls(spark, sf))


def native_export(spark, sf, platform):
    """Platform export under native column names; Meta carries the average
    watch time only."""
    b = perf.stage(fx.bronze_ad_performance(spark, sf), platform)
    inv = {v: k for k, v in perf.EXPORT_COLUMNS[platform].items()}
    cols = []
    for c in b.columns:
        if c == "sum_watch_time_sec":
            if "avg_watch_time_sec" in inv:
                cols.append((F.col(c).cast("double") / F.nullif(F.col("play_count"), F.lit(0)))
                            .alias(inv["avg_watch_time_sec"]))
            else:
                cols.append(F.col(c).alias(inv[c]))
        else:
            cols.append(F.col(c).alias(inv[c]))
    return b.select(*cols)


@query("conform_export")
def q_conform(spark, sf):
    """Native exports are written as CSV files and read back through the
    export reader (S7), then conformed (F6)."""
    import uuid

    from clipmart.sources import io as cio
    from clipmart.session import scratch_path
    parts = []
    for plat in ("meta", "tiktok"):
        path = scratch_path(spark, "exports", uuid.uuid4().hex, plat)
        _write_exports(native_export(spark, sf, plat), path)
        parts.append(cio.read_export(spark, path, plat).withColumn("platform", F.lit(plat)))
    m, t = parts
    u = m.unionByName(t)
    return u.withColumn("sum_watch_time_sec", F.round(F.col("sum_watch_time_sec").cast("double"), 3))


def _write_exports(rows, path):
    """Half of the rows in the platform's order of columns, half reversed with a column of its own between."""
    half = F.pmod(F.xxhash64("ad_id"), F.lit(2)) == 0
    rows.where(half).write.option("header", True).csv(os.path.join(path, "a"))
    names = rows.columns[::-1]
    rows.where(~half).withColumn("account, name", F.lit('say "hi", twice')).select(names[0], "account, name", *names[1:]) \
        .write.option("header", True).csv(os.path.join(path, "b"))


@query("export_quarantine")
def q_export_quarantine(spark, sf):
    """Exports with planted damage: spend in words for every 7th ad, a day
    that is none for every 11th.  These rows, and what is wrong with them."""
    import uuid

    from clipmart.sources import io as cio
    from clipmart.session import scratch_path
    path = scratch_path(spark, "exports", uuid.uuid4().hex, "meta")
    user = F.expr("cast(substr(ad_id, 3) as bigint)")
    rows = native_export(spark, sf, "meta").withColumn("spend", F.when(user % 7 == 0, F.lit("n/a")).otherwise(F.col("spend").cast("string"))) \
        .withColumn("date", F.when(user % 11 == 0, F.lit("31.02.")).otherwise(F.col("date").cast("string")))
    _write_exports(rows, path)
    bad = cio.quarantined_export(spark, path, "meta").select("ad_id", "impressions", F.concat_ws(",", F.sort_array("bad_fields")).alias("bad_fields"))
    good = cio.read_export(spark, path, "meta").select("ad_id", F.col("impressions").cast("string").alias("impressions"), F.lit("").alias("bad_fields"))
    return bad.unionByName(good)


# --- significance ------------------------------------------------------------------

from clipmart.operators import stats  # noqa: E402


def _mart_and_tests(spark, sf):
    c = perf_chain(spark, sf)
    mart = c["mart_chunk_perf_correlation"]
    base = perf.feature_rows(c["fct_ad_metric_chunk"], ("chunk_theme",))
    return mart, stats.mann_whitney(base, mart)


@query("top_suggestive")
def q_top_suggestive(spark, sf):
    return stats.top_suggestive(perf_chain(spark, sf)["mart_chunk_perf_correlation"])


@query("mann_whitney")
def q_mann_whitney(spark, sf):
    _, t = _mart_and_tests(spark, sf)
    return t.select(*stats.MART_KEY, "n1", "n2", *[F.round(c, 6).alias(c) for c in
                                                    ("u1", "u", "tie_term", "p_raw")])


@query("bonferroni")
def q_bonferroni(spark, sf):
    _, t = _mart_and_tests(spark, sf)
    b = stats.bonferroni(t)
    return b.select(*stats.MART_KEY, F.round("p_raw", 6).alias("p_raw"),
                    F.round("p_value", 6).alias("p_value"), "is_significant")


@query("scored_mart")
def q_scored_mart(spark, sf):
    mart, t = _mart_and_tests(spark, sf)
    s = stats.scored_mart(mart, t)
    return s.select(*stats.MART_KEY, "n_ads", F.round("median_metric", 9).alias("median_metric"),
                    "rank_in_platform", "evidence_regime", F.round("p_value", 6).alias("p_value"),
                    "is_significant")


# --- assembly ----------------------------------------------------------------------

from clipmart.operators import assemble  # noqa: E402


def _graph(spark, sf):
    """Chunk features and compatibility edges from one materialised Silver
    table (as stored Gold tables would be read), not two envelope parses."""
    from clipmart.session import materialize

    s = materialize(silver_chunks(spark, sf))
    return gold.fact_chunk(s, None), gold.compatibility(s)


@query("assemble_pairs")
def q_assemble_pairs(spark, sf):
    f, c = _graph(spark, sf)
    return assemble.pair_counts(f, c, "Hook")


@query("assemble_first_pairs")
def q_assemble_first_pairs(spark, sf):
    f, c = _graph(spark, sf)
    return assemble.first_pairs(f, c, "Hook", n=50)


@query("assemble_sequences")
def q_assemble_sequences(spark, sf):
    f, c = _graph(spark, sf)
    return assemble.sequences(f, c, "Hook", n=20)


# --- data quality ------------------------------------------------------------------

from clipmart.operators import dq, lineage, reconcile  # noqa: E402


@query("dq_not_null")
def q_dq_not_null(spark, sf):
    return dq.not_null(fact_chunk(spark, sf), "embedding").select("chunk_id")


def _id_manifest(spark, sf):
    return fx.identity_manifest(spark, sf).withColumnRenamed("doc_id", "row_pos")


@query("dq_unique")
def q_dq_unique(spark, sf):
    return dq.unique(_id_manifest(spark, sf), "asset_id")


@query("dq_accepted_values")
def q_dq_accepted(spark, sf):
    s = silver_chunks(spark, sf)
    a = dq.accepted_values(s, "sentiment", dq.SENTIMENTS).select("chunk_id", F.lit("sentiment").alias("col"))
    b = dq.accepted_values(s, "chunk_theme", ["Hook", "Problem", "Solution", "CTA"]) \
        .select("chunk_id", F.lit("chunk_theme").alias("col"))
    return a.unionByName(b)


@query("dq_between")
def q_dq_between(spark, sf):
    s = silver_chunks(spark, sf)
    a = dq.between(s, "standalone_score", 1, 5).select("chunk_id", F.lit("standalone_score").alias("col"))
    b = dq.between(s, "standalone_score", 2, None).select("chunk_id", F.lit("score_min_2").alias("col"))
    return a.unionByName(b)


@query("dq_relationships")
def q_dq_relationships(spark, sf):
    return dq.relationships(dim_asset(spark, sf).drop("load_ts"), "client_id",
                            fx.dim_client(spark, sf), "client_id").select("asset_id", "client_id")


@query("fk_violations")
def q_fk_violations(spark, sf):
    c = perf_chain(spark, sf)
    return dq.relationships(fx.edit_decision_list(spark, sf), "chunk_id", c["fact_chunk"], "chunk_id")


@query("dq_unique_combination")
def q_dq_unique_combination(spark, sf):
    """The grain of the ad-chunk bridge, with planted repetitions."""
    edl = fx.edit_decision_list(spark, sf)
    again = edl.where((F.col("position_in_ad") == 1) & (F.expr("cast(substr(ad_id, 3) as bigint)") % 13 == 0))
    return dq.unique_combination(edl.unionByName(again), ["ad_id", "chunk_id", "position_in_ad"])


@query("dq_row_count_floor")
def q_dq_row_count_floor(spark, sf):
    s = silver_chunks(spark, sf)
    return dq.row_count_floor(s, 1).unionByName(
        dq.row_count_floor(s.where(F.col("standalone_score") > 5), 1))


@query("dq_assembly_safe")
def q_dq_assembly_safe(spark, sf):
    f, c = _graph(spark, sf)
    return dq.assembly_safe(assemble.endpoints(f, c, "Hook"), f)


@query("assembly_endpoints")
def q_assembly_endpoints(spark, sf):
    f, c = _graph(spark, sf)
    return assemble.endpoints(f, c, "Hook")


@query("dq_edl_orphans")
def q_dq_edl_orphans(spark, sf):
    return dq.orphans(fx.edit_decision_list(spark, sf), fact_chunk(spark, sf), "chunk_id") \
        .select("ad_id", "chunk_id", "position_in_ad")


@query("edl_orphans")
def q_edl_orphans(spark, sf):
    return dq.orphans(fx.edit_decision_list(spark, sf), fact_chunk(spark, sf), "chunk_id")


@query("dq_json_gate")
def q_dq_json_gate(spark, sf):
    """Both sides of the gate over envelopes with planted damage: cut off,
    without chunks, null, and with an empty (legal) array."""
    doc, raw = F.expr("cast(substr(asset_id, 4) as bigint)"), F.col("raw_response")
    damaged = fx.bronze_asset_raw(spark, sf).withColumn(
        "raw_response", F.when(doc % 9 == 0, F.substring(raw, 1, 12)).when(doc % 9 == 1, F.lit('{"other": 1}'))
        .when(doc % 9 == 2, F.lit(None)).when(doc % 9 == 3, F.lit('{"chunks": []}')).otherwise(raw))
    ok, bad = dq.json_gate(damaged)
    return ok.select("asset_id", F.lit("ok").alias("reason")).unionByName(bad.select("asset_id", "reason"))


@query("dq_quarantine")
def q_dq_quarantine(spark, sf):
    ok, bad = dq.quarantine(silver_chunks(spark, sf))
    drift = fx.drifted_run(silver_chunks(spark, sf))
    ok2, bad2 = dq.quarantine(drift.withColumn(
        "standalone_score", F.when(F.col("standalone_score") == 1, F.lit(0)).otherwise(F.col("standalone_score"))))
    return bad.select("chunk_id", "reasons").unionByName(bad2.select("chunk_id", "reasons"))


@query("constraint_pass_rate")
def q_pass_rate(spark, sf):
    s = silver_chunks(spark, sf).withColumn(
        "standalone_score", F.when(F.col("standalone_score") == 1, F.lit(0)).otherwise(F.col("standalone_score")))
    return dq.pass_rate(s).withColumn("pass_rate", F.round("pass_rate", 9))


@query("dq_perf_release")
def q_dq_perf_release(spark, sf):
    c = perf_chain(spark, sf)
    return dq.perf_release(c["fct_ad_kpi"], c["fact_ad_performance"], c["fct_ad_metric_chunk"],
                           c["mart_chunk_perf_correlation"], c["dim_asset"], fx.map_ad_asset(spark, sf),
                           c["bridge_ad_chunk"], c["int_ad_perf_unioned"], c["int_metric_chunk_alignment"])


@query("lineage_contract")
def q_lineage_contract(spark, sf):
    return lineage.violations(_id_manifest(spark, sf), fx.dim_client(spark, sf))


@query("golden_diff")
def q_golden_diff(spark, sf):
    """A second, drifted run against the answer key made without the envelopes."""
    golden = fx.direct_chunks(spark, sf)
    return dq.row_diff(fx.drifted_run(silver_chunks(spark, sf)).select(*golden.columns), golden)


@query("idempotency_drift")
def q_drift(spark, sf):
    s = silver_chunks(spark, sf)
    return dq.drift(s, fx.drifted_run(s)).select("chunk_id", "in_a", "in_b", "n_changed",
                                                 F.array_join("changed", ",").alias("changed"))


@query("golden_agreement")
def q_golden_agreement(spark, sf):
    s = silver_chunks(spark, sf)
    return dq_golden(fx.direct_chunks(spark, sf), fx.drifted_run(s))


def dq_golden(expected, actual):
    from clipmart.operators.dq import golden_agreement
    return golden_agreement(expected, actual).withColumn("agreement", F.round("agreement", 9))


@query("store_failures")
def q_store_failures(spark, sf):
    """The failing rows, appended to the audit table and read back (K7)."""
    import uuid
    metrics, fails = dq_suite(spark, sf)
    path = scratch_path(spark, "audit", uuid.uuid4().hex)
    cio.write_failures(fails, path)
    return spark.read.schema(fails.schema).parquet(path).drop("run_ts").select(*fails.drop("run_ts").columns)


@query("dq_run_metrics")
def q_dq_run_metrics(spark, sf):
    metrics, _ = dq_suite(spark, sf)
    return metrics


def dq_suite(spark, sf):
    # read by eight checks: the envelopes are parsed once
    s = materialize(silver_chunks(spark, sf).select(*gold.FACT_COLUMNS))
    fc = materialize(gold.fact_chunk(s, fx.chunk_embedding(spark, sf)).select("chunk_id", "embedding"))
    edl = fx.edit_decision_list(spark, sf)
    checks = [
        dq.Check("chunk_id_not_null", "warn", dq.not_null(s, "chunk_id").select("chunk_id")),
        dq.Check("chunk_id_unique", "warn", dq.unique(s, "chunk_id")),
        dq.Check("score_between_1_5", "warn", dq.between(s, "standalone_score", 1, 5).select("chunk_id")),
        dq.Check("theme_not_null", "warn", dq.not_null(s, "chunk_theme").select("chunk_id")),
        dq.Check("sentiment_accepted", "warn",
                 dq.accepted_values(s, "sentiment", dq.SENTIMENTS).select("chunk_id", "sentiment")),
        dq.Check("silver_row_count", "error", dq.row_count_floor(s, 1)),
        dq.Check("embedding_present", "warn", dq.not_null(fc, "embedding").select("chunk_id")),
        dq.Check("edl_orphans", "warn", dq.orphans(edl, fc, "chunk_id").select("ad_id", "chunk_id")),
        dq.Check("asset_client_fk", "error", dq.relationships(
            dim_asset(spark, sf).drop("load_ts"), "client_id", fx.dim_client(spark, sf), "client_id")
            .select("asset_id", "client_id")),
    ]
    return dq.run(checks, run_ts="2026-01-01 00:00:00")


@query("multiset_diff")
def q_multiset_diff(spark, sf):
    c = perf_chain(spark, sf)
    return reconcile.multiset_diff(fx.edit_decision_list(spark, sf).select("ad_id", "chunk_id"),
                                   c["bridge_ad_chunk"].select("ad_id", "chunk_id"), ["ad_id", "chunk_id"])


@query("reconcile_tables")
def q_reconcile(spark, sf):
    """The eight served tables against a second copy with planted damage: lost
    rows, repeated rows and renamed keys; the other copies are whole."""
    # what several copies are taken from is derived once, with the columns that are compared
    s = materialize(silver_chunks(spark, sf).select("chunk_id", "chunk_theme", "next_compatible_themes", "keywords"))
    fc, run = s, gold.extraction_run(_run_log(spark, sf))
    asset, compat = materialize(dim_asset(spark, sf).select("asset_id", "parent_asset_id")), gold.compatibility(s)
    emb = materialize(fx.chunk_embedding(spark, sf).select("chunk_id"))
    doc = F.regexp_extract("chunk_id", "^doc([0-9]+)_", 1).cast("long")
    run_doc = F.expr("cast(substr(asset_id, 4) as bigint)")
    return reconcile.tables({
        "dim_asset": (asset, fx.bronze_asset_raw(spark, sf), ["asset_id"]),
        "fact_chunk": (fc, fx.direct_chunks(spark, sf).where(doc % 13 != 5), ["chunk_id"]),
        "fact_extraction_run": (run, run.withColumn("asset_id", F.when(run_doc % 17 == 3, F.concat(F.lit("x"), "asset_id"))
                                                    .otherwise(F.col("asset_id"))), ["asset_id"]),
        "bridge_asset_lineage": (gold.lineage(asset), gold.lineage(asset), ["parent_asset_id", "child_asset_id"]),
        "bridge_chunk_compatibility": (compat, compat.unionByName(compat.where(doc % 19 == 1)),
                                       ["chunk_id", "compatible_theme"]),
        "dim_keyword_bridge": (gold.keywords(s), gold.keywords(s), ["chunk_id", "keyword"]),
        "dim_theme_bridge": (gold.themes(s), fx.direct_chunks(spark, sf).select("chunk_id", F.col("chunk_theme").alias("theme")),
                             ["chunk_id", "theme"]),
        "chunk_embedding": (emb, emb.where(doc % 11 != 2), ["chunk_id"]),
    })


@query("reconcile_rows")
def q_reconcile_rows(spark, sf):
    """Differing rows of the chunk table and a drifted copy, found through a hash tree."""
    columns = ["chunk_id", "standalone_score", "transcript_segment"]
    s = materialize(silver_chunks(spark, sf).select(*columns))
    doc = F.regexp_extract("chunk_id", "^doc([0-9]+)_", 1).cast("long")
    copy = s.withColumn("transcript_segment", F.when(doc % 101 == 7, F.concat("transcript_segment", F.lit(" (cut)"))).otherwise(F.col("transcript_segment")))
    copy = copy.where(doc % 97 != 5).unionByName(s.where(doc % 89 == 3))
    return reconcile.tree_diff(s, copy, columns)


@query("reconcile_sample")
def q_reconcile_sample(spark, sf):
    """Up to five differing keys per side of the copy that differs."""
    keys = ["chunk_id", "standalone_score"]
    left = gold.fact_chunk(silver_chunks(spark, sf), None)
    right = fx.direct_chunks(spark, sf).withColumn(
        "standalone_score", F.when(F.col("standalone_score") == 1, F.lit(0)).otherwise(F.col("standalone_score")))
    return reconcile.diff_sample(reconcile.multiset_diff(left, right, keys), keys)


# --- identity, lineage, incremental --------------------------------------------------

from clipmart.functions import identity as ident  # noqa: E402
from clipmart.operators import assets, incremental  # noqa: E402


@query("asset_type")
def q_asset_type(spark, sf):
    l = fx.landing_listing(spark, sf)
    return l.select("page_id", "folder", ident.asset_type(F.col("folder")).alias("asset_type"))


@query("uri_parts")
def q_uri_parts(spark, sf):
    m = fx.identity_manifest(spark, sf).select("doc_id", "source_uri")
    return assets.uri_parts(m)


@query("near_dup_flag")
def q_near_dup(spark, sf):
    d = fx.table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("client_id"), F.col("source").alias("folder"),
        F.col("lang").alias("stem"), F.floor(F.col("n_chars") / 15).cast("long").alias("duration_sec"))
    return assets.near_dup(d).select("doc_id", "near_dup")


@query("lineage_walk")
def q_lineage_walk(spark, sf):
    return lineage.closure(gold.lineage(dim_asset(spark, sf)))


@query("chunk_walks")
def q_chunk_walks(spark, sf):
    """The first 20 sequences of four chunks, by their ids."""
    from clipmart.operators import walks
    f, c = _graph(spark, sf)
    w = walks.chunk_walks(f, c, "Hook", steps=3, n=20)
    return w.select("rank", *(F.col("chunk_ids")[i].alias(f"chunk_{i + 1}") for i in range(4)))


@query("sequence_walk")
def q_sequence_walk(spark, sf):
    f, c = _graph(spark, sf)
    return lineage.theme_walk(f, c, "Hook", steps=4)


def _existing_manifest(spark, sf):
    l = fx.landing_listing(spark, sf)
    return l.where(F.col("page_id") % 5 == 0).select("asset_id")


@query("ingest_identity")
def q_ingest(spark, sf):
    l = fx.landing_listing(spark, sf)
    return assets.ingest(l, _existing_manifest(spark, sf), fx.BUCKET, fx.LOAD_TS)


@query("manifest_append")
def q_manifest_append(spark, sf):
    """Two ingest runs appended to one manifest table (K4): the second run
    appends only ids the stored manifest does not have.  The first run holds
    every asset twice, the second time as ingested a day later."""
    import uuid
    path = scratch_path(spark, "manifest", uuid.uuid4().hex)
    l = fx.landing_listing(spark, sf)
    first = assets.ingest(l.where(F.col("page_id") % 5 == 0), None, fx.BUCKET, fx.LOAD_TS).drop("page_id")
    again = first.withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 1 day"))
    cio.append_manifest(again.unionByName(first), path)
    cio.append_manifest(assets.ingest(l, None, fx.BUCKET, fx.LOAD_TS).drop("page_id"), path)
    return spark.read.parquet(path)


@query("unextracted_assets")
def q_unextracted(spark, sf):
    l = fx.landing_listing(spark, sf)
    manifest = assets.ingest(l, None, fx.BUCKET, fx.LOAD_TS)
    bronze = l.where(F.col("has_bronze")).select("asset_id")
    return incremental.unextracted(manifest, bronze, "client1")


def _ttl_plan(spark, sf):
    l = fx.landing_listing(spark, sf)
    return incremental.ttl_plan(l, fx.landing_clients(spark), l.where(F.col("has_bronze")).select("asset_id"),
                                fx.LANDING_NOW)


@query("ttl_plan")
def q_ttl_plan(spark, sf):
    return _ttl_plan(spark, sf)


@query("ttl_summary")
def q_ttl_summary(spark, sf):
    return incremental.ttl_summary(_ttl_plan(spark, sf))


@query("bronze_append")
def q_bronze_append(spark, sf):
    """Three appends to one table (K2): half of the assets, all of them and
    each twice, all again; every asset is stored once."""
    import uuid
    path = scratch_path(spark, "bronze", uuid.uuid4().hex)
    b = fx.bronze_asset_raw(spark, sf)
    for batch in (b.where(F.expr("cast(substr(asset_id, 4) as bigint) % 2 = 0")), b.unionByName(b), b):
        incremental.append_bronze(batch, path)
    return spark.read.schema(b.schema).parquet(path).select("asset_id", "client_id", "content_sha256", "chunk_count")


@query("embed_incremental")
def q_embed(spark, sf):
    s = silver_chunks(spark, sf)
    old = fx.chunk_embedding(spark, sf)
    stale = old.withColumn("content_hash", F.when(
        F.expr("cast(regexp_extract(chunk_id, '^doc([0-9]+)_', 1) as bigint) % 2 = 1"), F.lit("stale"))
        .otherwise(F.col("content_hash")))
    e = incremental.embed(s, stale)
    return e.select("chunk_id", "content_hash", "status", F.size("embedding").alias("dim"))


# --- vectors and text search ----------------------------------------------------------

def _query_vector(spark, sf, vec_id: int = 1):
    """One query vector taken from the embeddings table (a 64-float literal);
    without a row of that id it is empty, and distances to it are null."""
    row = fx.table(spark, sf, "embeddings").where(F.col("vec_id") == vec_id).select("embedding").first()
    return [float(x) for x in row["embedding"]] if row and row["embedding"] else []


def _vector_hits(spark, sf, metric: str, score: str):
    """The ids of the k best first; only the envelopes of their assets are
    then parsed for what a reader sees."""
    from clipmart.session import materialize
    found = materialize(search.nearest(fact_chunk(spark, sf), _query_vector(spark, sf), 10, metric, keep=("asset_id",)))
    few = fx.bronze_asset_raw(spark, sf).join(F.broadcast(found.select("asset_id").distinct()), "asset_id", "left_semi")
    shown = gold.fact_chunk(silver.clean(silver.explode_chunks(few, fx.ID_WIDTH)), None)
    return search.hits(found.drop("asset_id"), shown, dim_asset(spark, sf)).withColumn(score, F.round(score, 6))


@query("semantic_topk")
def q_semantic_topk(spark, sf):
    return _vector_hits(spark, sf, "l2", "distance")


@query("cosine_topk")
def q_cosine_topk(spark, sf):
    return _vector_hits(spark, sf, "cosine", "similarity")


@query("semantic_join")
def q_semantic_join(spark, sf):
    # the stated query set: every 20th vector, against all chunks
    q = fx.table(spark, sf, "embeddings").where(F.col("vec_id") % 20 == 0) \
        .select(F.col("vec_id").alias("query_id"), "embedding")
    return search.semantic_join(q, fact_chunk(spark, sf), 5, "l2").withColumn("score", F.round("score", 6))


@query("ann_topk")
def q_ann_topk(spark, sf):
    """M4 over a stored index: cells near the vector first, then those that
    may still hold something nearer."""
    q = _query_vector(spark, sf)
    found, _ = vectorindex.nearest(_vector_index(spark, sf), q, 10) if q else (
        search.nearest(fact_chunk(spark, sf), q, 0).withColumnRenamed("chunk_id", "id"), [])
    return found.select(F.col("id").alias("chunk_id"), F.round("distance", 6).alias("distance"))


def _vector_index(spark, sf):
    import uuid
    path = scratch_path(spark, "vector-index", uuid.uuid4().hex)
    return vectorindex.build(fact_chunk(spark, sf).where(F.col("embedding").isNotNull()), path)


@query("semantic_join_index")
def q_semantic_join_index(spark, sf):
    """M3 over the stored index: the same rows as ``semantic_join``."""
    q = fx.table(spark, sf, "embeddings").where(F.col("vec_id") % 20 == 0) \
        .select(F.col("vec_id").alias("query_id"), "embedding")
    got = vectorindex.join(_vector_index(spark, sf), q, 5)
    return got.select("query_id", F.col("id").alias("chunk_id"), F.round("distance", 6).alias("score"), "rank")


@query("serving_view")
def q_serving_view(spark, sf):
    """The view over a stored fact table, registered anew after a write (K8)."""
    import uuid
    path = scratch_path(spark, "serving", uuid.uuid4().hex)
    f = fact_chunk(spark, sf)
    f.write.parquet(path)
    return cio.serving_view(spark, path, schema=f.schema)


@query("embedding_scan")
def q_embedding_scan(spark, sf):
    """The stored side table, read through its key guard."""
    import uuid
    path = scratch_path(spark, "embeddings", uuid.uuid4().hex)
    fx.chunk_embedding(spark, sf).write.parquet(path)
    return cio.read_embeddings(spark, path).select("chunk_id", "content_hash", F.size("embedding").alias("dim"))


@query("bm25_search")
def q_bm25(spark, sf):
    """M2 over a stored index that skips the posting blocks which can't hold a result."""
    return textindex.search(_text_index(spark, sf), _benchmark_queries(spark, sf), 5).withColumn("score", F.round("score", 6))


def _benchmark_queries(spark, sf):
    return fx.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def _text_index(spark, sf):
    import uuid
    return textindex.build(silver_chunks(spark, sf), scratch_path(spark, "text-index", uuid.uuid4().hex))


@query("bm25_full")
def q_bm25_full(spark, sf):
    """M2 without an index: every document that shares a term is scored."""
    return search.bm25(silver_chunks(spark, sf), _benchmark_queries(spark, sf), 5).withColumn("score", F.round("score", 6))


@query("text_index")
def q_text_index(spark, sf):
    """What the stored text index knows of each term."""
    index = _text_index(spark, sf)
    held = index.postings.groupBy("term").agg(F.sum("n").alias("entries"), F.sum(F.size("entries")).cast("long").alias("stored"))
    return index.terms.select("term", "df", F.round("idf", 6).alias("idf")).join(held, "term")


@query("search_contains")
def q_search_contains(spark, sf):
    """Clips whose text contains a pattern, through the stored trigram index."""
    import uuid

    from clipmart.operators import substring
    f = materialize(fact_chunk(spark, sf).drop("embedding"))
    index = substring.build(f, scratch_path(spark, "trigrams", uuid.uuid4().hex))
    return search.clips(substring.search(index, f, "TIONan%the"), dim_asset(spark, sf), min_score=2, order=False)


@query("search_keyword")
def q_search_keyword(spark, sf):
    s = silver_chunks(spark, sf)
    return search.by_keyword(gold.fact_chunk(s, None), gold.keywords(s), "attion") \
        .select("chunk_id", "asset_id", "chunk_theme", "standalone_score")


@query("tenant_scope")
def q_tenant_scope(spark, sf):
    s = silver_chunks(spark, sf)
    return search.scope(gold.fact_chunk(s, None), dim_asset(spark, sf), "src3") \
        .select("chunk_id", "asset_id", "chunk_theme")


# --- telemetry log (JSON source / sink) ---------------------------------------------

from clipmart.sources import io as cio  # noqa: E402
from clipmart.session import scratch_path  # noqa: E402


def _run_log(spark, sf):
    import uuid
    path = scratch_path(spark, "run_log", uuid.uuid4().hex)
    cio.append_events(fx.extraction_run_log(spark, sf), path)
    return cio.read_run_log(spark, path)


@query("extraction_run_scan")
def q_run_scan(spark, sf):
    return gold.extraction_run(_run_log(spark, sf))


@query("extraction_telemetry")
def q_telemetry(spark, sf):
    return gold.extraction_summary(gold.extraction_run(_run_log(spark, sf)))


# --- lake sources and sinks ------------------------------------------------------------

from clipmart import schemas  # noqa: E402


def _lake(spark, sf):
    """Write the bronze fixtures as a client-partitioned lake under the
    shared checkpoint folder and return its root."""
    import uuid
    root = scratch_path(spark, "lake", uuid.uuid4().hex)
    cio.write_table(fx.bronze_asset_raw(spark, sf), root, "bronze_asset_raw")
    perf_b = fx.bronze_ad_performance(spark, sf).withColumn(
        "client_id", F.concat(F.lit("src"), (F.expr("cast(substr(ad_id, 3) as bigint)") % 20).cast("string")))
    cio.write_table(perf_b, root, "bronze_ad_performance_raw")
    return root


@query("bronze_asset_scan")
def q_bronze_scan(spark, sf):
    b = cio.read_bronze(spark, _lake(spark, sf), "src3")
    return b.select("asset_id", "client_id", "content_sha256", "chunk_count")


@query("perf_scan")
def q_perf_scan(spark, sf):
    p = cio.read_perf(spark, _lake(spark, sf), "src3")
    return p.select("ad_id", "perf_date", "platform_native", "impressions", "spend", "client_id")


@query("cross_client_read")
def q_cross_client(spark, sf):
    b = cio.read_all_clients(spark, _lake(spark, sf), "bronze_asset_raw", schemas.BRONZE_ASSET_RAW)
    return b.groupBy("client_id").agg(F.count(F.lit(1)).alias("n_assets"),
                                      F.sum("chunk_count").cast("long").alias("n_chunks"))


@query("client_overwrite")
def q_client_overwrite(spark, sf):
    import uuid
    root = scratch_path(spark, "lake", uuid.uuid4().hex)
    fc = fact_chunk(spark, sf).drop("embedding").join(
        dim_asset(spark, sf).select("asset_id", "client_id"), "asset_id")
    cio.write_table(fc, root, "fact_chunk")
    cio.write_table(fc.where(F.col("standalone_score") >= 2), root, "fact_chunk", client_id="src3")
    t = cio.read_all_clients(spark, root, "fact_chunk", fc.drop("client_id").schema)
    return t.select("chunk_id", "client_id", "standalone_score")


@query("seed_scan")
def q_seed_scan(spark, sf):
    import uuid
    path = scratch_path(spark, "seeds", uuid.uuid4().hex)
    rows = fx.dim_client(spark, sf)
    # files whose columns stand in another order, beside one that is not asked for
    odd = F.pmod(F.xxhash64("client_id"), F.lit(2)) == 1
    rows.where(~odd).write.option("header", True).csv(os.path.join(path, "a"))
    rows.where(odd).withColumn("note", F.lit("x")).select(*rows.columns[1::-1], "note", *rows.columns[2:]) \
        .write.option("header", True).csv(os.path.join(path, "b"))
    return cio.read_seed(spark, path, schemas.DIM_CLIENT)


@query("landing_scan")
def q_landing_scan(spark, sf):
    import uuid
    root = scratch_path(spark, "landing", uuid.uuid4().hex)
    l = fx.landing_listing(spark, sf).join(fx.table(spark, sf, "pages").select("page_id", "html"), "page_id")
    cio.write_objects(l.dropDuplicates(["key"]), root, "key", "html").count()
    s = cio.scan_landing(spark, root)
    return s.select(F.regexp_extract("path", r"/(landing/[^/]+/video/[^/]+)$", 1).alias("key"), "length",
                    F.sha2("content", 256).alias("content_sha256"))


# --- streaming ---------------------------------------------------------------------------

from clipmart.sources import snapshots  # noqa: E402
from clipmart.streaming import jobs as sj  # noqa: E402


@query("stream_bronze_to_silver")
def q_stream_bronze(spark, sf):
    src, out, ckpt = sj.paths(spark, "x1")
    b = fx.bronze_asset_raw(spark, sf)
    odd = F.expr("cast(substr(asset_id, 4) as bigint) % 2 = 1")
    # two arrivals; the second repeats every third asset of the first
    b.where(~odd).write.parquet(os.path.join(src, "arrival=1"))
    b.where(odd | F.expr("cast(substr(asset_id, 4) as bigint) % 3 = 0")).write.parquet(os.path.join(src, "arrival=2"))
    sj.bronze_to_silver(spark, src + "/*", out, ckpt, fx.ID_WIDTH, max_files=1)
    return spark.read.parquet(out)


@query("stream_perf_upsert")
def q_stream_perf(spark, sf):
    src, out, ckpt = sj.paths(spark, "x2")
    b = fx.bronze_ad_performance(spark, sf)
    b.write.parquet(os.path.join(src, "pull=1"))
    restated = restated_pulls(spark, sf).where(F.col("load_ts") > F.lit(fx.LOAD_TS).cast("timestamp"))
    restated.write.parquet(os.path.join(src, "pull=2"))
    sj.perf_upsert(spark, src + "/*", out, ckpt, max_files=1)
    return snapshots.read(spark, out)


@query("table_versions")
def q_table_versions(spark, sf):
    """K6: a versioned table after a full write, an upsert of the restated
    pulls and a compaction; what readers of each version see."""
    import uuid
    base = scratch_path(spark, "versions", uuid.uuid4().hex)
    keys, order = sj.PERF_KEYS, ["load_ts", "content_hash"]
    cio.write_versioned(fx.bronze_ad_performance(spark, sf), base, keys, order)
    late = restated_pulls(spark, sf).where(F.col("load_ts") > F.lit(fx.LOAD_TS).cast("timestamp"))
    snapshots.append(late, base, keys, order)
    snapshots.compact(spark, base)
    seen = [snapshots.read(spark, base, v).select(F.lit(v).alias("version"), *keys, "impressions", "load_ts") for v in (1, 2, 3)]
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


@query("stream_daily_counts")
def q_stream_daily(spark, sf):
    _, out, ckpt = sj.paths(spark, "x3")
    sj.daily_counts(spark, sf, out, ckpt, delay="1 hour")
    return spark.read.parquet(out)


# --- whole jobs -------------------------------------------------------------------------

@query("gold_core")
def q_gold_core(spark, sf):
    """Bronze -> Silver -> the Gold core tables; one row per table with
    its row count and distinct key count."""
    t = gold.build_core(fx.bronze_asset_raw(spark, sf), fx.chunk_embedding(spark, sf),
                        fx.asset_manifest(spark, sf), fx.ID_WIDTH)
    keys = {"int_chunk_cleaned": ["chunk_id"], "dim_asset": ["asset_id"], "fact_chunk": ["chunk_id"],
            "bridge_chunk_compatibility": ["chunk_id", "compatible_theme"],
            "dim_keyword_bridge": ["chunk_id", "keyword"], "dim_theme_bridge": ["chunk_id", "theme"],
            "bridge_asset_lineage": ["parent_asset_id", "child_asset_id"]}
    out = None
    for name, k in keys.items():
        r = t[name].agg(F.count(F.lit(1)).alias("n_rows"),
                        F.count_distinct(*[F.col(c) for c in k]).alias("n_keys")) \
            .select(F.lit(name).alias("table_name"), "n_rows", "n_keys")
        out = r if out is None else out.unionByName(r)
    return out


@query("unused_edges_report")
def q_unused_edges(spark, sf):
    """Ad -> its edited asset -> RAW parent(s) by lineage -> RAW chunks
    that fit the winning themes and were never used in an ad.  A search
    for candidates, never an attribution of performance."""
    c = perf_chain(spark, sf)
    cand = perf.mine_unused(c["fact_chunk"], c["dim_asset"], c["mart_chunk_perf_correlation"],
                            c["bridge_ad_chunk"])
    edges = gold.lineage(c["dim_asset"])
    ads = c["fact_ad_performance"].select("ad_id", F.col("asset_id").alias("edited_asset_id")).distinct()
    return (ads.join(edges.withColumnRenamed("child_asset_id", "edited_asset_id"), "edited_asset_id")
            .join(cand.withColumnRenamed("asset_id", "parent_asset_id"), "parent_asset_id")
            .select("ad_id", "edited_asset_id", F.col("parent_asset_id").alias("raw_asset_id"),
                    "chunk_id", "chunk_theme", "standalone_score"))
