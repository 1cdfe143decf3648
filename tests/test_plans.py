"""Plan-shape checks: pushdown into the parquet scan, bounded top-k,
no cartesian products in the skew-sensitive operators."""

import os
import tempfile

import pytest

from clipmart.operators import assemble, search
from clipmart.plans import catalog as C

from .conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_search_filters_and_columns_reach_the_gold_scan(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="clipmart-gold-"), "fact_chunk")
    C.fact_chunk(spark, SMALL).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    fact = spark.read.parquet(path)
    asset = C.dim_asset(spark, SMALL)
    p = plan(search.clips(fact, asset, theme="Problem", sentiment="calm", min_score=4, contains="an"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(chunk_theme), IsNotNull(sentiment), IsNotNull(standalone_score)" in p
    assert "EqualTo(chunk_theme,Problem)" in p and "GreaterThanOrEqual(standalone_score,4)" in p
    scan = [line for line in p.split("\n") if "FileScan parquet" in line and "fact_chunk" in line][0]
    assert "embedding" not in scan  # the vector column is pruned


def test_topk_per_group_is_window_group_limit(spark):
    f, c = C._graph(spark, SMALL)
    e = f.where("standalone_score >= 4").selectExpr("chunk_theme as t2", "chunk_id as c")
    p = plan(assemble._topk(e, ["t2"], "c", 5))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_no_cartesian_in_assembly_or_vectors(spark):
    for key in ("assemble_pairs", "semantic_topk", "semantic_join", "bm25_search", "anchor_alignment"):
        p = plan(C.QUERIES[key](spark, SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key
        assert "BatchEvalPython" not in p, key


@pytest.mark.parametrize("key", ["reconcile_rows", "reconcile_tables", "store_failures", "ann_topk"])
def test_envelopes_are_parsed_once(spark, key, monkeypatch):
    """Several steps read the chunks; what they read is stored."""
    from clipmart.operators import silver
    from clipmart.plans import catalog

    seen, explode = spark.sparkContext.accumulator(0), silver.explode_chunks

    def counted(bronze, *args):
        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return explode(bronze.mapInArrow(run, bronze.schema), *args)

    monkeypatch.setattr(silver, "explode_chunks", counted)
    catalog.QUERIES[key](spark, SMALL).collect()
    assert seen.value == spark.read.parquet(f"{SMALL}/documents.parquet").count()
