from pyspark.sql import functions as F

from clipmart.operators import search
from clipmart.plans import catalog as C
from clipmart.plans import fixtures as fx

from .conftest import SMALL


def test_semantic_join_in_any_blocks(spark):
    q = fx.table(spark, SMALL, "embeddings").where(F.col("label") == 3) \
        .select(F.col("vec_id").alias("query_id"), "embedding")
    fc = C.fact_chunk(spark, SMALL)
    a = {tuple(r) for r in search.semantic_join(q, fc, 3).collect()}
    b = {tuple(r) for r in search.semantic_join(q, fc, 3, query_block=5, corpus_block=30).collect()}
    assert a == b and len(a) > 0


def test_equal_vectors_in_order_of_ids(spark):
    fact = spark.createDataFrame([(c, [1.0, 0.0]) for c in "zyaxb"], "chunk_id string, embedding array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id int, embedding array<double>")
    for metric in ("l2", "cosine"):
        for block in (1, 2, 100):
            got = search.semantic_join(q, fact, 2, metric, corpus_block=block).orderBy("query_id", "rank").collect()
            assert [r.chunk_id for r in got] == ["a", "b", "a", "b"]
        assert [r.chunk_id for r in search.nearest(fact, [1.0, 0.0], 2, metric).collect()] == ["a", "b"]


def test_nearest_ranks_unrounded_distances(spark):
    fact = spark.createDataFrame([("a", [1.0000003]), ("b", [1.0000001])], "chunk_id string, embedding array<double>")
    assert [r.chunk_id for r in search.nearest(fact, [0.0], 1).collect()] == ["b"]


def test_search_predicates_only_when_given(spark):
    fact = spark.createDataFrame(
        [("c1", "a", "Hook", "calm", 5, 1.0, 2.0, "Hello 50% off"), ("c2", "a", "CTA", "calm", 2, 0.0, 1.0, "buy")],
        "chunk_id string, asset_id string, chunk_theme string, sentiment string, standalone_score int, "
        "start_sec double, end_sec double, transcript_segment string")
    asset = spark.createDataFrame([("a", "name")], "asset_id string, asset_name string")
    assert search.clips(fact, asset).count() == 2
    assert [r.chunk_id for r in search.clips(fact, asset, min_score=4).collect()] == ["c1"]
    assert search.clips(fact, asset, contains="o_f").count() == 1  # _ matches the space in "o f"
    assert search.clips(fact, asset, contains="0%").count() == 1  # % is a wildcard, as in the reference


def test_bm25_prefers_rare_terms(spark):
    docs = spark.createDataFrame([("d1", "apple apple banana"), ("d2", "banana cherry"), ("d3", "banana")],
                                 "chunk_id string, transcript_segment string")
    q = spark.createDataFrame([(1, "apple banana")], "query_id int, query_text string")
    top = search.bm25(docs, q, 1).collect()
    assert top[0].chunk_id == "d1"


def test_ann_recall_against_exact(spark):
    fc = C.fact_chunk(spark, SMALL)
    for vid in (1, 2, 3):
        q = C._query_vector(spark, SMALL, vid)
        approx = search.ann(fc, q, 10)
        assert approx.count() == 10
        assert search.ann_recall(approx, search.nearest(fc, q, 10, "l2")) >= 0.8


def test_scores_summed_in_blocks_equal_joined_ones(spark, monkeypatch):
    """Also with small blocks, rows that share an id, and without one."""
    docs = spark.createDataFrame([(f"d{i % 40}" if i % 9 else None, f"common w{i % 7} w{i % 7} r{i % 13}") for i in range(90)] + [("e", None)],
                                 "chunk_id string, transcript_segment string")
    queries = spark.createDataFrame([(1, "common w1 r2"), (1, "w3 common"), (None, "r5"), (2, "nothing"), (3, None)], "query_id int, query_text string")
    got = lambda: sorted(map(str, search.bm25(docs, queries, 7).collect()))
    arrays = got()
    monkeypatch.setattr(search, "SCORES", 6)
    monkeypatch.setattr(search, "PRODUCTS", 3)
    blocks = got()
    monkeypatch.setattr(search, "MAX_QUERY_TERMS", 0)
    assert arrays == blocks == got() and len(arrays) == 14  # k of the two query ids that meet documents


def test_texts_are_cut_into_tokens_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    docs = spark.createDataFrame([(f"d{i}", f"a b{i % 3}") for i in range(50)], "chunk_id string, transcript_segment string")
    queries = spark.createDataFrame([(1, "a b1")], "query_id int, query_text string")
    assert search.bm25(docs.mapInArrow(counted, docs.schema), queries, 3).count() == 3 and seen.value == 50
