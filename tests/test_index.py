"""The stored text and vector indexes against scoring everything."""

import random
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clipmart.operators import search, textindex, vectorindex
from clipmart.plans import catalog as C
from clipmart.session import scratch_path

from .conftest import SMALL


def folder(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def texts(spark, n=400, seed=1):
    rng = random.Random(seed)
    common, rare = [f"c{i}" for i in range(8)], [f"r{i}" for i in range(200)]
    line = lambda: " ".join(rng.choices(common, k=rng.randrange(12)) + rng.choices(rare, k=rng.randrange(4)))
    docs = [(f"d{i:04d}", line()) for i in range(n)]
    docs += [(f"x{i:04d}", docs[i % 20][1]) for i in range(60)] + [("null", None), ("empty", "")]
    queries = [(i, line()) for i in range(25)] + [(100, None), (101, "unseen words"), (102, "c1 c1 c2"), (103, docs[3][1])]
    return (spark.createDataFrame(docs, "chunk_id string, transcript_segment string"),
            spark.createDataFrame(queries, "query_id int, query_text string"))


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_pruned_search_equals_scoring_everything(spark, monkeypatch):
    docs, queries = texts(spark)
    cols = ("query_id", "chunk_id", "rank", "score")
    index = textindex.build(docs, folder(spark, "text"))
    for k in (1, 1000):
        want = rows(search.bm25(docs, queries, k), *cols)
        assert rows(textindex.search(index, queries, k), *cols) == want
        assert len(want) > 25
    monkeypatch.setattr(textindex, "BLOCK", 4)  # terms of many blocks
    monkeypatch.setattr(textindex, "FIRST", 2)
    index = textindex.build(docs, folder(spark, "text"))
    assert index.postings.groupBy("term", "level").count().where("count > 3").count() > 0
    assert rows(textindex.search(index, queries, 5), *cols) == rows(search.bm25(docs, queries, 5), *cols)


def test_blocks_are_skipped(spark):
    """Over the whole small tables: what is read and scored, against all postings of the queries' terms."""
    index = C._text_index(spark, SMALL)
    total = textindex.work(index, C._benchmark_queries(spark, SMALL), 5).agg(
        *(F.sum(c).alias(c) for c in ("postings", "read", "scored"))).first()
    assert total["postings"] > 10_000
    assert total["read"] < 0.5 * total["postings"] and total["scored"] < 0.25 * total["postings"]


def test_index_is_built_from_one_pass(spark):
    """Postings hold numbers of documents, and the texts are read once."""
    docs, queries = texts(spark)
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    index = textindex.build(docs.mapInArrow(counted, docs.schema), folder(spark, "text"))
    assert seen.value == docs.count()
    held = index.postings.select(F.explode("entries").alias("e"), "term").select("e.number", "e.impact", "term")
    want = index.documents.select("number", F.explode("terms").alias("t")).select("number", "t.impact", "t.term")
    assert held.exceptAll(want).count() == want.exceptAll(held).count() == 0 and held.count() > 1000
    assert index.postings.schema["entries"].dataType.elementType["number"].dataType.simpleString() == "bigint"


def test_postings_are_dealt_as_packed_blocks(spark, monkeypatch):
    """Blocks are full or what is left over of a level, and never above BLOCK,
    also where a term stands in most documents; parts and batches don't matter."""
    docs, queries = texts(spark)
    monkeypatch.setattr(textindex, "BLOCK", 4)
    monkeypatch.setattr(textindex, "HELD", 300)
    monkeypatch.setattr(textindex, "PART", 500)
    index = textindex.build(docs.repartition(3), folder(spark, "text"))
    blocks = index.postings.select("*", F.size("entries").alias("size"), F.array_max("entries.impact").alias("most"))
    assert blocks.where("n != size OR n > 4 OR top != most OR level != floor(top * 16)").count() == 0
    assert blocks.where("n < 4").groupBy("term", "level").count().where("count > 1").count() == 0
    assert blocks.where("n = 4").count() > 50 and blocks.select("block").distinct().count() == blocks.count()
    want = index.documents.select(F.explode("terms").alias("t"), "number").select("number", "t.impact", "t.term")
    held = index.postings.select(F.explode("entries").alias("e"), "term").select("e.number", "e.impact", "term")
    assert held.exceptAll(want).count() == want.exceptAll(held).count() == 0 and held.count() > 1000
    assert rows(textindex.search(index, queries, 5), "query_id", "chunk_id", "rank", "score") == \
        rows(search.bm25(docs, queries, 5), "query_id", "chunk_id", "rank", "score")


def test_documents_stay_where_they_are(spark, monkeypatch):
    """Documents aren't shuffled to meet the candidates, which are marked by a bit each."""
    docs, queries = texts(spark)
    index = textindex.build(docs.repartition(5), folder(spark, "text"))  # numbers of several runs
    got = textindex.search(index, queries, 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[plan.index("MapInArrow"):]
    cols = ("query_id", "chunk_id", "rank", "score")
    assert rows(got, *cols) == rows(search.bm25(docs, queries, 5), *cols)
    some = index.documents.select("number").where("number % 3 = 1")
    keep = textindex._marked(some)
    numbers = [r["number"] for r in index.documents.select("number").collect()] + [1 << 50]
    kept = keep(pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64())], ["number"])).column(0).to_pylist()
    assert kept == [x for x in numbers if x % 3 == 1 and x < 1 << 50] and 0 < len(kept) < len(numbers) / 2
    monkeypatch.setattr(textindex, "MARKED", 0)
    assert rows(textindex.search(index, queries, 5), *cols) == rows(got, *cols)


def test_rows_that_share_an_id_are_one_document(spark):
    """Rows of equal length under one id are counted together, as a plain sum does it; also rows without an id."""
    docs = [("a", "c1 c1 c2"), ("a", "c1 c3 c3"), ("a", "c1"), ("b", "c1 c2"), ("c", ""), ("c", "c4"), (None, "c5 c6"), (None, "c6 c6"), ("d", None)]
    index = textindex.build(spark.createDataFrame(docs, "chunk_id string, transcript_segment string"), folder(spark, "text"))
    mean = sum(len((t or "").split()) for _, t in docs) / len(docs)
    tf = Counter((i, len(t.split()), w) for i, t in docs if t for w in t.split())
    want = Counter((i, w, round(n * 2.2 / (n + 1.2 * (0.25 + 0.75 * dl / mean)), 9)) for (i, dl, w), n in tf.items())
    held = index.documents.select("doc_id", F.explode("terms").alias("t")).collect()
    assert Counter((r["doc_id"], r["t"]["term"], round(r["t"]["impact"], 9)) for r in held) == want
    assert sorted(map(str, (r["doc_id"] for r in index.documents.collect()))) == ["None", "a", "b", "c"]
    assert {r["term"]: r["df"] for r in index.terms.collect()} == Counter(w for _, w, _ in want.elements())


def test_empty_text_index(spark):
    docs, queries = texts(spark)
    index = textindex.build(docs.limit(0), folder(spark, "text"))
    assert textindex.search(index, queries, 5).collect() == []
    index = textindex.build(docs, folder(spark, "text"))
    assert textindex.search(index, queries.limit(0), 5).collect() == []


def vectors(spark, n=600, groups=12, dim=8, spread=0.05, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim)) * 3
    m = centres[rng.integers(groups, size=n)] + rng.normal(size=(n, dim)) * spread
    m[n // 2:n // 2 + 40] = m[0]  # many equal ones
    data = [(f"v{i:05d}", [float(x) for x in v]) for i, v in enumerate(m)] + [("none", None)]
    return m, spark.createDataFrame(data, "chunk_id string, embedding array<double>")


def plain(m, q, k):
    d = np.sqrt(((m - q) ** 2).sum(1))
    return [(f"v{i:05d}", round(float(d[i]), 9)) for i in np.lexsort((np.arange(len(m)), d))[:k]]


def test_exact_search_reads_few_folders(spark):
    m, df = vectors(spark)
    index = vectorindex.build(df, folder(spark, "vectors"), cells=20)
    assert index.vectors.count() == len(m)
    read = 0
    for q in (m[0], m[5] + 0.3, np.zeros(8)):
        for k in (1, 10, 100, 5000):
            found, cells = vectorindex.nearest(index, q.tolist(), k, probes=2)
            assert [(r["id"], round(r["distance"], 9)) for r in found.collect()] == plain(m, q, k)
            read += len(cells) if k == 10 else 0
    assert read < 0.5 * 3 * index.cells.count()
    plan = vectorindex._in_cells(index, [1], m[0].tolist(), 3)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*cell#\d+ = 1", plan)  # other folders are not listed


def test_exact_join_meets_few_pairs(spark, monkeypatch):
    m, df = vectors(spark)
    q = [(i, m[i * 7].tolist()) for i in range(40)] + [(90, [9.0] * 8), (91, None)]
    queries = spark.createDataFrame(q, "query_id int, embedding array<double>")
    index = vectorindex.build(df, folder(spark, "vectors"), cells=20)
    want = {(i, r, *hit) for i, v in q if v for r, hit in enumerate(plain(m, np.array(v), 5), 1)}
    got = lambda: {(r["query_id"], r["rank"], r["id"], round(r["distance"], 9)) for r in vectorindex.join(index, queries, 5).collect()}
    assert got() == want
    compared, total = vectorindex.pairs_compared(index, queries, 5)
    assert total == 41 * len(m) and compared < 0.4 * total
    monkeypatch.setattr(vectorindex, "FILE_ROWS", 20)  # cells and their queries in several tasks
    monkeypatch.setattr(vectorindex, "QUERY_ROWS", 3)
    assert got() == want


def test_join_ships_queries_once_a_block(spark):
    """Vectors without structure: every query meets every cell, but a row of
    it goes to a block of cells, not to each cell."""
    rng = np.random.default_rng(5)
    m = rng.normal(size=(2000, 32))
    df = spark.createDataFrame([(f"v{i:05d}", v.tolist()) for i, v in enumerate(m)], "chunk_id string, embedding array<double>")
    index = vectorindex.build(df, folder(spark, "vectors"), cells=40)
    about = index.cells.collect()
    assert len(about) > 30 and {b for _, b, _ in vectorindex._blocks(about)} == {0}
    queries = spark.createDataFrame([(i, m[i].tolist()) for i in range(0, 100, 2)], "query_id int, embedding array<double>")
    found = vectorindex.joined(index, queries, 5)
    # k of each round and block, where it was k of each round and cell
    assert found.count() <= 50 * 5 * 2
    got = {(r["query_id"], r["rank"], r["id"], round(r["distance"], 9)) for r in vectorindex._ranked(found.select("query_id", "id", "distance"), 5).collect()}
    assert got == {(i, r, *hit) for i in range(0, 100, 2) for r, hit in enumerate(plain(m, m[i], 5), 1)}


def test_recall_and_folders_on_the_driver_vectors(spark):
    """Vectors without structure are the hardest case: recall 0.95 by reading part of the folders."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding")
    index = vectorindex.build(df, folder(spark, "vectors"))
    queries = [r["embedding"] for r in df.where(F.col("chunk_id").cast("int") % 200 == 1).select("embedding").collect()]
    n_cells, hit, read = index.cells.count(), 0, 0
    for q in queries:
        exact = {r["id"] for r in vectorindex.nearest(index, q, 10)[0].collect()}
        found, cells = vectorindex.nearest(index, q, 10, probes=round(0.75 * n_cells), exact=False)
        hit += len(exact & {r["id"] for r in found.collect()})
        read += len(cells)
    assert hit >= 0.95 * 10 * len(queries)
    assert read <= 0.76 * n_cells * len(queries)


def test_empty_vector_index(spark):
    _, df = vectors(spark)
    index = vectorindex.build(df.limit(0), folder(spark, "vectors"))
    assert vectorindex.nearest(index, [0.0] * 8, 3)[0].collect() == []
    assert vectorindex.join(index, spark.createDataFrame([(1, [0.0] * 8)], "query_id int, embedding array<double>"), 3).collect() == []
