import corpus_pipeline as p
import pytest
from pyspark.sql import functions as F

from clipmart.llm import langid, mixing, quality, simhash, spm

from ..conftest import SMALL

DIR = SMALL.replace("0.001", "0.01")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into each stage, and the last result."""
    folder = tmp_path_factory.mktemp("steps")
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    for name, stage in p.STAGES:
        out.append(docs)
        path = str(folder / name.replace(" ", "-"))
        stage(spark, docs, DIR).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(steps):
    assert [n for n, _ in p.STAGES] == ["language ID", "quality rules", "SimHash near-dedup", "mixing", "SentencePiece"]
    assert all(df.columns == p.COLUMNS for df in steps[:5])


def test_stages_do_what_their_operators_decide(spark, steps):
    docs, told, kept, single, mixed, encoded = steps
    want = langid.predict(docs, langid.fit(docs)).where("NOT rejected")
    assert ids(told) == ids(want)
    stats = quality.statistics(told)
    assert ids(kept) == ids(quality.judged(stats, quality.fit(stats, spark.read.parquet(f"{DIR}/labels.parquet"))).where("kept"))
    found = simhash.near_duplicates(kept).select("component_id").distinct().collect()
    assert ids(single) == sorted(r["component_id"] for r in found)
    words = lambda df: df.withColumn("w", F.regexp_count("text", F.lit(mixing.WORD))).groupBy("doc_id").agg(F.sum("w").alias("w"))
    want = {r["doc_id"]: r["taken"] for r in mixing.taken(*mixing.mix(single)).where("taken > 0").collect()}
    assert {r["doc_id"]: r["w"] for r in words(mixed).collect()} == want
    assert encoded.count() == mixed.count()
    back = {(r["doc_id"], r["text"]) for r in spm.decode(encoded).collect()}
    assert back == {(r["doc_id"], r["text"]) for r in mixed.collect()}


def test_edges(spark, edges):
    """No stage fails on nulls, empty, long or repeated texts, or an empty table."""
    for _, stage in p.STAGES:
        out = stage(spark, edges, SMALL)
        out.collect()
        assert stage(spark, edges.limit(0), SMALL).collect() == []


def test_repeated_rows_stay_together(spark, edges):
    single = p.deduplicated(spark, edges, SMALL)
    assert single.groupBy("doc_id").count().where("count > 1").count() == 0


A = "a report on rivers and bridges in the north of the country by several authors"
B = "cooking with lentils and rice for large families needs patience and salt"
C = "the seventh moon of the outer planet has a thin layer of ice and dust"
ROWS = [(5, A), (5, A), (3, B), (5, B), (None, C), (None, C), (None, A + " and many more words that differ in all ways")]


def rows(spark, given):
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in given], "doc_id long, text string, lang string, source string, n_chars long")


def test_one_row_of_each_group(spark):
    single = p.deduplicated(spark, rows(spark, ROWS), SMALL)
    want = [(5, A), (3, B), (None, C), ROWS[-1]]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in single.collect()) == sorted((i or 0, t) for i, t in want)
    other = p.deduplicated(spark, rows(spark, [(1, A), (1, B)]), SMALL)  # unrelated texts under one id
    assert sorted(r["text"] for r in other.collect()) == sorted([A, B])


def test_mixing_tells_rows_apart(spark):
    docs = rows(spark, [(1, A), (1, B), (None, C)])
    out = p.mixed(spark, docs, SMALL).collect()
    want = {r["h"]: r["taken"] for r in mixing.taken(*mixing.mix(docs)).collect()}
    words = lambda t: len(t.split())
    assert {(r["doc_id"], r["text"]) for r in out} >= {(1, A), (1, B), (None, C)}
    assert sum(words(r["text"]) for r in out) == sum(want.values())


def test_every_stretch_of_the_mix_is_near_the_shares(spark, monkeypatch):
    """Rows are written in slot order: each quarter of them holds the sources as the whole does."""
    monkeypatch.setattr(mixing, "BLOCK", 64)
    given = [(i, f"{'word ' * (20 + i % 7)}{i}", "en", "abc"[i % 3], 0) for i in range(600)]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long")
    order = [(r["source"], len(r["text"].split())) for r in p.mixed(spark, docs, SMALL).collect()]
    share = lambda some: {s: sum(n for t, n in some if t == s) / sum(n for _, n in some) for s in "abc"}
    whole, quarter = share(order), len(order) // 4
    for k in range(4):
        part = share(order[k * quarter:(k + 1) * quarter])
        assert all(abs(part[s] - whole[s]) < 0.06 for s in "abc")
