"""The hash tree against the plain difference, the trigram index against a scan."""

import random
import time
import uuid

import pytest
from pyspark.sql import functions as F

from clipmart.operators import reconcile, substring
from clipmart.session import scratch_path

SCHEMA = "k string, v int"


def both(spark, a, b):
    return spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)


def test_tree_finds_all_damage(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(f"k{i}", rng.randrange(5)) for i in range(3000)] + [(None, 1), (None, None), ("x", None)] * 2
    damaged = [r for r in rows if r[0] != "k17"] + [("new", 1), rows[5], (1 and "k9", 99), (None, 1)]
    a, b = both(spark, rows, damaged)
    want = sorted(map(str, reconcile.multiset_diff(a, b, ["k", "v"]).collect()))
    assert sorted(map(str, reconcile.tree_diff(a, b, ["k", "v"]).collect())) == want and len(want) == 5
    assert reconcile.tree_diff(a, a, ["k", "v"]).collect() == []
    _, _, left = reconcile.tree_levels(a, b, ["k", "v"])
    assert left[0] == len(rows) + len(damaged) and left[-1] < 0.02 * left[0]  # as little as is damaged
    monkeypatch.setattr(reconcile, "LEAF_ROWS", 10)
    monkeypatch.setattr(reconcile, "BRANCHES", 8)  # several levels
    assert sorted(map(str, reconcile.tree_diff(a, b, ["k", "v"]).collect())) == want
    _, _, left = reconcile.tree_levels(a, b, ["k", "v"])
    assert len(left) > 2 and left[-1] < left[1]


def test_exchanged_nulls_and_empty_sides(spark):
    schema = "a string, b string"
    one = spark.createDataFrame([("x", None), ("y", "z")], schema)
    two = spark.createDataFrame([(None, "x"), ("y", "z")], schema)
    assert sorted((r.a, r.b, r.side) for r in reconcile.tree_diff(one, two, ["a", "b"]).collect() if r.a) == [("x", None, "only_left")]
    assert reconcile.tree_diff(one, one.limit(0), ["a", "b"]).count() == 2
    assert reconcile.tree_diff(one.limit(0), one.limit(0), ["a", "b"]).count() == 0


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(2)
    words = ["Hello", "50%", "off", "today", "the", "Ümlaut", "a_b", "日本語の", "x"]
    rows = [(f"c{i}", " ".join(rng.choices(words, k=rng.randrange(6)))) for i in range(500)]
    return spark.createDataFrame([*rows, ("null", None), ("empty", ""), ("short", "ab")], "chunk_id string, transcript_segment string")


def test_same_rows_as_a_scan(spark, texts, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK", 50)
    index = substring.build(texts, scratch_path(spark, f"grams-{uuid.uuid4().hex}"))
    assert index.postings.groupBy("gram").count().where("count > 1").count() > 0
    for pattern in ("hello", "LLO tod", "ümlaut", "日本語", "y%off", "o_f", "ab", "%", "nowhere at all", "hello%nowhere", "50\\%"):
        want = sorted(r[0] for r in texts.where(F.col("transcript_segment").ilike(f"%{pattern}%")).select("chunk_id").collect())
        assert sorted(r[0] for r in substring.search(index, texts, pattern).select("chunk_id").collect()) == want
    found = substring.candidates(index, "today the Üml")
    assert 0 < found.count() < 0.5 * texts.count()  # texts that are read
    assert substring.candidates(index, "ab") is None and substring.candidates(index, "50\\%") is None


def test_trigrams_of_long_lines_and_repeated_ids(spark, monkeypatch):
    """A line's trigrams take time in proportion to its length, and texts under one id are found by their own."""
    monkeypatch.setattr(substring, "PIECE_CHARS", 40)  # several pieces of a batch
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = spark.createDataFrame([("long", long), ("twice", "same words"), ("twice", "same words"), ("twice", "other"), ("🙂", "a🙂b🙂c")],
                                  "chunk_id string, transcript_segment string")
    began = time.monotonic()
    index = substring.build(texts, scratch_path(spark, f"grams-{uuid.uuid4().hex}"))
    assert time.monotonic() - began < 60  # counting from the start of the line for each took minutes
    n = lambda pattern: substring.search(index, texts, pattern).count()
    assert (n("W59999"), n("w59998 w59999"), n("ame wor"), n("same%other"), n("🙂b🙂"), n("other")) == (1, 1, 2, 0, 1, 1)
    want = {long[i:i + 3] for i in range(len(long) - 2)}
    held = index.postings.join(index.rows.where("id = 'long'"), F.expr("array_contains(numbers, number)")).select("gram").collect()
    assert {r["gram"] for r in held} == want and len(held) == len(want)


def test_tree_reads_each_side_a_few_times(spark):
    """The number of rows comes from the sums of the first level, not from passes of its own."""
    rows, seen = [(f"k{i}", i % 5) for i in range(200)], spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    a, b = both(spark, rows, rows[1:])
    left, right, counts = reconcile.tree_levels(a.mapInPandas(count, SCHEMA), b.mapInPandas(count, SCHEMA), ["k", "v"])
    assert counts[0] == 399 and seen.value == 399
    assert (left.count(), right.count()) == (counts[-1] + 1 >> 1, counts[-1] >> 1)
