import random

import pytest

from clipmart.operators import assemble, dq


def graph(spark, chunks, edges):
    fact = spark.createDataFrame(
        [(c, "a" + c[-1], t, s, 0.0, 1.0, c) for c, t, s in chunks],
        "chunk_id string, asset_id string, chunk_theme string, standalone_score int, start_sec double, "
        "end_sec double, transcript_segment string")
    compat = spark.createDataFrame(edges, "chunk_id string, compatible_theme string")
    return fact, compat


def same(spark, chunks, edges, n):
    f, c = graph(spark, chunks, edges)
    got = [tuple(r) for r in assemble.sequences(f, c, "Hook", n).select(
        "hook_chunk_id", "body_chunk_id", "cta_chunk_id").collect()]
    good = {x: theme for x, theme, score in chunks if score >= 4}
    want = sorted((h, b, x) for h, first in edges if good.get(h) == "Hook" for b in good if good[b] == first and b != h
                  for lead, second in edges if lead == b for x in good if good[x] == second and x not in (h, b))[:n]
    assert sorted(got) == sorted(want)
    return got


def test_theme_with_one_eligible_chunk_and_hook_as_only_candidate(spark):
    chunks = [("h1", "Hook", 5), ("h2", "Hook", 3), ("b1", "Body", 4), ("b2", "Body", 4), ("x1", "CTA", 4)]
    # b1's only candidate is the hook itself: dead for h1; b2 -> x1 is live
    edges = [("h1", "Body"), ("h1", "Body"), ("b1", "Hook"), ("b2", "CTA")]
    got = same(spark, chunks, edges, 5)
    assert got == [("h1", "b2", "x1"), ("h1", "b2", "x1")]  # duplicate edge multiplies


def test_self_compatible_theme(spark):
    chunks = [("h1", "Hook", 5), ("h2", "Hook", 5), ("h3", "Hook", 1)]
    edges = [("h1", "Hook"), ("h2", "Hook")]
    same(spark, chunks, edges, 10)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_graphs_equal_naive(spark, seed):
    rnd = random.Random(seed)
    themes = ["Hook", "A", "B", "C"]
    chunks = [(f"c{i:02d}", rnd.choice(themes), rnd.randint(2, 5)) for i in range(18)]
    edges = [(c, rnd.choice(themes)) for c, _, _ in chunks for _ in range(rnd.randint(0, 2))]
    same(spark, chunks, edges, rnd.choice([1, 3, 7]))


def test_pair_counts_equal_pair_rows(spark):
    chunks = [("h1", "Hook", 5), ("h2", "Hook", 4), ("b1", "Body", 4), ("b2", "Body", 2), ("h3", "Hook", 4)]
    edges = [("h1", "Body"), ("h1", "Hook"), ("h2", "Body"), ("h2", "Body")]
    f, c = graph(spark, chunks, edges)
    rows = assemble.pairs(f, c).groupBy("hook_asset", "next_theme").count().collect()
    counts = assemble.pair_counts(f, c).collect()
    assert {(r.hook_asset, r.next_theme, r["count"]) for r in rows} == \
        {(r.hook_asset, r.next_theme, r.n_pairs) for r in counts}


@pytest.mark.parametrize("seed", [1, 2])
def test_first_pairs_and_endpoints_equal_the_pair_rows(spark, seed):
    rng = random.Random(seed)
    themes = ["Hook", "Problem", "Solution", "CTA"]
    chunks = [(f"c{i:02d}", f"a{i % 5}", rng.choice(themes), rng.choice([2, 4, 5])) for i in range(40)]
    edges = [(f"c{rng.randrange(40):02d}", rng.choice([*themes, "None"])) for _ in range(40)]
    fact = spark.createDataFrame([(*c, f"text {c[0]}") for c in chunks],
                                 "chunk_id string, asset_id string, chunk_theme string, standalone_score int, transcript_segment string")
    compat = spark.createDataFrame(edges, "chunk_id string, compatible_theme string")
    rows = sorted((r.hook_chunk, r.next_chunk) for r in assemble.pairs(fact, compat).collect())
    for n in (1, 5, 1000):
        got = assemble.first_pairs(fact, compat, n=n).collect()
        assert sorted((r.hook_chunk, r.next_chunk) for r in got) == rows[:n]
        assert all(r.hook_text == f"text {r.hook_chunk}" and r.next_text == f"text {r.next_chunk}" for r in got)
    ends = {(r.chunk_id, r.role) for r in assemble.endpoints(fact, compat).collect()}
    assert ends == {(h, "hook") for h, _ in rows} | {(x, "next") for _, x in rows}
    assert dq.assembly_safe(assemble.endpoints(fact, compat), fact).count() == 0
    low = dq.assembly_safe(assemble.endpoints(fact, compat, min_score=1), fact).collect()
    assert {(r.chunk_id, r.role) for r in low} == {
        (c, role) for r in assemble.pairs(fact, compat, min_score=1).collect()
        for c, role in ((r.hook_chunk, "hook"), (r.next_chunk, "next")) if dict((x[0], x[3]) for x in chunks)[c] < 4}
