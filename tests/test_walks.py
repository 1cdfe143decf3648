"""Chunk walks against all walks, closure against breadth-first search."""

import itertools
import random

from clipmart.operators import lineage, walks


def all_walks(chunks, allows, start, steps):
    theme = dict(chunks)
    step = lambda w: [w + (c,) for c, t in chunks if t in allows.get(w[-1], ()) and c not in w]
    out = [(c,) for c, t in chunks if t == start]
    for _ in range(steps):
        out = list(itertools.chain.from_iterable(map(step, out)))
    assert all(theme[w[0]] == start for w in out)
    return sorted(out)


def tables(spark, chunks, allows, low=()):
    fact = spark.createDataFrame([(c, t, 1 if c in low else 4) for c, t in chunks] or [("", "", 0)],
                                 "chunk_id string, chunk_theme string, standalone_score int")
    edges = [(c, t) for c, some in allows.items() for t in some] * 2  # repeated edges count once
    return fact, spark.createDataFrame(edges or [(None, None)], "chunk_id string, compatible_theme string")


def found(df):
    rows = sorted((r["rank"], tuple(r["chunk_ids"])) for r in df.collect())
    assert [r for r, _ in rows] == list(range(1, len(rows) + 1))
    return [w for _, w in rows]


def test_random_graphs(spark):
    for seed in range(4):
        rng = random.Random(seed)
        themes = ["Hook", "P", "Q", "R"]
        chunks = [(f"c{i:02d}", rng.choice(themes)) for i in range(14)]
        allows = {c: rng.sample(themes, rng.randrange(3)) for c, _ in chunks}
        steps, n = rng.choice([(2, 3), (4, 10), (3, 1)])
        assert found(walks.chunk_walks(*tables(spark, chunks, allows), steps=steps, n=n)) == all_walks(chunks, allows, "Hook", steps)[:n]


def test_beginnings_without_an_end(spark):
    """The first hooks lead into two chunks that only allow each other: a
    neighbour-wise look ahead lets them through, so the width must grow."""
    chunks = [(f"a{i}", "Hook") for i in range(9)] + [("b1", "P"), ("b2", "P"), ("z0", "Hook"), ("z1", "X"), ("z2", "Y"), ("z3", "Z")]
    allows = {f"a{i}": ["P"] for i in range(9)} | {"b1": ["P"], "b2": ["P"], "z0": ["X"], "z1": ["Y"], "z2": ["Z"]}
    assert found(walks.chunk_walks(*tables(spark, chunks, allows), steps=3, n=2)) == [("z0", "z1", "z2", "z3")]


def test_no_walks(spark):
    chunks, allows = [("a", "Hook"), ("b", "P")], {"a": ["P"]}
    fact, compat = tables(spark, chunks, allows)
    assert found(walks.chunk_walks(fact, compat, steps=1)) == [("a", "b")]
    assert found(walks.chunk_walks(fact, compat, steps=2)) == []
    assert found(walks.chunk_walks(*tables(spark, chunks, allows, low={"b"}), steps=1)) == []
    assert found(walks.chunk_walks(fact, compat, start="none", steps=1)) == []


def depths(edges, most=None):
    after, out = {}, {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)
    for a in after:
        ring, seen, d = {a}, {}, 0
        while ring and (most is None or d < most):
            d += 1
            ring = {c for b in ring for c in after.get(b, ())} - set(seen)
            seen.update(dict.fromkeys(ring, d))
        out.update({(a, b): d for b, d in seen.items()})
    return out


def closed(spark, edges, most=None):
    df = spark.createDataFrame(edges, "parent_asset_id string, child_asset_id string")
    rows = lineage.closure(df, most).collect()
    got = {(r["ancestor"], r["descendant"]): r["depth"] for r in rows}
    assert len(got) == len(rows)
    return got


def test_closure_of_graphs_with_cycles(spark):
    for seed in range(2):
        rng = random.Random(seed)
        edges = [(f"n{rng.randrange(25)}", f"n{rng.randrange(25)}") for _ in range(35)]
        assert closed(spark, edges + [(None, "n1"), ("n1", None)]) == depths(edges)
        assert closed(spark, edges, 3) == depths(edges, 3)


def test_long_chain_in_few_rounds(spark, monkeypatch):
    rounds = []
    kept = lineage.materialize
    monkeypatch.setattr(lineage, "materialize", lambda df: rounds.append(1) or kept(df))
    edges = [(f"n{i}", f"n{i + 1}") for i in range(300)]
    assert closed(spark, edges) == {(f"n{i}", f"n{j}"): j - i for i in range(300) for j in range(i + 1, 301)}
    assert len(rounds) <= 11
