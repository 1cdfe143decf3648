import numpy as np
import pytest

from clipmart.llm import ann

from ..conftest import SMALL


def every_best(rows, k, every):
    """(query id, rank, id, score) of the k best of every query row, by comparing with every other row."""
    v = [(i, x) for i, x in rows if i is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    out = []
    for n, (q, x) in enumerate(v):
        if q % every == 0:
            s = [(-float(np.dot(x, y)), i) for m, (i, y) in enumerate(v) if m != n and len(x) == len(y)]
            out += [(q, r, i, -d) for r, (d, i) in enumerate(sorted(s)[:k], 1)]
    return sorted(out)


def best(rows, k, every):
    """query -> (id, score) of the k best, where ids are unique."""
    out = {}
    for q, _, i, s in every_best(rows, k, every):
        out.setdefault(q, []).append((i, s))
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return out


@pytest.mark.parametrize("block", [ann.BLOCK, 200])
def test_recall(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERIES", 30)
    df = spark.read.parquet(f"{SMALL.replace('0.001', '0.1')}/embeddings.parquet").limit(1500)
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in df.collect()]
    want, got = best(rows, 20, 20), result(ann.neighbours(df))
    assert set(got) == set(want)
    hits = sum(len({i for i, *_ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    of = dict(rows)
    for q, found in got.items():
        assert [r for *_, r in found] == list(range(1, len(found) + 1))
        assert all(s == pytest.approx(np.dot(of[q], of[i]), rel=1e-12, abs=1e-15) for i, s, _ in found)
        assert [(-s, i) for i, s, _ in found] == sorted((-s, i) for i, s, _ in found)


def test_lengths_differ(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 30])).tolist()) for i in range(400)]
    got, want = result(ann.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), best(rows, 20, 20)
    hits = sum(len({i for i, *_ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (None, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (21, [1.0, 2.0, 3.0]),
            (40, [1.0, 0.0, 0.0]), (60, [5.0]), (-20, [-1.0, 0.0]), (9, [1e-200, 0.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, block int")
    assert sorted(tuple(r) for r in ann.neighbours(df).collect()) == every_best(rows, 20, 20)
    assert ann.neighbours(df.limit(0)).collect() == []
    assert ann.neighbours(df.where("vec_id = 1")).collect() == []
    assert {q: len(v) for q, v in result(ann.neighbours(df, k=2)).items()} == {0: 2, 20: 4, -20: 2, 40: 1}


def test_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 1.0]), (7, [0.1, 0.0]), (7, [50.0, 50.0]), (7, [50.0, 50.0]), (0, [1.0, 1.0]), (3, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in ann.neighbours(df, k=3).collect()) == every_best(rows, 3, 20)
    assert [(r.rank, r.vec_id, r.score) for r in ann.neighbours(df, k=3).collect() if r.rank == 1] == [(1, 7, 100.0)] * 2
