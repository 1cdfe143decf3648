import re
from collections import Counter

import numpy as np

from clipmart.llm import quality

from ..conftest import SMALL


def by_definition(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    n = Counter(windows)
    inside = {k for i, w in enumerate(windows) if n[w] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside))


def test_counts(spark, small, edges):
    for docs in (small, edges):
        want = sorted(((r["doc_id"] or 0), *by_definition(r["text"])) for r in docs.select("doc_id", "text").collect())
        got = quality.statistics(docs).collect()
        assert sorted(((r["doc_id"] or 0), *(r[c] for c in quality.COUNTS)) for r in got) == want


def test_windows():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 8, 9, 16, 40, 300):
        for kinds in (1, 2, 3):
            words = [str(x) for x in rng.integers(0, kinds, n)]
            assert quality.count_text(" ".join(words))[4] == by_definition(" ".join(words))[4]


def forest_of(x, trees=100, rows=256):
    rng = np.random.default_rng(7)
    grown = [quality.grow(x[rng.choice(len(x), min(rows, len(x)), replace=False)], t) for t in range(trees)]
    return quality.Forest(*(np.array(a) for a in zip(*grown)))


def test_forest_sets_outliers_apart():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    scores = forest_of(x).score(x)
    assert scores.argmax() == 500 and scores[500] > 0.7
    assert np.isfinite(forest_of(np.zeros((100, 2))).score(np.zeros((3, 2)))).all()
    assert np.isfinite(forest_of(np.array([[0.0, 1.0], [2.0, 1.0]])).score(np.ones((1, 2)))).all()


def plain_path(rows, x, splits, level=0, node=0):
    """Edges from the root to where x ends among the tree's rows, plus the usual rest: row by row, from the splits."""
    if node not in splits:
        return level + quality.usual_path(len(rows))
    f, v = splits[node]
    side = [r for r in rows if (r[f] >= v) == (x[f] >= v)]
    return plain_path(side, x, splits, level + 1, 2 * node + 1 + (x[f] >= v))


def test_scores_by_definition(spark):
    """Path lengths, scores and verdicts recomputed row by row from the splits and the rows drawn."""
    folder = SMALL.replace("0.001", "0.01")
    stats = quality.statistics(spark.read.parquet(f"{folder}/documents.parquet")).cache()
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    passed = stats.where(~quality.base_failed())
    total = passed.count()
    assert total > quality.SUBSAMPLE
    given = {t: g for t, g in quality.drawn(passed, total).toPandas().groupby("tree")}
    assert len(given) == quality.TREES
    sizes = [len(g) for g in given.values()]
    assert abs(np.mean(sizes) - quality.SUBSAMPLE) < 8 and max(sizes) < 2 * quality.SUBSAMPLE
    # different trees draw different rows, and together they draw from nearly all
    assert len(set().union(*(set(g["row"]) for g in given.values()))) > 0.9 * passed.distinct().count()
    forest = quality.fit(stats, labels)
    some = quality.judged(stats, forest).where("NOT base_failed").orderBy("doc_id").toPandas().iloc[::40]
    x = quality.features(some)
    inside = {t: quality.features(g) for t, g in given.items()}
    splits = [{n: (int(f[n]), v[n]) for n in np.flatnonzero(f >= 0)} for f, v in zip(forest.feature, forest.split)]
    for row, score, kept in zip(x, some["score"], some["kept"]):
        mean = np.mean([plain_path(inside[t], row, splits[t]) / quality.usual_path(len(inside[t])) for t in given])
        assert abs(2 ** -mean - score) < 1e-9
        assert kept == (score < forest.threshold)


def test_a_row_repeated_often_does_not_fill_trees(spark):
    cols = [*quality.COUNTS, *quality.MORE]
    rows = [(i, *(100 + (i * 7 + j) % 50 for j in range(len(cols)))) for i in range(200)] + [(1000, *([90] * len(cols)))] * 5000
    got = quality.drawn(spark.createDataFrame(rows, ["doc_id", *cols]), 200).groupBy("tree", "row").count()
    assert got.where("count > 1").count() == 0


def test_calibrated_on_labels(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/labels.parquet")
    stats = quality.statistics(docs).cache()
    forest = quality.fit(stats, labels)
    rows = quality.judged(stats, forest).join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = ([r for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(not r["kept"] for r in good) <= 0.03 * len(good)
    assert sum(not r["kept"] for r in bad) >= 0.5 * len(bad)
    again = quality.fit(stats, labels)
    assert again.threshold == forest.threshold


def test_nothing_to_learn(spark, small, edges):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 5)], "doc_id long, quality int")
    stats = quality.statistics(edges)
    assert quality.fit(stats, labels) is None
    rows = quality.judged(stats, None).collect()
    assert len(rows) == edges.count() and all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert {r["doc_id"]: r["kept"] for r in rows}[7] is False  # one passage over and over
    assert quality.judged(quality.statistics(small.limit(0)), None).collect() == []
