import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from clipmart.llm import collocations

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, k=2000, longest=5):
    """Every phrase counted, every cut and every longer phrase tried."""
    n, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        of = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                of.update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, of in f.items():
        kept = {p: a for p, a in of.items() if a >= least and len(p) > 1}
        inside = {p[i:j] for p, a in kept.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if j - i < len(p) and 100 * a >= 100 * of[p[i:j]]}
        some = []
        for p, a in kept.items():
            if p not in inside:
                score, cut = min((1000 * a * n[lang] // (of[p[:c]] * of[p[c:]]), c) for c in range(1, len(p)))
                some.append((-score, -a, " ".join(p).encode(), of[p[:cut]], of[p[cut:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(some)[:k], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def got(docs, least, k=2000):
    return sorted(map(tuple, collocations.best(collocations.mined(docs, least=least), k).collect()))


def test_whole_table(spark, small, monkeypatch):
    rows = [tuple(r) for r in small.select("lang", "text").collect()]
    want = plain(rows, 20)
    assert len(want) > 100 and max(len(w[2].split()) for w in want) > 3
    assert got(small, 20) == want
    # many slices, a small bitmap, counts handed on early
    monkeypatch.setattr(collocations, "SLICE", 40)
    monkeypatch.setattr(collocations, "BITS", 12)
    monkeypatch.setattr(collocations, "CELLS", 5000)
    monkeypatch.setattr(collocations, "WORDS", 500)
    monkeypatch.setattr(collocations, "CHUNK", 3000)
    assert got(small, 20) == want
    assert got(small, 20, 7) == plain(rows, 20, 7)


def test_edges(spark, edges):
    rows = [tuple(r) for r in edges.select("lang", "text").collect()]
    for least in (1, 3):
        assert got(edges, least) == plain(rows, least)
    assert collocations.best(collocations.mined(edges.limit(0))).collect() == []
    assert got(edges, 10**6) == []


def test_one_hot_word_in_many_slices(spark, monkeypatch):
    """Nearly all phrases begin with one word; words hold odd characters."""
    rng = random.Random(3)
    words = ["the"] * 6 + [f"w{i}" for i in range(40)] + ["\x01", "é", "中", "\x00a"]
    rows = [(rng.choice(["en", "EN", None, "und"]), " ".join(rng.choice(words) for _ in range(60)) + rng.choice([".", "", "\t!"]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "lang string, text string")
    want = plain(rows, 3)
    assert got(df, 3) == want
    monkeypatch.setattr(collocations, "SLICE", 25)
    assert got(df, 3) == want


def test_slices_are_cut_by_rows(spark, small, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 60)
    stream = collocations.streams(small, least=20).withColumn("before", F.lit(None).cast("array<bigint>")).withColumn(
        "extended", F.lit(False))
    starts = collocations.boundaries(stream)
    rows = collocations.dealt(stream, starts)
    sizes = [r["count"] for r in rows.where("NOT carried").groupBy("slice").count().collect()]
    assert len(starts) > 3 and sum(sizes) == stream.count() and max(sizes) < 5 * 60
    assert rows.where("carried").count() <= 5 * len(starts)


def test_bitmap_lets_every_phrase_through(spark):
    rows = [("en", "a b", 1), ("fr", "a b", 1), ("en", "é 中", 1)]
    bits = np.frombuffer(collocations.bitmap_of(spark.createDataFrame(rows, "lang string, phrase string, f long"), 2), np.uint8)
    at = [int(collocations.places(collocations.word_hashes(p.encode().split(b" ")), lang, 2)[0]) for lang, p, _ in rows]
    assert all(bits[x >> 3] >> (x & 7) & 1 for x in at)
    assert int(np.unpackbits(bits).sum()) == len(set(at))
