import random
import zlib
from collections import Counter

import numpy as np

from clipmart.llm import variants


def edits_of_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows, least_codes=5, least_n=3, ratio=2):
    """Words that become equal when one letter is masked or left out."""
    n = Counter()
    for doc, text in rows:
        for w in variants.RUN.findall((text or "").translate(variants.LOWER)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            n[w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w] += 1
    n = {w: k for w, k in n.items() if len(w) >= least_codes and k >= least_n}
    gaps = {}  # what is one edit apart shares a text with a gap
    for w in n:
        for i in range(len(w) + 1):
            for gap in {w[:i] + "_" + w[i:], w[:i] + "_" + w[i + 1:]}:
                gaps.setdefault(gap, []).append(w)
    near_of = {w: set() for w in n}
    for some in gaps.values():
        for w in some:
            near_of[w].update(o for o in some if edits_of_one(w, o))
    out = {}
    for w, near in near_of.items():
        best = min(near, key=lambda o: (-n[o], o), default=None)
        out[w] = (best if near and n[best] >= ratio * n[w] else None, n[w], len(near))

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w
    return {(w, f, root(w), k, c, n.get(f)) for w, (f, k, c) in out.items()}


def got(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {tuple(r) for r in rows}


def test_whole_table(spark, small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    want = plain(rows)
    assert got(variants.grouped(small)) == want
    assert any(f for _, f, *_ in want) and len(want) > 1000


def test_edges(spark, edges):
    rows = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    for least in (1, 5):
        want = plain(rows, least_codes=least, least_n=1)
        assert got(variants.grouped(edges, least_codes=least, least_n=1)) == want
    assert variants.grouped(edges.limit(0)).collect() == []


def test_pieces_chains_and_long_words(spark, monkeypatch):
    """Pieces of a few words, chains of forms, one word of 3,000 letters and its variant."""
    rng = random.Random(4)
    base = ["".join(rng.choice("abé") for _ in range(5)) for _ in range(120)]
    texts = [(i, " ".join(rng.choice(base) for _ in range(80)).upper()) for i in range(30)]
    texts += [(100 + i, w) for i, w in enumerate(["chainaaa"] * 40 + ["chainaab"] * 16 + ["chainabb"] * 7 + ["chainbbb"] * 3)]
    long = "".join(rng.choice("xyz") for _ in range(3000))
    texts += [(200 + i, w) for i, w in enumerate([long] * 9 + [long[:50] + long[51:]] * 4 + [long[::-1]] * 4)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = plain(texts)
    assert got(variants.grouped(df)) == want
    monkeypatch.setattr(variants, "PIECE", 3)
    assert got(variants.grouped(df)) == want
    assert max(w[4] for w in want) > 5


def test_products_find_every_edit():
    rng = random.Random(8)
    same = sorted({"".join(rng.choice("ab") for _ in range(7)) for _ in range(200)})
    more = sorted({"".join(rng.choice("ab") for _ in range(8)) for _ in range(200)})
    for right in (same, more):
        i, j = variants.near_pairs(variants.codes_of(same), variants.codes_of(right))
        found = {(same[a], right[b]) for a, b in zip(i.tolist(), j.tolist())}
        assert found == {(a, b) for a in same for b in right if edits_of_one(a, b)}


def test_every_pair_of_keys_comes_up_once():
    groups = 4
    keys = [np.array(k) for k in np.ndindex(4, 3, 3, 3)]
    for x in keys:
        for y in keys:
            gone = sum(tuple(x + m) == tuple(y) for m in variants.moves(groups))
            back = sum(tuple(y + m) == tuple(x) for m in variants.moves(groups))
            full = lambda k: np.array([*k[1:], k[0] - k[1:].sum()])
            d = ((full(x) - full(y)) ** 2).sum()
            close = (x == y).all() or (x[0] == y[0] and d == 2) or (abs(x[0] - y[0]) == 1 and d == 1)
            assert (gone or back) == bool(close) and gone + back <= 1 + (x == y).all()




def test_what_explode_makes_is_not_broadcast(spark, small, monkeypatch):
    """A vocabulary below Spark's bound for broadcasts makes pairs of blocks far above it."""
    vocabulary = variants.staged(variants.words(small), "test-words")
    plans = []
    stage = variants.staged
    monkeypatch.setattr(variants, "staged", lambda df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())),
                                                              stage(df, name))[1])
    plans.append(("near", variants.near(vocabulary)._jdf.queryExecution().executedPlan().toString()))
    plans.append(("grouped", variants.grouped(small)._jdf.queryExecution().executedPlan().toString()))
    assert {"near", "grouped", "variant-forms", "variant-roots"} <= {n for n, _ in plans}
    for name, plan in plans:
        # the keys with several pieces are few: a piece is full of words
        assert name == "variant-blocks" or "Broadcast" not in plan, name
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 0
