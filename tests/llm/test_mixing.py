from collections import defaultdict

import pytest

from clipmart.llm import mixing
from clipmart.llm.common import WORD


def targets(sizes):
    """By definition: share, cap, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, capped = 1.5 * sum(sizes.values()), {}
    while True:
        left = budget - sum(capped.values())
        free = [s for s in names if s not in capped]
        out = capped | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if out[s] > 2 * sizes[s]]
        if not over:
            return out
        capped |= {s: 2.0 * sizes[s] for s in over}


@pytest.mark.parametrize("block", [mixing.BLOCK, 16])
def test_against_definition(spark, small, edges, monkeypatch, block):
    import re

    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "BUCKET", 8)
    monkeypatch.setattr(mixing, "RUN", 16)
    for docs in (small, edges):
        want = sorted(((r["doc_id"] or 0), len(re.findall(WORD, r["text"] or "")), r["source"] or "")
                      for r in docs.select("doc_id", "text", "source").collect())
        rows, by, parts = mixing.mix(docs)
        got = mixing.taken(rows, by, parts).collect()
        assert sorted((r["doc_id"] or 0, r["size"], r["source"] or "") for r in got) == want
        sizes, took, target = defaultdict(int), defaultdict(int), {}
        for r in got:
            sizes[r["source"]] += r["size"]
            took[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
            assert 0 <= r["taken"] <= 2 * r["size"]
        assert all(r["source_size"] == sizes[r["source"]] for r in got)
        for s, t in targets(sizes).items():
            assert target[s] == pytest.approx(t)
            assert abs(took[s] - t) <= 1
        again = mixing.taken(*mixing.mix(docs.repartition(3))).collect()
        assert sorted((r["doc_id"] or 0, r["taken"]) for r in again) == sorted((r["doc_id"] or 0, r["taken"]) for r in got)
        # a slot takes words of one source only, and no part twice
        seen = parts.collect()
        assert len({(r["slot"], r["at"]) for r in seen}) == len(seen)
        assert all(len({r["s"] for r in seen if r["slot"] == k}) == 1 for k in {r["slot"] for r in seen})


def test_schedule_is_even(spark, small, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    sizes = mixing.measured(small).cache()
    by = mixing.sources(sizes).cache()
    slots = mixing.schedule(by, by.count()).collect()
    total = {r["s"]: r["slots"] for r in by.collect()}
    m = sum(total.values())
    assert sorted(r["slot"] for r in slots) == list(range(m))
    assert all(sorted(r["rank"] for r in slots if r["s"] == s) == list(range(n)) for s, n in total.items())
    # every stretch of the schedule holds each source near its share
    half = [r["s"] for r in slots if r["slot"] < m // 2]
    assert all(abs(half.count(s) - n / 2) <= 12 for s, n in total.items())


def test_empty(spark, small):
    assert mixing.taken(*mixing.mix(small.limit(0))).collect() == []
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in mixing.taken(*mixing.mix(nothing)).collect()] == [(0, 0.0)] * 2


def by_definition(rows, by, golden):
    """Slots one after the other, each taking the next block of its source,
    from the rows' places and the sources' words: start -> (taken, first slot, slots)."""
    of = {r["s"]: r for r in by}
    total = sum(r["slots"] for r in by)
    edges, ranks, plan = [], defaultdict(int), []
    for s in sorted(of):
        edges.append((of[s]["first"], of[s]["first"] + of[s]["slots"], s))
    over = []
    for slot in range(total):
        x = min(mixing.GOLDEN * slot % 1.0 * total if golden is None else golden * slot % 1.0 * total, total - 0.5)
        s = next(s for a, b, s in edges if a <= x < b)
        if ranks[s] < of[s]["slots"]:
            plan.append((slot, s, ranks[s]))
        else:
            over.append(slot)
        ranks[s] += 1
    short = [(s, r) for s in sorted(of) for r in range(min(ranks[s], of[s]["slots"]), of[s]["slots"])]
    plan += [(slot, s, r) for slot, (s, r) in zip(over, short)]
    out = defaultdict(lambda: [0, None, 0])
    for slot, s, rank in sorted(plan):
        one = of[s]
        around, block = divmod(rank, one["blocks"])
        left = one["words"] - around * one["source_size"] - block * mixing.BLOCK
        low, high = block * mixing.BLOCK, block * mixing.BLOCK + min(mixing.BLOCK, left)
        for r in rows:
            part = min(high, r["start"] + r["size"]) - max(low, r["start"])
            if r["s"] == s and part > 0:
                got = out[s, r["start"]]
                got[0] += part
                got[1] = slot if got[1] is None else got[1]
                got[2] += 1
    return {k: tuple(v) for k, v in out.items()}


def test_every_row_by_definition(small, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    few = small.where("doc_id < 60")
    found = {}
    for golden in (mixing.GOLDEN, 0.1234567):
        monkeypatch.setattr(mixing, "GOLDEN", golden)
        rows, by, parts = mixing.mix(few)
        got = mixing.taken(rows, by, parts).collect()
        want = by_definition(rows.collect(), by.collect(), golden)
        assert sorted((r["taken"], r["first_slot"], r["slots"]) for r in got if r["taken"]) == sorted(want.values())
        found[golden] = {(r["doc_id"], r["first_slot"]) for r in got}
        words = defaultdict(int)
        for p in mixing.passes(rows, by, parts).collect():
            assert 0 < p["words"] <= p["size"]
            words[p["doc_id"]] += p["words"]
        assert words == {r["doc_id"]: r["taken"] for r in got if r["taken"]}
    assert found[mixing.GOLDEN] != found[0.6180339887498949]  # the points decide where a document stands
