import re

import pytest
import xxhash
from pyspark.sql import functions as F

from clipmart.llm import simhash


def by_definition(text, shingle=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return simhash.signed(bits)


def components(rows, max_bits=2):
    """(id, fingerprint) -> the smallest id that each row reaches."""
    fps = sorted({fp for _, fp in rows})
    forest = simhash.Forest(len(fps))
    for i, a in enumerate(fps):
        for j in range(i):
            if ((a ^ fps[j]) % 2**64).bit_count() <= max_bits:
                forest.join(i, j)
    root = {fp: forest.root(i) for i, fp in enumerate(fps)}
    least = {}
    for k, fp in rows:
        if k is not None:
            least[root[fp]] = min(k, least.get(root[fp], k))
    return sorted((k is None, k or 0, fp, least.get(root[fp])) for k, fp in rows)


def result(found):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"], r["component_id"]) for r in found.collect())


def test_fingerprints(spark, edges, small):
    for docs in (edges, small.limit(60)):
        rows = docs.select("doc_id", "text").collect()
        want = sorted((r["doc_id"] or 0, by_definition(r["text"])) for r in rows)
        assert sorted((r["doc_id"] or 0, r["fp"]) for r in simhash.fingerprints(docs).collect()) == want


def test_same_hash_as_spark(spark):
    got = spark.sql("SELECT xxhash64('one two three') AS h").head()["h"]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"one two three", seed=42)


def test_edges(spark, edges, small):
    found = simhash.near_duplicates(edges)
    rows = [(r["doc_id"], r["fp"]) for r in simhash.fingerprints(edges).collect()]
    assert result(found) == components(rows)
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[1]["fp"] == by[2]["fp"] == 0 and by[2]["component_id"] == 1
    assert by[6]["component_id"] == 5 and by[None]["component_id"] == 8
    assert simhash.near_duplicates(small.limit(0)).collect() == []


@pytest.mark.parametrize("large", [simhash.LARGE, 3])
def test_chains_against_brute_force(spark, monkeypatch, large):
    import random

    rng = random.Random(large)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(300):  # walk away from random ones, one to four bits at a time
        x = rng.choice(fps)
        for _ in range(rng.randint(1, 4)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    rows = [(i, simhash.signed(x)) for i, x in enumerate(fps)] + [(1000, simhash.signed(fps[0])), (None, simhash.signed(fps[1]))]
    given = spark.createDataFrame(rows, "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a, **k: given)
    assert result(simhash.near_duplicates(given, large=large)) == components(rows)


def test_discarded_pairs_are_never_links():
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 2000, np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 2000).astype(np.uint64))
    d = np.abs(simhash.distances(x, simhash.pivots()) - simhash.distances(y, simhash.pivots()))
    assert d.max() <= 2


def test_linked_pairs_share_a_key(spark):
    a = 0x0123456789ABCDEF
    rows = [(simhash.signed(a),)] + [(simhash.signed(a ^ 1 << i ^ 1 << j),) for i in range(0, 64, 7) for j in range(i)]
    table = simhash.pivot_table(spark.createDataFrame(rows, "fp long"))
    k = simhash.keys(table)
    mine = k.where(F.col("fp") == rows[0][0]).select("key").distinct()
    assert k.join(mine, "key").select("fp").distinct().count() == len(set(rows))
