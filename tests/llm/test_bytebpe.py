import hashlib
import random

import pytest
import tiktoken
from public_tokenizers import PATTERN

from clipmart.llm import bytebpe

PARTS = ["the", "tion", "ing", " ", "  ", "a", "b", "e", "\n", "\t", "é", "ü", "中", "文", "🙂", "'s", "'ll", "' ", "\x1c", "\x85",
         "\xa0", " ", "　", "0", "12", ".", "...", ",", "!", "\x00", "<|endoftext|>", "ß", "İ", "​", "1a", "_"]


@pytest.fixture(scope="module")
def codec():
    return bytebpe.Codec(bytebpe.ranks_path())


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bytebpe.read_ranks(bytebpe.ranks_path()), special_tokens={})


def texts():
    rng = random.Random(2)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(2000)]
    return [*out, "", " ", "a" * 3000, "ab" * 2000, " " * 2999, "=" * 1234, "the" * 900, "\n" * 300]


def test_ids_of_the_library_and_back(codec, library):
    given = texts()
    for t, ids in zip(given, codec.encode_all(given)):
        assert ids.tolist() == library.encode_ordinary(t)
        assert codec.decode(ids.tolist()) == t.encode()


def plain(codec, word):
    """Merges by definition: the leftmost pair of least rank, again and again."""
    parts = [bytes([b]) for b in word]
    while True:
        ranks = [(codec.ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        if not ranks or min(ranks)[0] == 1 << 40:
            return [codec.ranks[p] for p in parts]
        i = min(ranks)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_trees_merge_by_definition(codec):
    rng = random.Random(5)
    words = ["".join(rng.choice("aeinorst éß中") for _ in range(rng.randrange(1, 40))).encode() for _ in range(500)]
    for w, ids in zip(words, codec.merged(words, 128)):
        assert list(memoryview(ids).cast(codec.kind)) == plain(codec, w)


def test_every_code_point_is_cut_as_in_the_library(codec, library):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(chars), 20_000):
        t = "".join(f"a{c}1 {c}b" for c in chars[i:i + 20_000])
        assert codec.encode(t).tolist() == library.encode_ordinary(t)


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 20)
    monkeypatch.setattr(bytebpe, "NODES", 64)
    c = bytebpe.Codec(bytebpe.ranks_path())
    for t in texts()[:200]:
        assert c.encode(t).tolist() == library.encode_ordinary(t)
    assert len(c.segments) < 200


def test_rows(spark, edges, small, library):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for docs in (edges, small):
        given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        ids = {t: library.encode_ordinary(t or "") for _, t in given}
        want = sorted((str(d), len(ids[t]), sha(",".join(map(str, ids[t])).encode()), sha((t or "").encode())) for d, t in given)
        assert sorted((str(d), *r) for d, *r in bytebpe.digests(docs).collect()) == want
    enc = bytebpe.encode(small)
    assert sorted(bytes(b) for _, b in bytebpe.decode(enc).collect()) == sorted((r["text"] or "").encode() for r in small.collect())
    assert bytebpe.digests(small.limit(0)).collect() == []
