import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from clipmart.llm import bpe, tokenfile


def test_round_trip_of_ranks():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 8, 1000):
        ranks = (rng.integers(0, 2**32, n, np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = tokenfile.pack(ranks)
        assert len(control) == -(-n // 4)
        assert (tokenfile.unpack(control, data, n) == ranks).all()
    for edge in (0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1):
        assert tokenfile.unpack(*tokenfile.pack(np.array([edge], np.uint32)), 1).tolist() == [edge]
    with pytest.raises(ValueError):
        tokenfile.unpack(b"\x00", b"", 1)


def test_ids_of_the_library():
    import random

    rng = random.Random(4)
    parts = ["the", "tion", " ", "  ", "a", "\n", "\t", "é", "中", "🙂", "_", "...", ",", "0", "½", "\x1c", "\x85", "\xa0", "'s",
             "!", "\r", "\x00", "<|endoftext|>", " ", " \n"]
    library, e = Tokenizer.from_file(bpe.tokenizer_path()), bpe.Encoder(bpe.tokenizer_path())
    for _ in range(2000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        assert np.frombuffer(e.ids(t), e.kind).tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("file_tokens", [tokenfile.FILE_TOKENS, 700])
def test_files(spark, edges, small, monkeypatch, file_tokens):
    monkeypatch.setattr(tokenfile, "FILE_TOKENS", file_tokens)
    library = Tokenizer.from_file(bpe.tokenizer_path())
    for docs in (edges, small):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]
            want.append((r["doc_id"] is not None, r["doc_id"] or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        files, root = tokenfile.written(docs)
        assert file_tokens > 700 or files.count() > 1
        rows = sorted(tokenfile.read_files(files, root).collect(), key=lambda r: r["start"])
        got = [(r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in rows]
        assert sorted(got) == sorted(want)
        assert [g[:2] for g in got] == sorted(g[:2] for g in got)  # ascending, null first
        assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]


def test_ranked_by_frequency(spark, edges):
    files, root = tokenfile.written(edges)
    ranks = np.frombuffer(tokenfile.read_file(root, tokenfile.RANKS), "<u4")
    n = np.zeros(len(ranks), int)
    for f in files.collect():
        for _, ids in tokenfile.read_rows(root, f["file"]):
            n += np.bincount(ids, minlength=len(ranks))
    assert (np.diff(n[ranks]) <= 0).all() and sorted(ranks.tolist()) == list(range(len(ranks)))


def test_empty(small):
    assert tokenfile.read_files(*tokenfile.written(small.limit(0))).collect() == []


def texts(n, seed):
    import random

    rng = random.Random(seed)
    parts = ["the", "tion", " ", "a", "\n", "é", "中", "🙂", "_", ".", ",", "0", "½", "\xa0", "!", "\0", "<|endoftext|>", " the"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_texts_encoded_together():
    e, end = bpe.Encoder(bpe.tokenizer_path()), b"\0\0"
    for some in ([], [""], ["", "", " "], texts(3000, 5)):
        cuts = [c for c in map(e.cut, some) if c is not None]
        assert e.together(cuts, end).to_pylist() == [b"".join(e.known(c.split("\0"))) + end for c in cuts]
    assert e.together([e.cut("the tion"), e.cut("")]).to_pylist() == [e.ids("the tion"), b""]


def test_different_segments_looked_up_once():
    e, seen = bpe.Encoder(bpe.tokenizer_path()), []
    known, text = e.known, "the tion of the tion, the end.\nthe end."
    e.known = lambda parts: seen.append(list(parts)) or known(parts)
    got = e.together([e.cut(text)] * 500)
    assert len(seen) == 1 and sorted(seen[0]) == sorted(set(e.split(text)))
    assert got.to_pylist() == [e.ids(text)] * 500


def test_marks_follow_words_by_bytes():
    e = bpe.Encoder(bpe.tokenizer_path())
    for before, plain in (("a", True), ("0", True), ("_", False), ("é", True), ("½", True), ("٠", True), ("\x80", False), ("中", True),
                          ("🙂", False), (".", False), ("", False)):
        for mark in ".,":
            assert e.marks_follow_words(before + mark) is plain, before
            assert e.marks_follow_words("é." + before + mark + " a") is (plain and before != ""), before
    assert e.marks_follow_words("") and e.marks_follow_words("中 🙂")


def test_long_texts_and_small_groups(spark, edges, monkeypatch):
    """Texts encoded together, in groups and alone give the same ids."""
    odd = spark.createDataFrame(list(enumerate(texts(300, 6))), "doc_id long, text string")
    for docs in (edges, odd):
        monkeypatch.setattr(tokenfile, "TEXTS_CHARS", 4_000_000)
        want = sorted(map(str, tokenfile.encoded(docs).collect()))
        for most in (0, 25, 200):
            monkeypatch.setattr(tokenfile, "TEXTS_CHARS", most)
            assert sorted(map(str, tokenfile.encoded(docs).collect())) == want


def test_tasks_read_several_files(small, monkeypatch):
    monkeypatch.setattr(tokenfile, "FILE_TOKENS", 700)
    files, root = tokenfile.written(small)
    rows = tokenfile.read_files(files, root)
    assert rows.rdd.getNumPartitions() <= -(-files.count() // 4) < files.count()
    assert rows.count() == small.count()
