import random

import pytest
import sentencepiece

from clipmart.llm import spm

PARTS = ["the", "tion", "ing", " ", "  ", "a", "b", "e", "r", "s", "t", "\n", "\t", "é", "ü", "中", "文", "🙂", "_", "__",
         "::", "//", "http://", "www.", ".", "...", ",", "0", "12", "xxxxx", "==", " ", "\x00", "--", "A", "ST", ")", "();"]


@pytest.fixture(scope="module")
def model():
    return spm.Model(spm.model_path())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=spm.model_path())


def texts():
    rng = random.Random(2)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(2000)]
    return [*out, "", " ", "a" * 3000, "ab" * 2000, " " * 2999, "=" * 1234, "the" * 900, "\n" * 300]


def test_ids_of_the_library_and_back(model, library):
    for t in texts():
        ids = model.encode(t).tolist()
        assert ids == library.encode(t)
        assert model.decode(ids) == t


def test_commits_within_the_window(model, library, small):
    """Whole documents in one search: ids are committed as it goes, and never
    more than a few longest pieces are held."""
    docs = [r["text"] for r in small.select("text").collect() if r["text"]]
    model.commits = model.held = 0
    runs = 0
    for t in [*docs, "information" * 40, "=" * 500]:
        found = list(model.search(model.prefix + t.replace(" ", spm.SPACE)))
        assert [i for run in found for i in run] == library.encode(t)
        runs += len(found) - 1
    assert runs >= model.commits > sum(map(len, docs)) / (4 * model.longest)
    assert 2 * model.longest <= model.held <= 6 * model.longest


def test_every_stretch_goes_through_the_search(small, monkeypatch):
    m = spm.Model(spm.model_path())
    searched = []
    search = m.search
    monkeypatch.setattr(m, "search", lambda t, nodes: searched.append(t) or search(t, nodes))
    docs = [r["text"] for r in small.select("text").collect() if r["text"]]
    m.encode_all(docs)
    stretches = {u for t in docs for u in m.split(m.prefix + t.replace(" ", spm.SPACE))}
    assert sorted(searched) == sorted(stretches)


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(spm, "REMEMBERED", 20)
    m = spm.Model(spm.model_path())
    for t in texts()[:200]:
        assert m.encode(t).tolist() == library.encode(t)
    assert len(m.units) < 200


def test_rows(spark, edges, small, library):
    for docs in (edges, small):
        want = {(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()}
        rows = spm.encode(docs, verify=True).collect()
        assert len(rows) == docs.count()
        given = {(k, None if t is None else tuple(library.encode(t))) for k, t in want}
        assert {(r["doc_id"], None if r["ids"] is None else tuple(r["ids"])) for r in rows} == given
        assert all(r["lossless"] or r["doc_id"] == 9 for r in rows if r["ids"] is not None)  # 9 holds U+2581
    back = spm.decode(spm.encode(small)).collect()
    assert {(r["doc_id"], r["text"]) for r in back} == want
    assert spm.encode(small.limit(0)).collect() == []
