import random

import pytest

from clipmart.llm import bpe, editcount

PARTS = ["the", "tion", " ", "  ", "a", "\n", "\t", "é", "中", "🙂", "_", "...", ",", ".", "0", "½", "\xa0", "'s", "'", "!", "\r", "\x00"]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.tokenizer_path())


def tokens(encoder, text):
    return len(encoder.ids(text)) // encoder.kind.itemsize


def test_edits_against_counting_anew(encoder):
    rng = random.Random(5)
    some = lambda n: "".join(rng.choice(PARTS) for _ in range(n))
    for size in [0, 1, 2, 5] * 30 + [3000, 5000]:
        tree = editcount.TokenTree(some(size), encoder)
        assert tree.tokens == tokens(encoder, tree.text)
        for _ in range(20 if size > 5 else 6):
            at = rng.randrange(len(tree.text) + 1)
            before = tree.text
            end, new = at + rng.choice([0, 1, 5, 400]), some(rng.choice([0, 1, 3, 300]))
            tree.edit(at, end, new)
            assert tree.text == before[:at] + new + before[end:]
            assert tree.tokens == tokens(encoder, tree.text)
            assert sum(sum(c) for c, _ in tree.leaves) == len(tree.text)
            for below, above in zip(tree.levels, tree.levels[1:]):
                pairs = zip(below[::2], [*below[1::2], (0, 0)])
                assert above == [(a[0] + b[0], a[1] + b[1]) for a, b in pairs]


def test_reencodes_the_region_only(encoder):
    tree = editcount.TokenTree("word " * 20000, encoder)
    tree.edit(50_000, 50_004, "other")
    assert 0 < tree.encoded <= 5
    tree.edit(0, 0, "x")
    assert tree.encoded <= 10


def test_clean_up():
    text = "same line\nme@mail.example.com and 10.2.33.4\nsame line\n+1 (477) 555-4197\nsame line"
    out = text
    for a, b, new in sorted(editcount.clean_up(text), reverse=True):
        out = out[:a] + new + out[b:]
    assert out == "same line\n<email> and <address>\n<phone>"
    assert editcount.clean_up("a@b.co\na@b.co") == [(0, 6, "<email>"), (6, 13, "")]


def test_rows(spark, edges, small, encoder):
    for docs in (edges, small):
        rows = sorted(editcount.edited_counts(docs).collect(), key=lambda r: (r["doc_id"] or 0, r["n_tokens"] or 0))
        given = docs.select("doc_id", "text").collect()
        want = []
        for r in given:
            if r["text"] is None:
                want.append((r["doc_id"] or 0, None, None))
                continue
            out = r["text"]
            for a, b, new in sorted(editcount.clean_up(out), reverse=True):
                out = out[:a] + new + out[b:]
            want.append((r["doc_id"] or 0, tokens(encoder, r["text"]), tokens(encoder, out)))
        want.sort(key=lambda w: (w[0], w[1] or 0))
        assert [(r["doc_id"] or 0, r["n_tokens"], r["n_tokens_edited"]) for r in rows] == want
        assert all(r["n_reencoded"] <= (r["n_segments"] or 0) + 5 * r["n_edits"] for r in rows if r["n_edits"] is not None)
    assert editcount.edited_counts(small.limit(0)).collect() == []
