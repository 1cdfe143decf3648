"""Token counts that follow edits.

A document is kept as segments: runs of pre-tokens between two places where
the pre-tokenizer always has a boundary, which the two characters there tell.  A segment tree over them holds characters and tokens of
every subtree.  An edit finds its segments from the root, takes in the
segments next to it whose boundary it could change, re-encodes that stretch
only and updates the sums on its paths to the root.

Defined cases: a null text has null counts, an empty one no tokens; edits are
(start, end, replacement) in characters of the text before any of them, must
not overlap, and are cut to the text; none leave the count as it is.  Texts of any length are
counted whole; repeated rows get equal counts.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipmart.llm import bpe
from clipmart.llm.common import only, small_batches

LEAF = 32  # segments of a leaf when the tree is built; at twice as many it is split

Edit = tuple[int, int, str]

PERSONAL = [
    ("@", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "<email>"),
    (".", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])"), "<address>"),
    ("-", re.compile(r"(?:\+\d{1,2} )?\(\d{3}\) \d{3}-\d{4}"), "<phone>"),
]


def clean_up(text: str) -> list[Edit]:
    """The edits of a usual cleaning step: personal data are replaced by marks
    and lines equal to an earlier one (with a letter) are removed."""
    edits, seen, at = [], set(), 0
    for line in text.split("\n"):
        if line in seen:
            edits.append((at - 1, at + len(line), ""))  # with the line break before it
        elif line.strip():
            seen.add(line)
        at += len(line) + 1
    gone = [(a, b) for a, b, _ in edits]
    for sign, pattern, mark in PERSONAL:
        if sign in text:
            for m in pattern.finditer(text):
                k = bisect_right(gone, (m.end(), -1))
                if not any(a < m.end() and m.start() < b for a, b in gone[max(k - 1, 0):k + 1]):
                    edits.append((*m.span(), mark))
                    gone = sorted([*gone, m.span()])
    return sorted(edits)


class TokenTree:
    """The segments of one document under a tree of their sums."""

    def __init__(self, text: str, encoder: bpe.Encoder):
        self.text, self.encoder, self.encoded = text, encoder, 0
        chars, tokens = self.segments(text)
        self.leaves = [[chars[i:i + LEAF], tokens[i:i + LEAF]] for i in range(0, len(chars), LEAF)] or [[[], []]]
        self.grow()
        self.encoded = 0

    def segments(self, text: str) -> tuple[list[int], list[int]]:
        """Characters and tokens of the segments of a stretch."""
        if not text:
            return [], []
        parts, ids = self.encoder.encode(text)
        self.encoded += len(parts)
        width = self.encoder.kind.itemsize
        pairs = [(len(p), len(i) // width) for p, i in zip(parts, ids) if p]
        return [c for c, _ in pairs], [t for _, t in pairs]

    def grow(self) -> None:
        """The levels over the leaves: sums of two nodes below, up to the root."""
        level = [(sum(c), sum(t)) for c, t in self.leaves]
        self.levels = [level]
        while len(level) > 1:
            level = [(a[0] + b[0], a[1] + b[1]) for a, b in
                     zip(level[::2], [*level[1::2], *[(0, 0)] * (len(level) % 2)])]
            self.levels.append(level)

    def update(self, leaf: int) -> None:
        """Renew the sums on the path from a leaf to the root."""
        chars, tokens = self.leaves[leaf]
        self.levels[0][leaf] = (sum(chars), sum(tokens))
        for below, above in zip(self.levels, self.levels[1:]):
            leaf //= 2
            a, b = below[2 * leaf], below[2 * leaf + 1] if 2 * leaf + 1 < len(below) else (0, 0)
            above[leaf] = (a[0] + b[0], a[1] + b[1])

    @property
    def tokens(self) -> int:
        return self.levels[-1][0][1]

    def find(self, at: int) -> tuple[int, int, int]:
        """(leaf, segment in it, first character) of the segment with a character."""
        node, start = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            if at >= start + level[node][0] and node + 1 < len(level):
                start += level[node][0]
                node += 1
        for k, c in enumerate(self.leaves[node][0]):
            if at < start + c:
                return node, k, start
            start += c
        raise IndexError(at)

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace the characters from start to end."""
        size = len(self.text)
        start, end = max(0, min(start, size)), max(0, min(end, size))
        if start > end:
            raise ValueError("an edit ends before it starts")
        text = self.text[:start] + replacement + self.text[end:]
        if not size:
            self.__init__(text, self.encoder)
            self.encoded = sum(len(c) for c, _ in self.leaves)
            return
        # a boundary stays where it is only if the characters on both its sides do
        a, i, low = self.find(max(start - 1, 0))
        b, j, at = self.find(min(end, size - 1))
        high = at + self.leaves[b][0][j]
        chars, tokens = self.segments(text[low:high + len(text) - size])
        first, last = self.leaves[a], self.leaves[b]
        new = [first[0][:i] + chars + last[0][j + 1:], first[1][:i] + tokens + last[1][j + 1:]]
        self.text = text
        if a == b and len(new[0]) <= 2 * LEAF:
            self.leaves[a] = new
            self.update(a)
            return
        parts = [[new[0][k:k + LEAF], new[1][k:k + LEAF]] for k in range(0, len(new[0]), LEAF)]
        if len(parts) <= b - a + 1:  # the tree keeps its shape
            for k, leaf in enumerate([*parts, *([[], []] for _ in range(b - a + 1 - len(parts)))]):
                self.leaves[a + k] = leaf
                self.update(a + k)
        else:
            self.leaves[a:b + 1] = parts
            self.grow()


def edited_counts(docs: DataFrame, edits: Callable[[str], list[Edit]] = clean_up, doc_id: str = "doc_id",
                  text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, n_edits, n_tokens_edited, n_segments and
    n_reencoded (segments encoded again because of the edits)."""
    path = tokenizer or bpe.tokenizer_path()
    small_batches(docs.sparkSession)
    given = only(docs, doc_id=doc_id, text=text)
    names = ["n_tokens", "n_edits", "n_tokens_edited", "n_segments", "n_reencoded"]
    schema = T.StructType([given.schema["doc_id"], *(T.StructField(n, T.LongType()) for n in names)])

    def one(t: str | None, encoder: bpe.Encoder) -> tuple:
        if t is None:
            return (None,) * len(names)
        tree = TokenTree(t, encoder)
        before, segments = tree.tokens, sum(len(c) for c, _ in tree.leaves)
        todo = edits(t)
        for e in sorted(todo, reverse=True):  # from the end, so that offsets stay right
            tree.edit(*e)
        return before, len(todo), tree.tokens, segments, tree.encoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.worker_encoder(path)
        for b in batches:
            for i in range(0, b.num_rows, 1000):
                part = b.slice(i, 1000)
                rows = [one(t, encoder) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(len(names)))],
                    ["doc_id", *names])

    return given.mapInArrow(run, schema)
