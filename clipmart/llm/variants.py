"""Spelling variant grouping by blocked Gram matrices.

Words are vectors of letter counts.  One replaced letter moves a word by a
squared distance of 2 (or 0, for which two letters must have changed), one
inserted or deleted letter by 1.  So near words stand in blocks of equal or
adjacent length, and inside these no further than 2 apart.  For two blocks one
NumPy matrix product gives all squared distances at once (|a|^2 + |b|^2 - 2ab);
what is at most 2 is kept, and its one edit is verified letter by letter.

A block is finer than a length: its key also holds how many letters of each of
``groups`` letter groups the word has.  The same bound holds for these sums, so
a block meets itself, the keys that one letter moved between two groups leads
to, and the keys with one letter more.  ``groups`` grows with the logarithm of
the number of words, and a key with more than PIECE words (fewer, if they are
long) is split into pieces, each met by its own task row: every pair of blocks
is a bounded product, and none is left out.  Pairs never leave a task; it
returns per word the number of near words and the best of them.

Forms: a word's near word of largest n, if that is at least ``ratio`` times the
word's own.  n grows by that factor along forms, so chains end; roots are found
by doubling over the words that have a form.

Defined cases: null texts have no words; a null id counts as an empty string
where a run is hashed; ties go to the smallest word in code-point order;
repeated rows count again; words of any length take part; other columns are
left behind, whatever their names; an empty table gives no words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart.llm.common import only, small_batches, staged
from clipmart.session import bounded_broadcast

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
#: One run in this many loses a code point.
DAMAGED = 97
#: Different words that a counting task holds before it hands them on.
HELD = 400_000
#: Words of a piece, and their code points.
PIECE, PIECE_CODES = 2048, 1 << 19


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_codes: int = 5, least_n: int = 3) -> DataFrame:
    """word, n (occurrences) of all words with at least ``least_codes`` code
    points and ``least_n`` occurrences.  Tasks count first, then counts are summed."""
    small_batches(docs.sparkSession)
    given = only(docs, doc_id=doc_id, text=text)
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def handed(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, int] = {}
        crc = zlib.crc32
        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not t:
                    continue
                start = crc(f"{'' if doc is None else doc}:".encode())
                for w, k in Counter(RUN.findall(t.lower() if t.isascii() else t.translate(LOWER))).items():
                    h = crc(w.encode(), start)
                    if not h % DAMAGED:
                        w = w[:(at := h % len(w))] + w[at + 1:]
                    if len(w) >= least_codes:
                        found[w] = found.get(w, 0) + k
                if len(found) > HELD:
                    yield handed(found)
                    found = {}
        if found:
            yield handed(found)

    return given.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def group_count(n_words: int) -> int:
    """Letter groups for a vocabulary: keys grow about as fast as words do."""
    return max(2, round(math.log2(max(n_words, 1)) / 3))


def key(groups: int):
    """Array column: code points in all, then those of each letter group (by
    the code point's remainder) but the last, which follows from the others."""
    codes = F.transform(F.split("word", ""), lambda c: F.ascii(c) % groups)
    in_group = lambda i: F.size(F.filter(codes, lambda g: g == i))
    return F.array(F.length("word"), *map(in_group, range(groups - 1)))


def moves(groups: int) -> list[list[int]]:
    """What to add to a block's key for the keys whose blocks it meets as the
    right side: itself, the smaller of those one letter moved away, and those
    of words with one letter less.  Each pair of keys comes up once."""
    unit = [[int(i == g) for i in range(groups - 1)] for g in range(groups)]  # the last group has no place
    out = [[0] * groups]
    for a in range(groups):
        out.append([-1, *(-x for x in unit[a])])
        for b in range(groups):
            moved = [y - x for x, y in zip(unit[a], unit[b])]
            if moved < [0] * (groups - 1):
                out.append([0, *moved])
    return out


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def counts_of(codes: np.ndarray, letters: np.ndarray, kind) -> np.ndarray:
    at = np.searchsorted(letters, codes)
    flat = at + np.arange(len(codes))[:, None] * len(letters)
    return np.bincount(flat.ravel(), minlength=len(codes) * len(letters)).reshape(len(codes), -1).astype(kind)


def near_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``left`` and of ``right`` (as long, or longer by one) that are one edit apart."""
    letters = np.union1d(left, right)
    kind = np.float32 if right.shape[1] <= 2000 else np.float64  # exact either way
    a, b = counts_of(left, letters, kind), counts_of(right, letters, kind)
    one = lambda m: np.ones((len(m), 1), kind)
    half = lambda m: -(m * m).sum(1, keepdims=True) / 2
    # the product is minus half the squared distance
    gram = np.hstack([a, half(a), one(a)]) @ np.hstack([b, one(b), half(b)]).T
    i, j = np.nonzero(gram >= -1)
    kept = np.zeros(len(i), bool)
    step = max(1, PIECE_CODES // right.shape[1])
    for s in range(0, len(i), step):
        x, y = left[i[s:s + step]], right[j[s:s + step]]
        m = x.shape[1]
        if m == y.shape[1]:
            kept[s:s + step] = (x != y).sum(1) == 1
        else:
            lead = np.cumprod(x == y[:, :m], 1).sum(1)
            tail = np.cumprod((x == y[:, 1:])[:, ::-1], 1).sum(1)
            kept[s:s + step] = lead + tail >= m
    return i[kept], j[kept]


def partial(left: tuple[list[str], list[int]], right: tuple[list[str], list[int]], same: bool, to: dict) -> None:
    """Add the near words of two blocks, each by falling n and then by word,
    to ``to``: word -> [near words, n of the best, the best]."""
    i, j = near_pairs(codes_of(left[0]), codes_of(right[0]))
    if same:  # the block with itself gives every pair twice, so either side sees all of its own
        sides = [(i, j, left, right)]
    else:
        back = np.lexsort((i, j))
        sides = [(i, j, left, right), (j[back], i[back], right, left)]
    for own, other, of, best in sides:
        rows, first, n_near = np.unique(own, return_index=True, return_counts=True)
        for r, at, k in zip(rows.tolist(), other[first].tolist(), n_near.tolist()):
            w, n, o = of[0][r], best[1][at], best[0][at]
            got = to.get(w)
            if got is None:
                to[w] = [k, n, o]
            else:
                got[0] += k
                if n > got[1] or n == got[1] and o < got[2]:
                    got[1:] = n, o


def near(vocabulary: DataFrame) -> DataFrame:
    """word, n_near, best (struct of minus n, and word) of all words of
    ``vocabulary`` (word, n; stored) that have a near word."""
    groups = group_count(vocabulary.count())
    keyed = vocabulary.select("word", "n", key(groups).alias("key"))
    room = F.greatest(F.lit(1), F.least(F.lit(PIECE), F.lit(PIECE_CODES) / F.col("key")[0]))
    pieces = staged(keyed.groupBy("key").agg(F.count("*").alias("words")).select(
        "key", F.ceil(F.col("words") / room).cast("int").alias("pieces")), "variant-keys")
    # pieces by hash: about as large as room allows; few keys can have several
    split = bounded_broadcast(pieces.where("pieces > 1"))
    piece = F.pmod(F.xxhash64("word"), F.coalesce("pieces", F.lit(1))).cast("int")
    packed = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "word")))
    blocks = staged(keyed.join(split, "key", "left").groupBy("key", piece.alias("piece")).agg(packed.alias("words")), "variant-blocks")
    moved = F.array(*(F.zip_with("key", F.array(*map(F.lit, m)), lambda x, y: x + y) for m in moves(groups)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # merged, not broadcast, here and below: Spark sizes what explode makes as what went in, and lists as one element
    met = (pieces.select(F.col("key").alias("own"), F.col("pieces").alias("own_pieces"), F.explode(moved).alias("key"))
           .join(pieces.hint("merge"), "key").withColumn("own_piece", each("own_pieces")).withColumn("piece", each("pieces"))
           # of two pieces of one key the larger is the right side
           .where((F.col("own") != F.col("key")) | (F.col("own_piece") >= F.col("piece"))))
    # words come last: keys that no word has carry none
    rights = blocks.select(F.col("key").alias("own"), F.col("piece").alias("own_piece"), F.col("words").alias("right"))
    met = met.select("own", "own_piece", "key", "piece").join(rights.hint("merge"), ["own", "own_piece"])
    # the products are the work, and shuffled rows spread it
    pairs = blocks.join(met.hint("merge"), ["key", "piece"]).select(
        F.col("words").alias("left"), "right",
        ((F.col("own") == F.col("key")) & (F.col("own_piece") == F.col("piece"))).alias("same"))
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
                           T.StructField("m", T.LongType()), T.StructField("form", T.StringType())])

    def lists(column: pa.ListArray, row: int) -> tuple[list[str], list[int]]:
        some = column[row].values
        return some.field("word").to_pylist(), [-m for m in some.field("m").to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {}
        for b in batches:
            for row in range(b.num_rows):
                partial(lists(b.column(0), row), lists(b.column(1), row), b.column(2)[row].as_py(), found)
            if len(found) > HELD:
                yield handed(found)
                found = {}
        if found:
            yield handed(found)

    def handed(found: dict) -> pa.RecordBatch:
        n_near, n, form = zip(*found.values())
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(n_near, pa.int64()),
                                           pa.array([-x for x in n], pa.int64()), pa.array(form, pa.string())],
                                          [f.name for f in schema])

    return pairs.mapInArrow(run, schema).groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("m", "form")).alias("best"))


def rooted(forms: DataFrame) -> DataFrame:
    """word, root of all rows of ``forms`` (word, form; stored): the last form
    of each chain.  Every round doubles the steps that a pointer covers."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = staged(at.join(ahead.hint("merge"), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        at = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return at


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_codes: int = 5, least_n: int = 3,
            ratio: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word."""
    vocabulary = staged(words(docs, doc_id, text, least_codes, least_n), "variant-words")
    fits = -F.col("best.m") >= ratio * F.col("n")
    table = staged(vocabulary.join(near(vocabulary).hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")), "variant-forms")
    roots = rooted(table.where("form IS NOT NULL"))
    return table.join(roots.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                    "n", "n_near", "form_n")
