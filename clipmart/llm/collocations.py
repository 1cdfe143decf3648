"""Phrase collocations from count streams in prefix and suffix order.

Counting takes three passes over the whole corpus: words, pairs of words, and
all longer phrases.  A phrase can only be frequent where the shorter phrases
inside it are, so a pass counts the places that a bitmap of the frequent phrases
of the pass before lets through.  The bitmap has a fixed size and only ever
lets more through; counts are exact.  Tasks combine equal phrases before they
are shuffled.

The streams are external: all frequent phrases of all orders, per language, are
sorted by their words (prefix order), so a phrase stands behind the phrases that
lead it and before those that extend it.  One walk over that order, holding only
the phrases that the current one begins with, reads off the counts of all first
parts and whether an extension to the right occurs as often.  The second walk
does the same over the words reversed (suffix order), for last parts and
extensions to the left.  No count is looked up in a hash table: the orders are
merged in lockstep.  The empty phrase, with the number of all words, leads a
language.

Streams are cut into slices of about SLICE rows at sampled boundaries.  The few
phrases that a boundary begins with (at most ``longest`` a slice) are carried
into its slice, so no slice depends on another, whatever the skew.

It suffices to look at extensions by one word: a longer phrase that occurs as
often as a phrase inside it leaves every phrase between them as frequent.

Defined cases: null texts are empty; a null language counts as ``und``; a text
may be of any length, as may a word; ties go by the contract's order; repeated
rows count again; other columns are left behind, whatever their names; an empty
table gives no phrases.  Ids take no part.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart.llm.common import only, small_batches, staged

#: Where pieces end, and what separates words within one.
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b"\t "
CAPITALS = bytes(range(65, 91))
PLAIN = bytes.maketrans(CAPITALS + BREAKS + SPACES, CAPITALS.lower() + b"." * len(BREAKS) + b" " * len(SPACES))
#: Bits of the bitmap, as a power of two (2**26 bits are 8 MB).
BITS = 26
#: Bytes of text that are looked at together; words and cells of phrases that a task holds before it hands counts on.
CHUNK, WORDS, CELLS = 1 << 22, 400_000, 1 << 22
#: Rows of a slice, and boundary candidates drawn for each.
SLICE, DRAWN = 100_000, 20
ODD = np.uint64(0x9E3779B97F4A7C15)

COUNTED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()),
                        T.StructField("f", T.LongType())])


def pieces(texts: list[bytes]) -> list[bytes]:
    """The words of some texts, with a full stop wherever a piece or text ends."""
    return b".".join(texts).translate(PLAIN).replace(b".", b" . ").split()


class Ids(dict):
    """Words and their numbers; the full stop is 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def places(word_hash: np.ndarray, lang: str, order: int) -> np.ndarray:
    """The bit of the phrase of ``order`` words that starts at each word."""
    one = word_hash + word_hashes([lang.encode()])[0]
    h = one[:len(one) - order + 1]
    for k in range(1, order):
        h = (h ^ (h >> np.uint64(29))) * ODD + one[k:len(one) - order + 1 + k]
    return (((h ^ (h >> np.uint64(32))) * ODD) >> np.uint64(64 - BITS)).astype(np.int64)


def equal_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows and how often each is there."""
    if rows.shape[1] <= 2:  # a row is one number: sorted without its place
        code, n = np.unique(rows[:, 0].astype(np.int64) << 32 | rows[:, -1], return_counts=True)
        return np.stack([code >> 32, code & 0xFFFFFFFF], 1)[:, :rows.shape[1]], n
    code = rows[:, 0].astype(np.int64)
    for c in range(1, rows.shape[1]):
        code = (np.unique(code, return_inverse=True)[1] if c > 1 else code) << 32 | rows[:, c]
    _, first, n = np.unique(code, return_index=True, return_counts=True)
    return rows[first], n


class Counter:
    """Counts of phrases of some orders (one word, or those above ``known``, of
    which ``bitmap`` holds the frequent phrases) in one task."""

    def __init__(self, orders: list[int], known: int, bitmap: np.ndarray | None):
        self.orders, self.known, self.bitmap = orders, known, bitmap
        self.start()

    def start(self) -> None:
        self.ids, self.hashes, self.cells = Ids(), np.empty(0, np.uint64), 0
        self.found: dict[tuple[str, int], list[np.ndarray]] = {}

    def add(self, lang: str, texts: list[bytes]) -> None:
        words = pieces(texts)
        at = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
        if not self.known:
            self.keep(lang, at[at > 0][:, None])
            return
        if len(self.hashes) < len(self.ids):  # dicts keep their order
            self.hashes = np.concatenate([self.hashes, word_hashes(list(self.ids)[len(self.hashes):])])
        if len(at) < self.known:
            return
        bit = places(self.hashes[at], lang, self.known)
        go = (self.bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
        for k in range(self.known):
            go &= at[k:len(go) + k] > 0
        runs = go  # phrases of ``order`` words, all of whose parts of ``known`` words are let through
        for order in range(self.known + 1, self.orders[-1] + 1):
            runs = runs[:-1] & go[order - self.known:]
            if order in self.orders:
                self.keep(lang, at[np.flatnonzero(runs)[:, None] + np.arange(order)])

    def keep(self, lang: str, rows: np.ndarray) -> None:
        if len(rows):
            self.found.setdefault((lang, rows.shape[1]), []).append(rows)
            self.cells += rows.size

    def full(self) -> bool:
        return self.cells > CELLS or len(self.ids) > WORDS

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        words = pa.array(list(self.ids), pa.binary())
        for (lang, order), parts in self.found.items():
            rows, n = equal_rows(np.concatenate(parts))
            for i in range(0, len(rows), 1 << 16):
                some = rows[i:i + (1 << 16)]
                text = pc.binary_join_element_wise(*(words.take(pa.array(some[:, c])) for c in range(order)), pa.scalar(b" ", pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), text.cast(pa.string()),
                                                  pa.array(n[i:i + (1 << 16)], pa.int64())], COUNTED.names)
        self.start()


def counted(docs: DataFrame, orders: list[int], known: int = 0, bitmap: bytes | None = None) -> DataFrame:
    """lang, phrase (words and single spaces), f of all phrases of ``orders``
    words all of whose parts of ``known`` words are in ``bitmap``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Counter(orders, known, None if bitmap is None else np.frombuffer(bitmap, np.uint8))
        for b in batches:
            texts, langs = b.column(1).cast(pa.binary()).to_pylist(), b.column(0).to_pylist()
            groups: dict[str, list[bytes]] = {}
            size: dict[str, int] = {}
            for lang, t in zip(langs, texts):
                groups.setdefault(lang, []).append(t)
                size[lang] = size.get(lang, 0) + len(t)
                if size[lang] > CHUNK:
                    c.add(lang, groups.pop(lang))
                    size[lang] = 0
                    if c.full():
                        yield from c.hand_on()
            for lang, some in groups.items():
                c.add(lang, some)
            if c.full():
                yield from c.hand_on()
        yield from c.hand_on()

    return docs.mapInArrow(run, COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def bitmap_of(frequent: DataFrame, order: int) -> bytes:
    """A bit for each phrase: at most 2**BITS bits, however many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, phrase in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out.append(int(places(word_hashes(phrase.encode().split(b" ")), lang, order)[0]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["bit"])

    bits = frequent.select("lang", "phrase").mapInArrow(run, "bit long").select((F.col("bit") + 1).alias("bit"))
    rows = bits.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()
    out = np.zeros(1 << BITS >> 3, np.uint8)
    for r in rows:
        some = np.frombuffer(r["bits"], np.uint8)
        start = (r["bucket"] - 1) * len(some)
        out[start:start + len(some)] = some[:len(out) - start]
    return out.tobytes()


def streams(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5) -> DataFrame:
    """lang, words (array), f of every phrase of up to ``longest`` words with
    at least ``least`` occurrences, and of the empty phrase: all words."""
    small_batches(docs.sparkSession)
    given = only(docs, lang=lang, text=text).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = staged(counted(given, [1]), "collocation-words")
    out = every.groupBy("lang").agg(F.sum("f").alias("f")).select("lang", F.array().cast("array<string>").alias("words"), "f")
    frequent = every.where(F.col("f") >= least)
    for known, orders in enumerate(([1], [2], list(range(3, longest + 1)))):
        if known:
            if not orders or frequent.isEmpty():
                break
            frequent = staged(counted(given, orders, known, bitmap_of(frequent, known)).where(F.col("f") >= least),
                              "collocation-phrases")
        out = out.unionByName(frequent.select("lang", F.split("phrase", " ").alias("words"), "f"))
    return staged(out, "collocation-stream")


WALKED = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("f", T.LongType()),
    T.StructField("parts", T.ArrayType(T.LongType())), T.StructField("before", T.ArrayType(T.LongType())),
    T.StructField("extended", T.BooleanType()), T.StructField("carried", T.BooleanType())])
DEALT = T.StructType([*WALKED.fields[:3], T.StructField("before", T.ArrayType(T.LongType())),
                      T.StructField("extended", T.BooleanType()), T.StructField("carried", T.BooleanType()),
                      T.StructField("slice", T.IntegerType())])


def boundaries(stream: DataFrame) -> list[tuple]:
    """(lang, words) at which slices begin, ascending; the first has none.  The
    driver gets about DRAWN rows a slice."""
    rows = stream.count()
    slices = -(-rows // SLICE)
    if slices < 2:
        return []
    per = max(1, SLICE // DRAWN)
    drawn = sorted((r["lang"], tuple(r["words"])) for r in
                   stream.where(F.pmod(F.xxhash64("lang", "words"), F.lit(per)) == 0).select("lang", "words").collect())
    return sorted({drawn[len(drawn) * i // slices] for i in range(1, slices)}) if drawn else []


def dealt(stream: DataFrame, starts: list[tuple]) -> DataFrame:
    """The rows with their slice, and copies of what leads a slice's first row."""
    ahead: dict[tuple, list[int]] = {}
    for s, (lang, words) in enumerate(starts, 1):
        for k in range(len(words)):
            ahead.setdefault((lang, words[:k]), []).append(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, words, f, before, extended in zip(*(c.to_pylist() for c in b.columns)):
                at = (lang, tuple(words))
                out.append((lang, words, f, before, extended, False, bisect_right(starts, at)))
                out += [(lang, words, f, None, False, True, s) for s in ahead.get(at, ())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 7, DEALT_ARROW)], DEALT.names)

    return stream.select("lang", "words", "f", "before", "extended").mapInArrow(run, DEALT)


DEALT_ARROW = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.int32()]
WALKED_ARROW = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.bool_(), pa.bool_()]


def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: each with the counts of the phrases it begins with, and
    whether a phrase one word longer that begins with it occurs as often."""
    stack: list[list] = []  # what the current row begins with: lang, words, f, before, extended, carried, slice
    out: list[tuple] = []

    def closed() -> None:
        lang, words, f, before, extended, carried, _ = stack.pop()
        if not carried or extended:
            out.append((lang, words, f, [s[2] for s in stack], before, extended, carried))

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), WALKED_ARROW)], WALKED.names)

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            row = list(row)
            while stack and not (stack[-1][6] == row[6] and stack[-1][0] == row[0] and stack[-1][1] == row[1][:len(stack[-1][1])]):
                closed()
            if stack and len(stack[-1][1]) + 1 == len(row[1]) and stack[-1][2] == row[2]:
                stack[-1][4] = True
            stack.append(row)
        if len(out) > 10_000:
            yield batch()
            out.clear()
    while stack:
        closed()
    if out:
        yield batch()


def lockstep(stream: DataFrame) -> DataFrame:
    """``stream`` (lang, words, f, before, extended; stored) with ``parts``:
    the counts of the phrases of 0, 1, ... words that a phrase begins with.
    ``extended`` stays true, or becomes so."""
    starts = boundaries(stream)
    order = dealt(stream, starts).repartition(len(starts) + 1, "slice").sortWithinPartitions("slice", "lang", "words")
    walked = staged(order.select(*DEALT.names).mapInArrow(walk, WALKED), "collocation-walk")
    # at most as many rows as boundaries lead to: their extensions stand in later slices
    late = walked.where("carried").select("lang", "words").distinct().withColumn("late", F.lit(True))
    return walked.where("NOT carried").join(F.broadcast(late), ["lang", "words"], "left").withColumn(
        "extended", F.col("extended") | F.col("late").isNotNull()).drop("late", "carried")


def scored(rows: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of phrases with the counts of their
    first (``before``) and last parts (``parts``)."""
    schema = T.StructType([*COUNTED.fields[:2], *(T.StructField(c, T.LongType()) for c in ("a", "l", "r", "n", "score"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lang, words, a, first, last in zip(*(c.to_pylist() for c in b.columns)):
                m, n = len(words), first[0]
                score, k = min((1000 * a * n // (first[k] * last[m - k]), k) for k in range(1, m))
                out.append((lang, " ".join(words), a, first[k], last[m - k], n, score))
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i < 2 else pa.int64()) for i, c in enumerate(cols)],
                                             schema.names)

    return rows.select("lang", "words", "f", "before", "parts").mapInArrow(run, schema)


def mined(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5) -> DataFrame:
    """Every phrase of 2 words or more that no longer one makes redundant."""
    stream = streams(docs, text, lang, least, longest)
    no = F.lit(None).cast("array<bigint>")
    left = lockstep(stream.withColumn("before", no).withColumn("extended", F.lit(False)))
    back = staged(left.select("lang", F.reverse("words").alias("words"), "f", F.col("parts").alias("before"), "extended"),
                  "collocation-suffixes")
    both = lockstep(back).where((F.size("words") > 1) & ~F.col("extended"))
    return scored(both.withColumn("words", F.reverse("words")))


def best(phrases: DataFrame, k: int = 2000) -> DataFrame:
    """The first ``k`` of each language, ranked from 1: the first of each of
    many parts of a language, then the first of these."""
    spark = phrases.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= k).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
