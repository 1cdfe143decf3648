"""SimHash near-duplicates with pivot distance tables.

Every text gets a 64-bit fingerprint: the majority of its word shingles'
XXH64 bits.  Fingerprints at ``max_bits`` or fewer differing bits are linked
and documents take the smallest id of their connected component.

Equal fingerprints are one class, so a group of copies counts once.  The pivot
table holds each class's Hamming distances to many reference fingerprints.
By the triangle inequality a link changes no coordinate by more than
``max_bits``, so a pair is discarded by its maximum coordinate difference, and
survivors are verified on the fingerprints.  To meet at all, two classes must
agree on enough coordinates: the references come in groups of bit positions
(a reference that is zero but for one group tells, with the all-zero
reference, how many bits of that group are set), and ``max_bits`` changed bits
touch at most ``max_bits`` groups, so every link has the same coordinates on
some choice of all but ``max_bits`` groups.  Each choice is one key.

Classes that share a key are compared inside a task, which reports a spanning
forest of the links and never all pairs.  Keys are counted first.  One with
more than ``LARGE`` classes is not compared pairwise: its classes take the
exact linear way, in which two classes are linked if they reach a common value
by changing half of ``max_bits`` bits each.

Defined cases: a null text, or one without a word, has fingerprint 0 and is
linked like any other; a text with fewer words than a shingle is one shingle;
repeated shingles count each time.  Repeated rows are copies.  A null id keeps
its fingerprint, never names a component unless no member has an id, and gets
its component like any other row.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart.llm.common import only, small_batches, staged

SHINGLE, MAX_BITS, SEED = 3, 2, 42
GROUPS = 8  # groups of bit positions; keys are the choices of GROUPS - MAX_BITS of them
EXTRA_PIVOTS = 16  # references with random bits, for the coordinate check only
LARGE = 4096  # classes of a key that are compared in one task
BROADCAST_KEYS = 100_000  # keys with more classes than that, 8 bytes each


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z only, as these are bytes
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64)
    set_ = np.zeros(64, np.int64)
    for i in range(0, len(h), 65536):
        set_ += np.unpackbits(h[i:i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_ > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``fp`` (long) and the columns ``keep`` of every row."""
    small_batches(docs.sparkSession)
    given = only(docs, doc_id=doc_id, text=text, **{c: c for c in keep})
    schema = T.StructType([given.schema["doc_id"], T.StructField("fp", T.LongType()), *(given.schema[c] for c in keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *b.columns[2:]], ["doc_id", "fp", *keep])

    return given.mapInArrow(run, schema)


def group_masks(groups: int = GROUPS) -> list[int]:
    """Bit positions dealt in turn to the groups, as unsigned masks."""
    return [sum(1 << b for b in range(64) if b % groups == g) for g in range(groups)]


def pivots(groups: int = GROUPS, extra: int = EXTRA_PIVOTS) -> list[int]:
    """The reference fingerprints: zero, one per group, then random ones."""
    rng = np.random.default_rng(SEED)
    return [0, *group_masks(groups), *(int(x) for x in rng.integers(0, 2**64, extra, np.uint64))]


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def pivot_table(classes: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``fp`` with ``d``: its distance to every reference, in order."""
    return classes.select("fp", F.array(*(
        F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(p)))).cast("int") for p in pivots(groups))).alias("d"))


def keys(table: DataFrame, groups: int = GROUPS, max_bits: int = MAX_BITS) -> DataFrame:
    """A row (key, fp) for every choice of ``groups - max_bits`` groups; the
    key hashes the choice and the bits set in its groups.  By the references
    zero and g, the bits set in group g are (d0 + size of g - dg) / 2."""
    sizes = [bin(m).count("1") for m in group_masks(groups)]
    inside = [F.shiftright(F.col("d")[0] + sizes[g] - F.col("d")[g + 1], 1) for g in range(groups)]
    choices = list(combinations(range(groups), groups - max_bits))
    each = F.array(*(F.xxhash64(F.lit(i), *(inside[g] for g in c)) for i, c in enumerate(choices)))
    return table.select(F.explode(each).alias("key"), "fp")


class Forest:
    """Union by smallest index over the classes of one key."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def distances(fp: np.ndarray, references: list[int]) -> np.ndarray:
    """The pivot table's rows of some classes."""
    return np.bitwise_count(fp[:, None] ^ np.array(references, np.uint64)).astype(np.int16)


def links_of(fp: np.ndarray, references: list[int], max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the classes of one key."""
    d = distances(fp, references)
    out, forest, block = [], Forest(len(fp)), 512
    for a in range(0, len(fp), block):
        for b in range(a, len(fp), block):
            x, y = d[a:a + block], d[b:b + block]
            i, j = np.triu_indices(len(x), 1) if a == b else map(np.ravel, np.indices((len(x), len(y))))
            for k in range(0, d.shape[1], 4):  # the maximum coordinate difference, some references at a time
                ok = np.abs(x[i, k:k + 4] - y[j, k:k + 4]).max(axis=1, initial=0) <= max_bits
                i, j = i[ok], j[ok]
            near = np.bitwise_count(fp[a + i] ^ fp[b + j]) <= max_bits
            out += [(p, q) for p, q in zip((a + i[near]).tolist(), (b + j[near]).tolist()) if forest.join(p, q)]
    return out


def compared(keyed: DataFrame, max_bits: int = MAX_BITS, groups: int = GROUPS) -> DataFrame:
    """(fp, other): the links found per key.  No key has more classes than a
    task may compare; tasks read runs of equal keys."""
    references = pivots(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def send(runs: list[np.ndarray]) -> pa.RecordBatch:
            left, right = [], []
            for fp in runs:
                pairs = links_of(fp.view(np.uint64), references, max_bits)
                left += [fp[i] for i, _ in pairs]
                right += [fp[j] for _, j in pairs]
            return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["fp", "other"])

        key, open_ = None, np.empty(0, np.int64)  # the last key's classes may go on in the next batch
        for b in batches:
            k, fp = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(k):
                continue
            cut = np.r_[0, np.flatnonzero(k[1:] != k[:-1]) + 1, len(k)]
            runs = [fp[s:e] for s, e in zip(cut[:-1], cut[1:])]
            if k[0] == key:
                runs[0] = np.concatenate([open_, runs[0]])
            else:
                runs.insert(0, open_)
            key, open_ = k[-1], runs.pop()
            yield send([r for r in runs if len(r) > 1])
        if len(open_) > 1:
            yield send([open_])

    return keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "fp long, other long")


def ball_links(classes: DataFrame, max_bits: int) -> DataFrame:
    """The exact linear way: each class names every value within
    ``ceil(max_bits / 2)`` bits, those within ``floor`` of it and itself are
    its own; classes that name a common value are linked to the smallest of
    them.  For an even ``max_bits`` two classes share a value exactly if they
    differ by ``max_bits`` bits or fewer."""
    if max_bits % 2:
        raise ValueError("the linear way needs an even number of bits")
    flips = [signed(sum(1 << b for b in c)) for r in range(max_bits // 2 + 1) for c in combinations(range(64), r)]
    near = classes.select("fp", F.explode(F.transform(F.array(*map(F.lit, flips)), lambda m: F.col("fp").bitwiseXOR(m)))
                          .alias("value"))
    first = near.groupBy("value").agg(F.min("fp").alias("other"))
    return near.join(first, "value").where("fp <> other").select("fp", "other").distinct()


def components(links: DataFrame) -> DataFrame:
    """(fp, root) for every class with a link: the smallest class of its
    component.  Each round joins every class to the smallest neighbour of its
    neighbours and is written to the shared folder, until nothing changes."""
    both = links.select("fp", "other").union(links.select("other", "fp")).where("fp <> other").distinct()
    edges = staged(both, "simhash-links")
    roots = staged(edges.groupBy("fp").agg(F.min("other").alias("m"))
                   .select("fp", F.least("fp", "m").alias("root")), "simhash-roots")
    while True:
        # the smallest root among neighbours, then one step along the roots found so far
        reach = edges.join(roots.withColumnRenamed("fp", "other"), "other").groupBy("fp").agg(F.min("root").alias("m"))
        nearer = roots.join(reach, "fp").select("fp", F.least("root", "m").alias("step"), F.col("root").alias("old"))
        hop = roots.select(F.col("fp").alias("step"), F.col("root").alias("far"))
        new = staged(nearer.join(hop, "step").select("fp", "old", F.least("step", "far").alias("root")), "simhash-roots")
        if new.where("root <> old").limit(1).count() == 0:
            return new.select("fp", "root")
        roots = new.select("fp", "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, large: int = LARGE, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``fp`` (long), ``component_id``, ``root`` and the columns ``keep``
    of every row.  ``root``, the component's smallest fingerprint, tells components
    apart that have no id or share one."""
    fps = staged(fingerprints(docs, doc_id, text, shingle, keep=keep), "simhash-fingerprints")
    classes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    keyed = keys(pivot_table(classes), max_bits=max_bits)
    hot = staged(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > large).select("key"), "simhash-hot")
    n_hot = hot.count()
    rest = classes.select("fp").limit(0)
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
        rest = keyed.join(hot, "key", "left_semi").select("fp").distinct()
        keyed = keyed.join(hot, "key", "left_anti")
    links = compared(keyed, max_bits).union(ball_links(rest, max_bits))
    linked = components(links)
    first = (linked.join(classes, "fp").groupBy("root").agg(F.min("first").alias("component"))
             .join(linked, "root").select("fp", "component", "root"))
    named = (classes.join(first, "fp", "left")
             .select("fp", F.coalesce("component", "first").alias("component_id"), F.coalesce("root", "fp").alias("root")))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id", "root", *keep)
