"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (by hash) into one stream of words, cut
into equal blocks of ``BLOCK`` words.  The schedule has a slot per block to
take.  Slot i lies at the point i times the golden ratio, modulo 1; the
cumulative weights of the sources map it to a source, and the slots of a
source, ranked in schedule order, take its blocks one after the other, pass
after pass.  So any stretch of the schedule holds the sources close to their
shares.

Weights 5, 2, 1 repeat over the sources by code point, null last.  Together
the sources share ``TOTAL`` of all words; a target stops at ``MOST`` times its
source's size and the excess is shared out again by weight until none is
above, which is the level that the sorted ratios of cap to weight give
directly.

Everything is DataFrame work.  Positions and ranks come from totals per bucket
or run of slots, a running sum over those totals, and a window inside one
bucket or run, so a source with a third of all rows is no one task's work.  Only
the list of sources, one row each, is sorted in one task.

Defined cases: a null text has 0 words and 0 are taken; null and empty sources
are sources of their own; a source without a word has target 0; rows that
agree in id, source and text are placed one after the other; a null id is an
id like any other; an empty table gives an empty result.  A document longer
than a block lies in several.  Reruns give the same schedule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipmart.llm.common import WORD, only, staged

WEIGHTS = (5, 2, 1)
TOTAL, MOST = 1.5, 2
BLOCK = 2048  # words
BUCKET = 4096  # documents of a bucket, on average
RUN = 8192  # slots that are ranked together
SEED = 6
GOLDEN = 0.6180339887498949  # the golden ratio's fractional part
BROADCAST_ROWS = 100_000  # of the list of sources, a few dozen bytes each


def bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def row_hash() -> F.Column:
    """``h`` of a row, from its doc_id and text."""
    return F.xxhash64(F.lit(SEED), "doc_id", "text")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A row (doc_id, source, size, h, n) for the n rows that agree in these."""
    given = only(docs, doc_id=doc_id, text=text, source=source)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return (given.select("doc_id", "source", size.alias("size"), row_hash().alias("h"))
            .groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("n")))


def sources(sizes: DataFrame) -> DataFrame:
    """One row per source: s (its place), weight, source_size, target, words
    (the target as a whole number), blocks, and first / slots (its part of the
    schedule).  One task's work, as each source is one row."""
    by = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    by = by.withColumn("s", place)
    by = by.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("s") % len(WEIGHTS) + 1))
    cap, w = (F.lit(MOST) * F.col("source_size")).cast("double"), F.col("weight").cast("double")
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upward = Window.orderBy(cap / w, "s")
    before = upward.rowsBetween(Window.unboundedPreceding, -1)
    after = upward.rowsBetween(0, Window.unboundedFollowing)
    budget = F.lit(TOTAL) * F.sum("source_size").over(every)
    # in order of cap to weight, a source is capped if an equal level of what is left exceeds its cap
    room = budget - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    by = by.withColumn("capped", room * w >= cap * F.sum(w).over(after))
    spent = F.sum(F.when(F.col("capped"), cap).otherwise(0.0)).over(every)
    open_ = F.sum(F.when(F.col("capped"), 0.0).otherwise(w)).over(every)
    by = by.withColumn("target", F.when(F.col("capped"), cap).otherwise((budget - spent) * w / open_))
    size, words = F.col("source_size"), F.least(F.round("target").cast("long"), F.lit(MOST) * F.col("source_size"))
    blocks = F.ceil(size / F.lit(BLOCK))
    passes = F.floor(words / F.greatest(size, F.lit(1)))
    slots = F.when(size > 0, passes * blocks + F.ceil((words - passes * size) / F.lit(BLOCK))).otherwise(0)
    by = by.select("source", "s", "weight", "source_size", "target", words.alias("words"),
                   blocks.alias("blocks"), slots.alias("slots"))
    first = F.coalesce(F.sum("slots").over(Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return by.withColumn("first", first.cast("long"))


def placed(sizes: DataFrame, by: DataFrame, n_sources: int) -> DataFrame:
    """(doc_id, s, size, h, start): every row's place in its source's stream."""
    rows = sizes.join(bounded(by.select(F.col("source").alias("src"), "s"), n_sources),
                      F.col("source").eqNullSafe(F.col("src"))).drop("src", "source")
    buckets = max(1, -(-rows.count() // BUCKET))
    rows = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)))
    words = F.col("size") * F.col("n")
    total = rows.groupBy("s", "bucket").agg(F.sum(words).alias("w"))
    ahead = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = total.select("s", "bucket", F.coalesce(F.sum("w").over(ahead), F.lit(0)).alias("offset"))
    inside = (Window.partitionBy("s", "bucket").orderBy("h", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("offset") + F.coalesce(F.sum(words).over(inside), F.lit(0))
    rows = rows.join(offset, ["s", "bucket"]).withColumn("start", start)
    copy = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    return (rows.select("doc_id", "s", "size", "h", "start", copy.alias("copy"))
            .select("doc_id", "s", "size", "h", (F.col("start") + F.col("copy") * F.col("size")).alias("start")))


def point(i) -> F.Column:
    """i times the golden ratio, modulo 1, without losing digits for large i."""
    high, low = F.floor(i / F.lit(2**20)), i % F.lit(2**20)
    x = high * F.lit(2**20 * GOLDEN % 1.0) + low * F.lit(GOLDEN)
    return x - F.floor(x)


def schedule(by: DataFrame, n_sources: int) -> DataFrame:
    """(slot, s, rank): the source of every slot and the slot's rank in it."""
    spark = by.sparkSession
    m = by.agg(F.coalesce(F.sum("slots"), F.lit(0))).head()[0]
    # a grid over the points finds the interval of the cumulative weights
    cells = 4 * max(n_sources, 1)
    some = by.where("slots > 0").select("s", "slots", "first", (F.col("first") + F.col("slots")).alias("until"))
    cell = lambda c: F.floor(c * F.lit(cells) / F.lit(max(m, 1))).cast("long")
    grid = some.withColumn("cell", F.explode(F.sequence(cell(F.col("first")), cell(F.col("until")))))
    slots = spark.range(m).select(F.col("id").alias("slot"), F.least(point(F.col("id")) * m, F.lit(m - 0.5)).alias("x"))
    hit = (slots.withColumn("cell", cell(F.col("x"))).join(bounded(grid, 6 * n_sources), "cell")
           .where((F.col("first") <= F.col("x")) & (F.col("x") < F.col("until")))
           .select("slot", "s", F.floor(F.col("slot") / RUN).alias("run")))
    total = hit.groupBy("s", "run").agg(F.count("*").alias("c"))
    ahead = Window.partitionBy("s").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offset = total.select("s", "run", F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("offset"))
    rank = F.col("offset") + F.row_number().over(Window.partitionBy("s", "run").orderBy("slot")) - 1
    ranked = staged(hit.join(offset, ["s", "run"]).select("slot", "s", rank.alias("rank")), "mix-ranked")
    # discrepancy: a source may have a few slots (logarithmically many) more or fewer than it needs
    wide = ranked.join(bounded(some.select("s", "slots"), n_sources), "s")
    number = lambda *c: F.row_number().over(Window.orderBy(*c))
    over = wide.where("rank >= slots").select("slot", number("slot").alias("k"))
    have = ranked.groupBy("s").agg(F.count("*").alias("have"))
    short = (some.join(have, "s", "left").na.fill(0, ["have"]).where("have < slots")
             .select("s", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)).alias("rank")))
    dealt = over.join(short.select("s", "rank", number("s", "rank").alias("k")), "k").select("slot", "s", "rank")
    return wide.where("rank < slots").select("slot", "s", "rank").union(dealt)


def pieces(docs: DataFrame) -> DataFrame:
    """The parts of documents by block: (s, block, doc_id, h, size, start,
    at), ``at`` being where in the block the part begins, then its words
    ``low`` to ``high`` (exclusive)."""
    end = F.col("start") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("start") / BLOCK), F.floor((end - 1) / BLOCK)))
    low = F.greatest("start", F.col("block") * BLOCK)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    return (docs.where("size > 0").withColumn("block", block)
            .select("s", "block", "doc_id", "h", "size", "start", (low - F.col("block") * BLOCK).alias("at"),
                    (low - F.col("start")).alias("low"), (high - F.col("start")).alias("high")))


def stream(docs: DataFrame, slots: DataFrame, by: DataFrame, n_sources: int) -> DataFrame:
    """The mixed stream: (slot, at, s, pass, doc_id, h, start, low, high) for
    every part of a document that a slot takes.  Slots are the order in which
    the mix is to be read; inside one, ``at`` is."""
    info = bounded(by.select("s", "blocks", "source_size", "words"), n_sources)
    block = F.col("rank") % F.col("blocks")
    before = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + F.col("block") * BLOCK
    taken = (slots.join(info, "s").withColumn("block", block)
             .select("slot", "s", "block", F.floor(F.col("rank") / F.col("blocks")).alias("pass"),
                     (F.col("words") - before).alias("left")))  # words until the target
    high = F.least("high", F.col("low") + F.col("left") - F.col("at"))
    return (taken.join(pieces(docs), ["s", "block"]).where(F.col("at") < F.col("left"))
            .select("slot", "at", "s", "pass", "doc_id", "h", "start", "low", high.alias("high")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
        ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sources, stream): every row's place, each source's target,
    and the parts that the schedule takes."""
    sizes = staged(measured(docs, doc_id, text, source), "mix-sizes")
    by = staged(sources(sizes), "mix-sources")
    n = by.count()
    rows = staged(placed(sizes, by, n), "mix-placed")
    return rows, by, stream(rows, schedule(by, n), by, n)


def taken(rows: DataFrame, by: DataFrame, parts: DataFrame) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken, and its slots: the
    first one (null without any) and how many hold words of it."""
    got = parts.groupBy("s", "start").agg(F.sum(F.col("high") - F.col("low")).alias("got"), F.min("slot").alias("first_slot"),
                                          F.count("slot").alias("slots"))
    out = rows.join(got.select(F.col("s").alias("gs"), F.col("start").alias("g"), "got", "first_slot", F.col("slots").alias("n_slots")),
                    (F.col("s") == F.col("gs")) & (F.col("start") == F.col("g")) & (F.col("size") > 0), "left")
    return (out.join(bounded(by.select("s", "source", "source_size", "target"), by.count()), "s")
            .select("doc_id", "source", "h", "size", "source_size", "target",
                    F.coalesce("got", F.lit(0)).cast("long").alias("taken"), "first_slot",
                    F.coalesce("n_slots", F.lit(0)).cast("long").alias("slots")))


def passes(rows: DataFrame, by: DataFrame, parts: DataFrame) -> DataFrame:
    """Per row and pass over its source: doc_id, source, h, size, slot (where
    in the schedule the pass comes to it), at (the place inside that slot) and
    words: all of them, or the leading ones of a document that the target cuts."""
    got = parts.groupBy("s", "start", "pass", "h", "doc_id").agg(
        F.sum(F.col("high") - F.col("low")).alias("words"), F.min(F.struct("slot", "at")).alias("first"))
    size = rows.where("size > 0").select("s", "start", "size")
    return (got.join(size, ["s", "start"]).join(bounded(by.select("s", "source"), by.count()), "s")
            .select("doc_id", "source", "h", "size", "first.slot", "first.at", "words"))
