"""Chunk sequences of any number of steps: the first n, by ids.

A walk starts at an eligible chunk of the start theme; each next chunk is
eligible, has a theme that the chunk before allows, and no chunk comes twice.
Walks are ordered by their chunk ids, place by place.

1. Backwards, per step: ``live(r)`` are the chunks from which r more steps can
   be taken when repeats are only forbidden between neighbours.  Per theme the
   two smallest live chunks tell that, so nothing is shuffled by theme.
2. Forwards: the first ``width`` live beginnings, each joined with the
   ``width + steps`` smallest live chunks of the themes it allows (that many
   leave ``width`` when the chunks it holds are taken out), then the first
   ``width`` again.

A beginning that was kept may turn out to have no end without a repeat.  All
walks that begin with what was cut off come after those found, so n walks
found are the first n; if there are fewer and something was cut off, the pass
is made again with twice the width.  Widths start at n.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipmart.operators.assemble import MIN_SCORE
from clipmart.session import bounded_broadcast, materialize


def _least(df: DataFrame, by: str, value: str, k: int) -> DataFrame:
    """The k smallest values of every group (k rows per task and group are shuffled)."""
    w = Window.partitionBy(by).orderBy(value)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def _live(chunks: DataFrame, edges: DataFrame, steps: int) -> list[DataFrame]:
    """For r = 0 to ``steps``: chunk_id and theme of the chunks with r more steps before them."""
    out = [chunks]
    for _ in range(steps):
        two = bounded_broadcast(_least(out[-1].select(F.col("theme").alias("next"), F.col("chunk_id").alias("other")), "next", "other", 2))
        with_next = edges.join(two, "next").where(F.col("other") != F.col("chunk_id")).select("chunk_id").distinct()
        out.append(materialize(chunks.join(with_next, "chunk_id", "left_semi")))
    return out


def chunk_walks(fact: DataFrame, compat: DataFrame, start: str = "Hook", steps: int = 4, n: int = 20,
                min_score: int = MIN_SCORE) -> DataFrame:
    """rank (from 1) and ``chunk_ids`` (array of steps + 1) of the first ``n``
    walks.  Repeated edges and rows count once.  Without a chunk of the start
    theme, or without a walk that long, there are no rows."""
    chunks = materialize(fact.where(F.col("standalone_score") >= min_score).where("chunk_id IS NOT NULL AND chunk_theme IS NOT NULL")
                         .select("chunk_id", F.col("chunk_theme").alias("theme")).distinct())
    edges = materialize(compat.where("compatible_theme IS NOT NULL").select("chunk_id", F.col("compatible_theme").alias("next"))
                        .distinct().join(chunks.select("chunk_id").distinct(), "chunk_id", "left_semi"))
    live = _live(chunks, edges, steps)
    width = n
    while True:
        walks, cut = _pass(live, edges, start, steps, width)
        if not cut or walks.count() >= n:
            break
        width *= 2
    first = walks.orderBy("ids").limit(n)
    return first.select(F.row_number().over(Window.orderBy("ids")).cast("long").alias("rank"), F.col("ids").alias("chunk_ids"))


def _pass(live: list[DataFrame], edges: DataFrame, start: str, steps: int, width: int) -> tuple[DataFrame, bool]:
    """Walks from the first ``width`` beginnings of every length, and whether any were left out."""
    begun = live[steps].where(F.col("theme") == start).select("chunk_id").distinct()
    first = materialize(begun.orderBy("chunk_id").limit(width + 1).select(F.array("chunk_id").alias("ids")))
    kept, cut = _cut(first, width)
    for step in range(1, steps + 1):
        ends = kept.select("ids", F.element_at("ids", -1).alias("chunk_id"))
        themes = materialize(edges.join(F.broadcast(ends), "chunk_id").select("ids", "next"))
        # themes that some beginning needs, and few chunks of each
        needed = live[steps - step].join(F.broadcast(themes.select(F.col("next").alias("theme")).distinct()), "theme", "left_semi")
        few = _least(needed, "theme", "chunk_id", width + 1 + steps).withColumnRenamed("theme", "next")
        longer = F.broadcast(themes).join(few, "next").where(~F.array_contains("ids", F.col("chunk_id"))) \
            .select(F.concat("ids", F.array("chunk_id")).alias("ids")).distinct()
        kept, more = _cut(materialize(longer.orderBy("ids").limit(width + 1)), width)
        cut = cut or more
    return kept, cut


def _cut(rows: DataFrame, width: int) -> tuple[DataFrame, bool]:
    """At most width + 1 rows come in; the last of so many is cut off."""
    if rows.count() <= width:
        return rows, False
    return materialize(rows.orderBy("ids").limit(width)), True
