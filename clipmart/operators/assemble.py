"""Mix-and-match assembly over the chunk compatibility graph.

``pairs``      J11  Hook chunk -> any other chunk whose theme it allows.
``pair_counts``     the same, counted per (hook asset, next theme) without
                    materialising the pairs.
``sequences``  J12  fixed 3 steps (start -> body -> cta), LIMIT n, ordered
                    by the three ids, computed on bounded candidate sets.
``first_pairs``     the first n pairs in order of their ids, with both texts.

Skew: themes are few and very unequal (one theme may own a third of all
chunks), so nothing here shuffles by theme.  Per-theme summaries are tiny
and broadcast behind a row-count check; per-theme top-k uses the
``row_number() <= k`` pattern that Spark plans as a WindowGroupLimit, i.e.
each map task keeps k rows per theme before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipmart.session import MAX_BROADCAST_ROWS, bounded_broadcast, materialize

# The safety floor on every assembled chunk.
MIN_SCORE = 4


def _eligible(fact: DataFrame, min_score: int) -> DataFrame:
    return fact.where(F.col("standalone_score") >= min_score) \
        .select("chunk_id", "asset_id", "chunk_theme")


def pairs(fact: DataFrame, compat: DataFrame, start: str = "Hook", min_score: int = MIN_SCORE) -> DataFrame:
    """Every safe (hook, next) pair with bag semantics (duplicate
    edges repeat rows).  This is the full pair table: its size is
    hooks x chunks-per-theme, so callers at scale should use
    ``pair_counts`` or ``sequences``."""
    e = _eligible(fact, min_score)
    h = e.where(F.col("chunk_theme") == start).select(
        F.col("chunk_id").alias("hook_chunk"), F.col("asset_id").alias("hook_asset"))
    edges = compat.select(F.col("chunk_id").alias("hook_chunk"), F.col("compatible_theme").alias("next_theme"))
    n = e.select(F.col("chunk_id").alias("next_chunk"), F.col("asset_id").alias("next_asset"),
                 F.col("chunk_theme").alias("next_theme"))
    return h.join(edges, "hook_chunk").join(n, "next_theme") \
        .where(F.col("next_chunk") != F.col("hook_chunk"))


def endpoints(fact: DataFrame, compat: DataFrame, start: str = "Hook", min_score: int = MIN_SCORE) -> DataFrame:
    """(chunk_id, role) of every chunk at an end of some pair of ``pairs``
    (``hook`` or ``next``), found per theme and edge, in linear work."""
    e = _eligible(fact, min_score)
    edges = e.where(F.col("chunk_theme") == start).join(compat, "chunk_id").select(
        F.col("chunk_id").alias("hook"), F.col("compatible_theme").alias("chunk_theme"))
    # of each side the two smallest of a theme tell whether there is a partner other than the chunk itself
    two = lambda df, c: bounded_broadcast(
        _topk(df.select("chunk_theme", F.col(c).alias("other")).distinct(), ["chunk_theme"], "other", 2))
    hooks = edges.join(two(e, "chunk_id"), "chunk_theme").where(F.col("hook") != F.col("other")) \
        .select(F.col("hook").alias("chunk_id"), F.lit("hook").alias("role")).distinct()
    nexts = e.join(two(edges, "hook"), "chunk_theme").where(F.col("chunk_id") != F.col("other")) \
        .select("chunk_id", F.lit("next").alias("role")).distinct()
    return hooks.unionByName(nexts)


def first_pairs(fact: DataFrame, compat: DataFrame, start: str = "Hook", n: int = 20,
                min_score: int = MIN_SCORE) -> DataFrame:
    """J11 as rows: the first ``n`` pairs by (hook, next) with assets, theme and
    texts.  A hook needs at most its n + 1 smallest candidates per theme (one may
    be itself), and only the first n hooks with any partner can be among
    the first n pairs, so every intermediate is bounded by n and the themes."""
    e = _eligible(fact, min_score)
    cand = materialize(_topk(e.select(F.col("chunk_id").alias("next_chunk"), F.col("chunk_theme").alias("next_theme")),
                             ["next_theme"], "next_chunk", n + 1))
    side = F.broadcast(cand) if cand.count() <= MAX_BROADCAST_ROWS else cand
    edges = e.where(F.col("chunk_theme") == start).join(compat, "chunk_id").select(
        F.col("chunk_id").alias("hook_chunk"), F.col("compatible_theme").alias("next_theme"))
    differ = F.col("next_chunk") != F.col("hook_chunk")
    few = bounded_broadcast(_topk(cand, ["next_theme"], "next_chunk", 2))
    live = edges.join(few, "next_theme").where(differ).select("hook_chunk").distinct().orderBy("hook_chunk").limit(n)
    ids = edges.join(F.broadcast(live), "hook_chunk", "left_semi").join(side, "next_theme").where(differ) \
        .orderBy("hook_chunk", "next_chunk").limit(n)
    shown = lambda to: fact.select(F.col("chunk_id").alias(f"{to}_chunk"), F.col("asset_id").alias(f"{to}_asset"),
                                   F.col("transcript_segment").alias(f"{to}_text"))
    ids = F.broadcast(materialize(ids))  # n rows
    out = shown("hook").join(ids, "hook_chunk")
    return shown("next").join(F.broadcast(out), "next_chunk").select(
        "hook_chunk", "hook_asset", "hook_text", "next_chunk", "next_asset", "next_theme", "next_text")


def pair_counts(fact: DataFrame, compat: DataFrame, start: str = "Hook",
                min_score: int = MIN_SCORE) -> DataFrame:
    """J11 counted: pairs per (hook asset, next theme) = sum over the hook's
    edges of (eligible chunks of that theme) minus the hook itself when its
    own theme is allowed.  One broadcast of a per-theme count table; no
    pair row is ever produced."""
    e = _eligible(fact, min_score)
    per_theme = bounded_broadcast(e.groupBy(F.col("chunk_theme").alias("next_theme"))
                                  .agg(F.count(F.lit(1)).alias("n_theme")))
    h = e.where(F.col("chunk_theme") == start)
    edges = h.join(compat, "chunk_id").select("chunk_id", "asset_id", "chunk_theme",
                                              F.col("compatible_theme").alias("next_theme"))
    j = edges.join(per_theme, "next_theme")
    self_hit = F.when(F.col("next_theme") == F.col("chunk_theme"), 1).otherwise(0)
    return j.groupBy(F.col("asset_id").alias("hook_asset"), "next_theme").agg(
        F.sum(F.col("n_theme") - self_hit).cast("long").alias("n_pairs")).where(F.col("n_pairs") > 0)


# --- bounded 3-step assembly ----------------------------------------------------

def _topk(df: DataFrame, part: list[str], order: str, k: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(order)
    return df.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def _body_reach(e: DataFrame, dedup: DataFrame, small: bool = True) -> DataFrame:
    """For every eligible chunk b: cnt = distinct eligible chunks c != b in
    the themes b allows, and when cnt = 1 the one candidate ``cand``.
    ``small``: the per-theme table (one row per theme) may be broadcast."""
    ts = e.groupBy("chunk_theme").agg(
        F.count(F.lit(1)).alias("ec"),
        F.min("chunk_id").alias("min1"))
    # second smallest id per theme: smallest id above min1
    second = e.join(ts.select("chunk_theme", "min1"), "chunk_theme") \
        .where(F.col("chunk_id") > F.col("min1")) \
        .groupBy("chunk_theme").agg(F.min("chunk_id").alias("min2"))
    ts = ts.join(second, "chunk_theme", "left").withColumnRenamed("chunk_theme", "compatible_theme")
    ts = F.broadcast(ts) if small else ts
    be = e.select(F.col("chunk_id").alias("b"), F.col("chunk_theme").alias("b_theme")) \
        .join(dedup.withColumnRenamed("chunk_id", "b"), "b") \
        .join(ts, "compatible_theme")
    own = F.when(F.col("compatible_theme") == F.col("b_theme"), 1).otherwise(0)
    other = F.when(F.col("min1") != F.col("b"), F.col("min1")).otherwise(F.col("min2"))
    return be.groupBy("b", "b_theme").agg(
        (F.sum("ec") - F.sum(own)).alias("cnt"), F.min(other).alias("cand"))


def sequences(fact: DataFrame, compat: DataFrame, start: str = "Hook", n: int = 20,
              min_score: int = MIN_SCORE) -> DataFrame:
    """The first ``n`` rows of the 3-step walk ordered by (hook, body,
    cta) ids, equal to the naive triple join + ORDER BY + LIMIT, but with
    every intermediate bounded by n rather than by the data:

    1. eligible = score >= min_score; edges deduped for bounding, raw
       edges (bag) used for the output multiplicity;
    2. reach(b) = (cnt, cand): a body with cnt >= 2 is live for any hook,
       cnt = 1 is live unless cand is the hook, cnt = 0 is dead;
    3. liveness of hooks is decided against a per-theme summary of at most
       2 bodies of class >= 2 and 2 bodies for each of the 3 smallest
       single candidates; the n smallest live hooks H are enough;
    4. bodies per theme: n smallest valid for all of H, plus those that are
       in H, plus n per single candidate that is in H; keep n per hook;
    5. ctas per theme: the n + 2 smallest eligible ids;
    6. join the bounded sets with the raw edges, sort, LIMIT n.
    """
    # ``fact`` and ``compat`` are expected to be stored Gold tables (or
    # materialised): the branches below re-read them with cheap filters.
    # The derived body reach table is read by several branches, so it is
    # materialised once (reliable checkpoint in spark.checkpoint.dir).
    e = _eligible(fact, min_score)
    raw = compat.select("chunk_id", "compatible_theme").where(F.col("compatible_theme").isNotNull())
    dedup = raw.distinct()
    # One count bounds both per-theme tables below: the theme stats have one
    # row per eligible theme, the liveness summary at most 8 per theme.
    n_themes = e.select("chunk_theme").distinct().count()
    small = 8 * n_themes <= MAX_BROADCAST_ROWS
    reach = materialize(_body_reach(e, dedup, small).where(F.col("cnt") >= 1))

    # 3. hook liveness
    two = F.col("cnt") >= 2
    many = _topk(reach.where(two).select(F.col("b_theme").alias("t"), "b", F.lit(None).cast("string").alias("cand")),
                 ["t"], "b", 2)
    single = reach.where(~two).select(F.col("b_theme").alias("t"), "b", "cand")
    single = _topk(single, ["t", "cand"], "b", 2)
    first_of = single.groupBy("t", "cand").agg(F.min("b").alias("fb"))
    keep_c = _topk(first_of, ["t"], "fb", 3).select("t", "cand")
    summary = many.unionByName(single.join(keep_c, ["t", "cand"], "left_semi"))
    summary = F.broadcast(summary) if small else summary
    hooks = e.where(F.col("chunk_theme") == start).select(F.col("chunk_id").alias("h"))
    h_edges = hooks.join(dedup.select(F.col("chunk_id").alias("h"), F.col("compatible_theme").alias("t")), "h")
    live = h_edges.join(summary, "t").where(
        (F.col("b") != F.col("h")) & (F.col("cand").isNull() | (F.col("cand") != F.col("h"))))
    # H, the hook->body table and the final rows are bounded by n, n*n and
    # n rows; checkpointing them keeps the plan tree from repeating every
    # upstream branch in each of their readers.
    H = F.broadcast(materialize(live.select("h").distinct().orderBy("h").limit(n)))

    # 4. bodies, bounded per theme and per hook
    h_themes = h_edges.join(H, "h")
    themes = h_themes.select("t").distinct()
    hset = H.select(F.col("h").alias("hid"))
    r = reach.select(F.col("b_theme").alias("t"), "b", "cnt", "cand").join(F.broadcast(themes), "t", "left_semi")
    r = r.join(hset.withColumnRenamed("hid", "b").withColumn("b_in_h", F.lit(True)), "b", "left") \
        .join(hset.withColumnRenamed("hid", "cand").withColumn("c_in_h", F.lit(True)), "cand", "left") \
        .fillna(False, ["b_in_h", "c_in_h"])
    univ = _topk(r.where(~F.col("b_in_h") & (two | ~F.col("c_in_h"))), ["t"], "b", n)
    mine = r.where(F.col("b_in_h"))
    by_cand = _topk(r.where(~F.col("b_in_h") & ~two & F.col("c_in_h")), ["t", "cand"], "b", n)
    bodies = univ.unionByName(mine).unionByName(by_cand).select("t", "b", "cnt", "cand")
    hb = h_themes.join(bodies, "t").where(
        (F.col("b") != F.col("h")) & ((F.col("cnt") >= 2) | (F.col("cand") != F.col("h"))))
    hb = _topk(hb.select("h", "b").distinct(), ["h"], "b", n)

    # 5. ctas, bounded per theme
    ctas = _topk(e.select(F.col("chunk_theme").alias("t2"), F.col("chunk_id").alias("c")), ["t2"], "c", n + 2)

    # 6. output with bag multiplicity from the raw edges
    hb_b = F.broadcast(materialize(hb))
    e_h = raw.select(F.col("chunk_id").alias("h"), F.col("compatible_theme").alias("bt"))
    e_b = raw.select(F.col("chunk_id").alias("b"), F.col("compatible_theme").alias("t2"))
    body_theme = e.select(F.col("chunk_id").alias("b"), F.col("chunk_theme").alias("bt"))
    rows = (hb_b.join(body_theme, "b").join(e_h, ["h", "bt"])
            .join(e_b.join(hb_b.select("b").distinct(), "b", "left_semi"), "b")
            .join(ctas, "t2")
            .where((F.col("c") != F.col("h")) & (F.col("c") != F.col("b")))
            .select("h", "b", "c").orderBy("h", "b", "c").limit(n))
    return _attach(materialize(rows), fact)


def _attach(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Chunk attributes for the n result rows (broadcast of the n rows'
    ids against the fact; the fact is never shuffled)."""
    f = fact.select("chunk_id", "asset_id", "chunk_theme", "start_sec", "end_sec", "transcript_segment")
    ids = F.broadcast(rows.select(F.explode(F.array("h", "b", "c")).alias("chunk_id")).distinct())
    look = f.join(ids, "chunk_id", "left_semi")

    def role(prefix, key):
        return look.select(F.col("chunk_id").alias(key),
                           F.col("asset_id").alias(f"{prefix}_asset_id"),
                           F.col("chunk_theme").alias(f"{prefix}_theme"),
                           F.col("start_sec").alias(f"{prefix}_start"),
                           F.col("end_sec").alias(f"{prefix}_end"),
                           F.col("transcript_segment").alias(f"{prefix}_text"))
    out = rows.join(role("hook", "h"), "h").join(role("body", "b"), "b").join(role("cta", "c"), "c")
    return out.select(
        F.col("h").alias("hook_chunk_id"), "hook_asset_id", "hook_start", "hook_end", "hook_text",
        F.col("b").alias("body_chunk_id"), "body_asset_id", "body_theme", "body_start", "body_end",
        "body_text",
        F.col("c").alias("cta_chunk_id"), "cta_asset_id", "cta_theme", "cta_start", "cta_end", "cta_text")
