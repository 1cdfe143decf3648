"""Manifest lineage contract and graph walks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipmart.session import materialize

# Lineage contract rules of the manifest.
REQUIRED_COLS = ["asset_id", "client_id", "content_sha256", "asset_type", "source_uri"]
HEX64 = r"^[0-9a-f]{64}$"
URI = r"^s3://([^/]+)/landing/([^/]+)/video/([0-9a-f]{64})\.\w+$"
PLACEHOLDER_DENYLIST = ["", "demo_client", "test", "tbd", "todo", "unknown", "client", "na", "none"]


def duplicates(manifest: DataFrame, key: str = "asset_id", order_col: str = "row_pos") -> DataFrame:
    """2nd and later rows of a repeated key, by input position.  The
    first position per key is a partial aggregate joined back, so a key
    holding many rows is never sorted inside one task."""
    first = manifest.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(order_col).alias("first_pos"), F.count(F.lit(1)).alias("n"))
    return manifest.join(first.where(F.col("n") > 1), key).where(F.col(order_col) > F.col("first_pos"))


def violations(manifest: DataFrame, clients: DataFrame, order_col: str = "row_pos") -> DataFrame:
    """One row (row_pos, asset_id, rule, field, value) per breach: the
    field that breaks the rule and what it holds (for R6 the row that has the
    id first).  Rules over one row are a list of conditions read in one pass;
    R5 looks the client up and R6 is ``duplicates``."""
    text = {c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in REQUIRED_COLS}
    asset, client, content, place = (text[c] for c in ("asset_id", "client_id", "content_sha256", "source_uri"))
    in_place = {"client_id": F.regexp_extract(place, URI, 2), "asset_id": F.regexp_extract(place, URI, 3)}
    placed = place.rlike(URI)
    derived = F.sha2(F.concat_ws(":", client, content), 256)
    breaches = [("R1", c, v == "", v) for c, v in text.items()]
    breaches += [("R2", c, ~text[c].rlike(HEX64), text[c]) for c in ("asset_id", "content_sha256")]
    breaches += [("R3", "asset_id", content.rlike(HEX64) & (client != "") & (asset != derived), asset),
                 ("R4", "source_uri", ~placed, place)]
    breaches += [("R4", c, placed & (v != text[c]), v) for c, v in in_place.items()]
    breaches += [("R7", "client_id", client.isin(*PLACEHOLDER_DENYLIST), client)]
    found = F.filter(F.array(*(
        F.when(broken, F.struct(F.lit(rule).alias("rule"), F.lit(field).alias("field"), value.alias("value")))
        for rule, field, broken, value in breaches)), lambda x: x.isNotNull())
    one_row = manifest.select(order_col, "asset_id", F.explode(found).alias("b")).select(order_col, "asset_id", "b.*")
    given = manifest.select(order_col, "asset_id", client.alias("value")).where("value <> ''")
    orphans = given.join(clients.select(F.col("client_id").alias("value")), "value", "left_anti") \
        .select(order_col, "asset_id", F.lit("R5").alias("rule"), F.lit("client_id").alias("field"), "value")
    again = duplicates(manifest, "asset_id", order_col).select(
        order_col, "asset_id", F.lit("R6").alias("rule"), F.lit("asset_id").alias("field"),
        F.col("first_pos").cast("string").alias("value"))
    return one_row.unionByName(orphans).unionByName(again)


def closure(edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Ancestor -> descendant pairs over lineage edges, with the
    shortest depth, by doubling.  After a round all pairs up to a depth d are
    known; a pair of depth d + 1 to 2d passes a node at depth d, so the pairs
    of exactly that depth, joined with all, give them.  Rounds are the
    logarithm of the longest shortest path; no pair is at the new depth where
    nothing is left, so cycles end by themselves and nothing is cut off unless
    ``max_depth`` asks for it.  Rounds are materialised."""
    e = edges.where(F.col("parent_asset_id").isNotNull() & F.col("child_asset_id").isNotNull())
    seen = materialize(e.select(F.col("parent_asset_id").alias("ancestor"), F.col("child_asset_id").alias("descendant"))
                       .distinct().withColumn("depth", F.lit(1)))
    reach = 1
    while max_depth is None or reach < max_depth:
        far = seen.where(F.col("depth") == reach).select("ancestor", F.col("descendant").alias("via"))
        if far.isEmpty():
            break
        on = seen.select(F.col("ancestor").alias("via"), "descendant", (F.col("depth") + reach).alias("depth"))
        joined = far.join(on, "via").select("ancestor", "descendant", "depth")
        reach *= 2
        if max_depth is not None:
            joined = joined.where(F.col("depth") <= max_depth)
        seen = materialize(seen.union(joined).groupBy("ancestor", "descendant").agg(F.min("depth").alias("depth")))
    return seen


def theme_walk(fact: DataFrame, compat: DataFrame, start: str = "Hook", steps: int = 4,
               min_score: int = 4) -> DataFrame:
    """J18 (sequence walk): theme paths of up to ``steps`` hops from the start
    theme over the graph of allowed transitions between eligible chunks.
    The theme graph is aggregated first (distinct theme -> theme edges), so
    the walk runs on a graph with one node per theme, not per chunk."""
    e = fact.where(F.col("standalone_score") >= min_score).select("chunk_id", "chunk_theme")
    eligible_themes = e.select(F.col("chunk_theme").alias("dst")).distinct()
    g = materialize(e.join(compat, "chunk_id")
                    .select(F.col("chunk_theme").alias("src"), F.col("compatible_theme").alias("dst"))
                    .join(eligible_themes, "dst", "left_semi").distinct())
    walk = g.where(F.col("src") == start).select(
        F.concat_ws(" > ", "src", "dst").alias("path"), F.col("dst").alias("last_theme"), F.lit(1).alias("depth"))
    out = walk
    for depth in range(2, steps + 1):
        walk = walk.join(g, F.col("last_theme") == F.col("src")).select(
            F.concat_ws(" > ", "path", "dst").alias("path"), F.col("dst").alias("last_theme"), F.lit(depth).alias("depth"))
        out = out.union(walk)
    return out
