"""Reconciliation of two copies of a table (e.g. lake vs serving copy)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipmart.session import bounded_broadcast, materialize

# Branches of a node of the hash tree, and rows of a leaf that are compared one by one.
BRANCHES, LEAF_ROWS = 1024, 100_000


def multiset_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose multiplicity differs, both directions.  Counted per
    key on each side first (partial aggregates), then one full outer join
    of the two count tables: no row is shipped twice."""
    ca = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_left"))
    cb = b.groupBy(*(F.col(k).alias(f"_right_{k}") for k in keys)).agg(F.count(F.lit(1)).alias("n_right"))
    j = ca.join(cb, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys], "full")
    out = j.select(*(F.coalesce(k, f"_right_{k}").alias(k) for k in keys), F.coalesce("n_left", F.lit(0)).alias("n_left"),
                   F.coalesce("n_right", F.lit(0)).alias("n_right"))
    out = out.where(F.col("n_left") != F.col("n_right"))
    return out.withColumn("side", F.when(F.col("n_left") > F.col("n_right"), "only_left")
                          .otherwise("only_right"))


def diff_sample(diff: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """A few differing keys per side for the report."""
    return diff.where(F.col("side") == "only_left").orderBy(*keys).limit(n).unionByName(
        diff.where(F.col("side") == "only_right").orderBy(*keys).limit(n))


def tables(pairs: dict[str, tuple[DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """Per table: row counts, then the key-multiset verdict.

    Both sides' keys are tagged and counted per key in one aggregate
    (partial + final), then one more aggregate per table derives the
    counts and the surplus of each side; no join is needed."""
    out = None
    for name, (left, right, keys) in pairs.items():
        tagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
            right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        per_key = tagged.groupBy(*keys).agg(F.sum("_l").alias("nl"), F.sum("_r").alias("nr"))
        row = per_key.agg(
            F.coalesce(F.sum("nl"), F.lit(0)).cast("long").alias("left_rows"),
            F.coalesce(F.sum("nr"), F.lit(0)).cast("long").alias("right_rows"),
            F.coalesce(F.sum(F.greatest(F.col("nl") - F.col("nr"), F.lit(0))), F.lit(0)).cast("long")
            .alias("only_left"),
            F.coalesce(F.sum(F.greatest(F.col("nr") - F.col("nl"), F.lit(0))), F.lit(0)).cast("long")
            .alias("only_right"),
        ).select(F.lit(name).alias("table_name"), "left_rows", "right_rows", "only_left", "only_right")
        out = row if out is None else out.unionByName(row)
    return out.withColumn("status", F.when(F.col("left_rows") != F.col("right_rows"), "count_mismatch")
                          .when((F.col("only_left") + F.col("only_right")) > 0, "key_mismatch")
                          .otherwise("match"))


# --- hash tree -------------------------------------------------------------------

def _hashed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with two independent 64-bit hashes of them; nulls count."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return df.select(*columns, F.xxhash64(*parts).alias("_h"), F.xxhash64(F.lit("second"), *parts).alias("_g"))


def _node(level: int):
    """The branch of a row at a level: other bits of its hash at each."""
    return F.pmod(F.shiftrightunsigned("_h", 10 * level), F.lit(BRANCHES)).cast("int")


def _sums(rows: DataFrame, path: list[str], level: int) -> DataFrame:
    """Per node: rows and checksums that don't depend on their order.  Halves
    of a hash are summed, as whole ones would overflow."""
    half = lambda c, up: (F.shiftrightunsigned(c, 32) if up else F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    return rows.withColumn(f"_n{level}", _node(level)).groupBy(*path, f"_n{level}").agg(
        F.count(F.lit(1)).alias("n"), *(F.bit_xor(c).alias(f"x{c}") for c in ("_h", "_g")),
        *(F.sum(half(c, up)).alias(f"s{c}{up}") for c in ("_h", "_g") for up in (0, 1)))


def tree_levels(a: DataFrame, b: DataFrame, columns: list[str], max_levels: int = 4) -> tuple[DataFrame, DataFrame, list[int]]:
    """The rows of both sides that stand under differing leaves, and how many
    rows were left at each level (both sides together).

    Rows are dealt to the BRANCHES nodes of a level by their hash.  Each side
    sends one row of sums per node; nodes with equal sums hold the same rows
    (but for a collision of 128 bits), and only rows of differing nodes go on
    to the next level, until few enough are left to be compared."""
    left, right = _hashed(a, columns), _hashed(b, columns)
    path: list[str] = []
    counts: list[int] = []
    rows = F.coalesce("l.n", F.lit(0)) + F.coalesce("r.n", F.lit(0))
    for level in range(max_levels):
        node, on = f"_n{level}", [*path, f"_n{level}"]
        ours, theirs = _sums(left, path, level), _sums(right, path, level)
        values = [c for c in ours.columns if c not in on]
        both = ours.select(*on, F.struct(*values).alias("l")).join(theirs.select(*on, F.struct(*values).alias("r")), on, "full")
        # at most BRANCHES nodes below each differing one of the level before
        nodes = materialize(both.select(*on, rows.alias("rows"), (~F.col("l").eqNullSafe(F.col("r"))).alias("differs")))
        if not counts:  # the first level's nodes hold all rows
            counts.append(nodes.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
        differ = nodes.where("differs")
        left, right = (side.withColumn(node, _node(level)).join(bounded_broadcast(differ.select(*on)), on, "left_semi")
                       for side in (left, right))
        path = on
        counts.append(differ.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0])
        # a level helps while its nodes hold many rows each; damage of most nodes can't be narrowed down
        if counts[-1] <= LEAF_ROWS or counts[-1] <= LEAF_ROWS // 100 * differ.count():
            break
    return left.select(*columns), right.select(*columns), counts


def tree_diff(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """As ``multiset_diff``, but shuffles sums of all rows and keys of
    rows under differing leaves only: in proportion to the damage."""
    left, right, _ = tree_levels(a, b, columns)
    return multiset_diff(left, right, columns)
