"""Quality rules with an isolation forest over their statistics.

``statistics`` counts, for every whole text, what the rules look at.
``base_failed`` applies two plain rules.  A forest of random splits gives every
document that passes them an anomaly score from its mean path length;
``calibrate`` sets the score from which documents are rejected with all
labelled rows.

Every tree is grown in a task of its own, from about ``SUBSAMPLE`` rows that its
own hash draws from all rows that pass the base rules: each row may enter any
tree, at every size of the table by the same rule.  Only the trees (at most
``TREES`` x 511 nodes) come to the driver.

Defined cases: a null or empty text, or one of white space, has no word, so
all its counts are 0 and it fails the base rules; a text of any length is
counted whole.  Labels that are null or other than 0 and 1 are left out; of
several labels of one document the lowest counts.  Where no row that passes the
base rules is labelled good, or none bad, there is no threshold to learn and
only the base rules decide; so too if no tree gets two rows.  Rows that
agree in id and counts are drawn together and count as one in a tree, so a row
repeated very often doesn't fill it; they get equal answers.  Extra columns of the inputs are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipmart.llm.common import only, small_batches, staged

MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
#: The forest: trees, rows that a tree is grown from on average.
TREES, SUBSAMPLE = 200, 256
#: Of the rows labelled good at most this share may be rejected; a share of them
#: costs as much as this many times that share of the bad ones kept.
GOOD_LOST, GOOD_COST = 0.015, 20
BINS = 2000  # score bins that calibration counts in

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_marks", "n_distinct", "n_lines"]


def count_text(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` and ``MORE`` for one text."""
    if not text:
        return (0,) * (len(COUNTS) + len(MORE))
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at exactly the six white-space characters
    n = len(words)
    white = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    ids: dict[bytes, int] = {}
    codes = [ids.setdefault(w, len(ids)) for w in words]
    return (n, len(text) - white, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(np.asarray(codes, np.int64), WINDOW),
            sum(map(str.isupper, words_text(words))), sum(map(text.count, "!?;:")), len(ids), len(lines))


def words_text(words: list[bytes]) -> list[str]:
    return b" ".join(words).decode("utf-8", "surrogatepass").split(" ") if words else []


def repeated_words(codes: np.ndarray, window: int) -> int:
    """Words that lie in a window of ``window`` words found twice or more.
    Windows are numbered exactly, by pairing the numbers of their halves."""
    size, ids = 1, codes
    while size < window:
        step = min(size, window - size)
        if len(ids) <= step:
            return 0
        left, right = ids[:-step], ids[step:]
        ids = np.unique(left * (int(ids.max()) + 1) + right, return_inverse=True)[1].astype(np.int64)
        size += step
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(codes) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def count_texts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([count_text(t if isinstance(t, str) else None) for t in texts],
                        columns=COUNTS + MORE, dtype="int64")


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts of every row."""
    @F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in COUNTS + MORE]))
    def count(texts: pd.Series) -> pd.DataFrame:
        return count_texts(texts)

    small_batches(docs.sparkSession)
    return only(docs, doc_id=doc_id, text=text).select("doc_id", count("text").alias("counts")).select("doc_id", "counts.*")


def base_rules(counts: pd.DataFrame) -> np.ndarray:
    """Which rows fail the base rules."""
    n, repeated = counts["n_words"].to_numpy(), counts["n_repeat_words"].to_numpy()
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))


def features(counts: pd.DataFrame) -> np.ndarray:
    """Shares that don't depend on the length of a text: symbols, capital
    words, marks, different words (in proportion to what a text of that length
    has), characters of a word."""
    c = {n: counts[n].to_numpy(float) for n in COUNTS + MORE}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.column_stack([c["n_symbols"] / chars, c["n_upper"] / words, c["n_marks"] / words,
                            np.log1p(c["n_distinct"]) / np.log1p(words), c["word_chars"] / words])


@dataclass
class Forest:
    """Trees as heap-ordered arrays: feature (-1 at a leaf), split value and
    path length at the node (depth plus what the rows left there would add) in
    multiples of the usual path among the tree's rows."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray
    threshold: float = math.inf

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path over usual path), near 1 for rows set apart early."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, s, p in zip(self.feature, self.split, self.path):
            node = np.zeros(len(x), np.int64)
            while (live := f[node] >= 0).any():
                right = x[rows, np.maximum(f[node], 0)] >= s[node]
                node = np.where(live, 2 * node + 1 + right, node)
            total += p[node]
        return 2.0 ** (-total / max(len(self.feature), 1))


def usual_path(n: int) -> float:
    """Mean path of an unsuccessful search among n rows of a binary search tree."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


DEPTH = math.ceil(math.log2(SUBSAMPLE))
NODES = 2 ** (DEPTH + 1) - 1


def grow(x: np.ndarray, tree: int = 0, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree of two rows or more: split them at random values of random
    features until they stand alone, down to ``DEPTH``."""
    rng = np.random.default_rng([seed, tree])
    feature, split, path = np.full(NODES, -1, np.int64), np.zeros(NODES), np.zeros(NODES)

    def fill(node: int, rows: np.ndarray, level: int) -> None:
        low, high = rows.min(0), rows.max(0)
        open_ = np.flatnonzero(high > low)
        if level == DEPTH or len(rows) < 2 or not len(open_):
            path[node] = (level + usual_path(len(rows))) / usual_path(len(x))
            return
        f = int(rng.choice(open_))
        # a value above the lowest, so that neither side is empty
        v = low[f] + (high[f] - low[f]) * (1 - rng.random())
        feature[node], split[node] = f, v
        right = rows[:, f] >= v
        fill(2 * node + 1, rows[~right], level + 1)
        fill(2 * node + 2, rows[right], level + 1)

    fill(0, x, 0)
    return feature, split, path


def drawn(passed: DataFrame, total: int) -> DataFrame:
    """(tree, counts) of the rows that each tree is grown from: a row enters a
    tree if a hash of both falls under ``SUBSAMPLE`` of all ``total`` rows."""
    bound = F.lit(2.0**64 * (min(1.0, SUBSAMPLE / max(total, 1)) - 0.5))
    row = F.xxhash64("doc_id", *COUNTS, *MORE)
    trees = F.filter(F.sequence(F.lit(0), F.lit(TREES - 1)),
                     lambda t: F.xxhash64(F.col("row"), t).cast("double") <= bound)
    return (passed.withColumn("row", row).withColumn("tree", F.explode(trees))
            .select("tree", "row", *COUNTS, *MORE).distinct())


def grown(rows: DataFrame) -> list[tuple]:
    """The trees, each grown in a task from its drawn rows."""
    def one(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["row", *COUNTS, *MORE])
        tree = [grow(features(part), int(key[0]))] if len(part) > 1 else []
        return pd.DataFrame([(key[0], *(a.tolist() for a in t)) for t in tree],
                            columns=["tree", "feature", "split", "path"])

    return sorted(tuple(r) for r in rows.groupBy("tree").applyInPandas(
        one, "tree int, feature array<long>, split array<double>, path array<double>").collect())


def fit(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> Forest | None:
    """Forest of the rows that pass the base rules, threshold from all labelled
    ones.  None if there is nothing to learn from."""
    passed = stats.where(~base_failed()).select("doc_id", *COUNTS, *MORE)
    marks = only(labels, doc_id=doc_id, quality=quality).where("doc_id IS NOT NULL AND quality IN (0, 1)")
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = staged(passed.join(marks, "doc_id").drop("doc_id"), "quality-labelled")
    n = {r["quality"]: r["n"] for r in rows.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    trees = grown(drawn(passed, passed.count()))
    if not trees:
        return None
    forest = Forest(*(np.array([t[i] for t in trees]) for i in (1, 2, 3)))
    forest.threshold = calibrate(rows, forest)
    return forest


def calibrate(rows: DataFrame, forest: Forest) -> float:
    """The score bound with the least cost, among those above which at most
    ``GOOD_LOST`` of the rows labelled good lie; scores are counted in bins."""
    @F.pandas_udf("double")
    def score(counts: pd.DataFrame) -> pd.Series:
        return pd.Series(forest.score(features(counts)))

    bins = (rows.withColumn("bin", F.floor(score(F.struct(*COUNTS, *MORE)) * BINS)).groupBy("bin")
            .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")).collect())
    counts = sorted(((r["bin"], r["good"], r["bad"]) for r in bins), reverse=True)
    all_good, all_bad = sum(c[1] for c in counts), sum(c[2] for c in counts)
    lost = found = 0
    best, bound = 1.0, math.inf
    for at, good, bad in counts:
        lost, found = lost + good, found + bad
        if lost > GOOD_LOST * all_good:
            break
        if (cost := 1 - found / all_bad + GOOD_COST * lost / all_good) < best:
            best, bound = cost, at / BINS
    return bound


VERDICT = T.StructType([T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()),
                        T.StructField("kept", T.BooleanType())])


def verdicts(counts: pd.DataFrame, forest: Forest | None) -> pd.DataFrame:
    """Base rules, score and whether a row is kept."""
    failed = base_rules(counts)
    score = forest.score(features(counts)) if forest else np.zeros(len(counts))
    return pd.DataFrame({"base_failed": failed, "score": score,
                         "kept": ~failed & (score < (forest.threshold if forest else math.inf))})


def judged(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """``stats`` with ``base_failed``, ``score`` and ``kept``."""
    @F.pandas_udf(VERDICT)
    def judge(counts: pd.DataFrame) -> pd.DataFrame:
        return verdicts(counts, forest)

    return stats.withColumn("verdict", judge(F.struct(*COUNTS, *MORE))).select(*stats.columns, "verdict.*")


def kept(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, judged where they are: their texts
    go through one function and none is shuffled."""
    @F.pandas_udf("boolean")
    def keep(texts: pd.Series) -> pd.Series:
        return verdicts(count_texts(texts), forest)["kept"]

    small_batches(docs.sparkSession)
    return docs.where(keep(F.col(f"`{text}`")))
