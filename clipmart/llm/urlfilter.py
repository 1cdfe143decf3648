"""URL filter: rules first, then a character language-model ratio.

Urls that a rule decides are the labelled examples.  Two variable-order Markov
models, one of accepted and one of rejected urls, give each character a
probability after its up to ``ORDER`` predecessors: counts of the longest known
context, smoothed with those of the next shorter one (``LAMBDA`` pseudo-counts
in proportion to it).  A url without a rule is allowed if its log-likelihood
difference per character reaches a threshold calibrated on labelled urls that
the models haven't seen.

All of it is DataFrame work.  The smoothing is linear in what is looked up: a
text's log-likelihood is a constant per character plus one weight for every
substring of up to ``ORDER + 1`` characters, so both models are one table of
substrings and weight differences, and scoring is one join and a sum per row
(two joins where the models are too large to broadcast whole).  The models learn
from three quarters of all labelled urls, the threshold from all others.  A substring
of three or more characters counts if it stands in those at least ``LEAST`` times: one
seen once says no more than its shorter contexts do, and these are what is many.

Defined cases: a null url, or one without ``://``, has empty host and path and
is scored as an empty text (its end mark alone).  Without labelled urls of both kinds
the score is 0 and every url is allowed.  Repeated rows get equal answers.
Very long urls are learned from and scored whole, in pieces.  Extra columns of
the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clipmart.llm.common import only, staged

#: (verdict, host, path) of each rule.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
ORDER = 5  # characters of the longest context
LAMBDA = 2.0
LEAST = 2  # occurrences of a substring of three or more characters that the models keep
CALIBRATION = 4  # one labelled url in so many sets the threshold
MODEL_ROWS = 1_000_000  # up to that many substrings (some 50 bytes each) are broadcast
PIECE = 512  # characters of a text whose substrings are made at once
END = "\x03"
BINS = 1000  # of one unit of score, in calibration


def parsed(pages: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host and path of every row."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    given = only(pages, page_id=page_id, url=url)
    part = lambda n: F.coalesce(F.regexp_extract("url", parts, n), F.lit(""))
    return given.select("page_id", F.translate(part(1), upper, lower).alias("host"), part(2).alias("path"))


def by_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` (host and path of the longest that fits) and ``ruled`` (its verdict)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer one goes before
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("ruled", verdict)


def spot(text) -> F.Column:
    """A number from 0 to 1 by hash of a text, the same in any engine."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(16.0**8)


def substrings(texts: DataFrame, longest: int = ORDER + 1) -> DataFrame:
    """The columns of ``texts`` but ``text``, with ``s`` for every substring of
    up to ``longest`` characters of the text and its end mark."""
    rest = [c for c in texts.columns if c != "text"]
    t = F.concat("text", F.lit(END))
    pieces = texts.select(*rest, t.alias("t"), F.explode(F.sequence(F.lit(0), F.floor((F.length(t) - 1) / PIECE))).alias("k"))
    pieces = pieces.select(*rest, F.substring("t", (F.col("k") * PIECE + 1).cast("int"), F.lit(PIECE + longest - 1)).alias("p"))
    starts = pieces.select(*rest, "p", F.explode(F.sequence(F.lit(1), F.least(F.length("p"), F.lit(PIECE)))).alias("i"))
    # all substrings from one character on; at the end of the text there are fewer
    from_ = F.substring("p", F.col("i"), F.lit(longest))
    sizes = F.sequence(F.lit(1), F.length("f"))
    return (starts.select(*rest, from_.alias("f"))
            .select(*rest, F.explode(F.transform(sizes, lambda n: F.substring(F.col("f"), F.lit(1), n))).alias("s")))


def learned(texts: DataFrame) -> DataFrame:
    """(s, w) from labelled texts (``text``, ``ok`` 1 or 0): the weight that an
    occurrence of s adds to the log-likelihood difference.  The empty string's
    weight counts once per character."""
    n = (substrings(texts).groupBy("s").agg(F.sum("ok").alias("c1"), F.sum(1 - F.col("ok")).alias("c0"))
         .where((F.length("s") < 3) | (F.col("c1") + F.col("c0") >= LEAST)))
    size = F.length("s")
    context = Window.partitionBy("size", "context")
    n = n.withColumn("size", size).withColumn("context", F.substring("s", F.lit(1), size - 1))
    # t: occurrences of the context, back: what an unknown character after it keeps of the shorter context
    for c in "01":
        n = n.withColumn(f"t{c}", F.sum(f"c{c}").over(context))
    n = staged(n, "url-counts")
    back = lambda t: F.log(F.lit(LAMBDA) / (t + F.lit(LAMBDA)))
    below = None
    levels = []
    for m in range(1, ORDER + 2):
        level = n.where(F.col("size") == m)
        if below is None:
            # the base is equal for all characters and drops out of the difference
            level = level.withColumn("q0", F.lit(1 / 256)).withColumn("q1", F.lit(1 / 256))
        else:
            shorter = below.select(F.col("s").alias("tail"), F.col("p0").alias("q0"), F.col("p1").alias("q1"))
            level = level.join(shorter, F.substring("s", F.lit(2), F.lit(m)) == F.col("tail")).drop("tail")
        for c in "01":
            p = (F.col(f"c{c}") + F.lit(LAMBDA) * F.col(f"q{c}")) / (F.col(f"t{c}") + F.lit(LAMBDA))
            level = level.withColumn(f"p{c}", p)
            level = level.withColumn(f"w{c}", F.log(f"p{c}") - F.log(f"q{c}") - back(F.col(f"t{c}")))
        level = staged(level.select("s", "context", "t0", "t1", "p0", "p1", "w0", "w1"), "url-level")
        levels.append(level)
        below = level
    rows = levels[0]
    for level in levels[1:]:
        rows = rows.union(level)
    own = rows.select("s", (F.col("w1") - F.col("w0")).alias("w"))
    as_context = (rows.groupBy("context").agg(F.max("t0").alias("t0"), F.max("t1").alias("t1"))
                  .select(F.col("context").alias("s"), (back(F.col("t1")) - back(F.col("t0"))).alias("w")))
    return staged(own.union(as_context).groupBy("s").agg(F.sum("w").alias("w")), "url-model")


def scored(texts: DataFrame, model: DataFrame, model_rows: int, per_character: float) -> DataFrame:
    """The columns of ``texts`` but ``text``, with ``score``.  Rows are told
    apart by a number of their own while their substrings are summed up."""
    rest = [c for c in texts.columns if c != "text"]
    numbered = texts.withColumn("row_number", F.monotonically_increasing_id())
    numbered = numbered.withColumn("size", F.length("text") + 1)
    if model_rows > MODEL_ROWS:
        return scored_by_shuffle(numbered, model, per_character).select(*rest, "score")
    total = F.sum(F.coalesce("w", F.lit(0.0)))
    return (substrings(numbered).join(F.broadcast(model), "s", "left").groupBy("row_number", "size", *rest)
            .agg(total.alias("total"))
            .select(*rest, (F.col("total") / F.col("size") + F.lit(per_character)).alias("score")))


def scored_by_shuffle(numbered: DataFrame, model: DataFrame, per_character: float) -> DataFrame:
    """``numbered`` with ``score``, for a model too large to broadcast.  Substrings
    that make up a ``MODEL_ROWS``-th of all occurrences or more, so at most
    ``MODEL_ROWS`` ones, are looked up in a broadcast table, in the model or not;
    the others meet the model in a shuffle, which no single one of them fills."""
    numbered = staged(numbered, "url-numbered")  # read several times, with the same numbers
    pieces = substrings(numbered.select("row_number", "text"))
    count = sum((F.greatest(F.col("size") - n, F.lit(0)) for n in range(ORDER + 1)), F.lit(0)).cast("long")
    total = numbered.agg(F.sum(count).alias("n")).head()["n"] or 0
    often = pieces.groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") * F.lit(MODEL_ROWS) >= F.lit(total))
    often = staged(often.join(model, "s", "left").select("s", F.coalesce("w", F.lit(0.0)).alias("w")), "url-often")
    near = pieces.join(F.broadcast(often), "s").groupBy("row_number").agg(F.sum("w").alias("w"))
    far = (pieces.join(F.broadcast(often), "s", "left_anti").join(model, "s")
           .groupBy("row_number").agg(F.sum("w").alias("w")))
    sums = near.union(far).groupBy("row_number").agg(F.sum("w").alias("total"))
    score = F.coalesce("total", F.lit(0.0)) / F.col("size") + F.lit(per_character)
    return numbered.join(sums, "row_number", "left").withColumn("score", score)


def calibrated(rows: list[tuple[float, int, int]]) -> float:
    """The threshold between two scores, from (score bin, allowed, blocked)
    counts, with the best mean of both kinds' shares right; of equals the middle."""
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not good or not bad:
        return 0.0
    rows = sorted(rows)
    best, at = -1.0, [0.0]
    passed_good, passed_bad = good, 0
    edges = [rows[0][0] - 1, *(r[0] for r in rows)]
    for k in range(len(edges)):
        if k:
            passed_good, passed_bad = passed_good - rows[k - 1][1], passed_bad + rows[k - 1][2]
        value = passed_good / good + passed_bad / bad
        low, high = edges[k], edges[k + 1] if k + 1 < len(edges) else edges[k] + 2
        if value > best + 1e-12:
            best, at = value, [(low + high) / 2]
        elif value > best - 1e-12:
            at.append((low + high) / 2)
    return at[len(at) // 2]


def fit(urls: DataFrame) -> tuple[DataFrame, int, float, float] | None:
    """(model, its rows, weight per character, threshold) from the urls that a
    rule decides; None unless both kinds are there."""
    text = F.concat("host", "path")
    known = (urls.where(F.col("ruled").isNotNull()).select(text.alias("text"), "ruled")
             .distinct()
             .select("text", (F.col("ruled") == "allow").cast("long").alias("ok"),
                     (spot(F.concat("text", F.lit("|split"))) * CALIBRATION < 1).alias("held")))
    known = staged(known, "url-known")
    if known.select("ok").distinct().count() < 2:
        return None
    model = learned(known.where(~F.col("held")).select("text", "ok"))
    rows = model.count()
    constant = model.where("s = ''").head()
    per_character = float(constant["w"]) if constant else 0.0
    model = model.where("s <> ''")
    scores = scored(known.where("held").select("text", "ok"), model, rows, per_character)
    bins = scores.groupBy(F.round(F.col("score") * BINS).alias("bin")).agg(
        F.sum("ok").alias("good"), F.sum(1 - F.col("ok")).alias("bad")).collect()
    threshold = calibrated([(r["bin"], r["good"], r["bad"]) for r in bins]) / BINS
    return model, rows, per_character, threshold


def filtered(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (null where a rule decides)."""
    urls = by_rule(parsed(pages, page_id, url), rules)
    model = fit(urls)
    ruled = urls.where(F.col("ruled").isNotNull()).select(
        "page_id", "host", "path", "rule", F.col("ruled").alias("verdict"), F.lit(None).cast("double").alias("score"))
    rest = urls.where(F.col("ruled").isNull()).select("page_id", "host", "path", "rule")
    if model is None:
        rest, threshold = rest.withColumn("score", F.lit(0.0)), 0.0
    else:
        table, rows, per_character, threshold = model
        rest = scored(rest.withColumn("text", F.concat("host", "path")), table, rows, per_character)
    verdict = F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block")
    return ruled.union(rest.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score"))


def log_likelihood(text: str, counts: dict[str, int]) -> float:
    """By definition, for tests: a text's log-likelihood under one model, from
    the counts of its kept substrings."""
    t, total = text + END, 0.0
    for i in range(len(t)):
        p = 1 / 256
        for m in range(min(i, ORDER) + 1):
            context = t[i - m:i]
            seen = sum(v for s, v in counts.items() if len(s) == m + 1 and s[:-1] == context)
            p = (counts.get(context + t[i], 0) + LAMBDA * p) / (seen + LAMBDA)
        total += math.log(p)
    return total
