"""Language identification by compression.

Each learned language has a raw-content zstandard dictionary made of excerpts
of its training rows.  A text is cut into chunks, each chunk is compressed
with every dictionary, and the language with the fewest bytes in total wins.
The margin is the relative gap to the second language; texts under a
calibrated margin are marked as rejected.

Defined cases: a null text, an empty text and a text without a letter get
``und`` with score 0 and are rejected; a tie goes to the language first by code
point, with margin 0; with one learned language its margin is 1; with none
(no training rows) every text is ``und``.  Repeated rows get equal answers.
Texts of any length are compressed whole, chunk by chunk.  Other columns of
the input pass through untouched unless an output column has their name.
"""

from __future__ import annotations

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clipmart.llm.common import free_name, small_batches, staged

#: Training bounds: excerpts per language and their length in characters.  All
#: other rows set the margin, so a rare language leaves a share of its texts to it.
EXCERPTS, EXCERPT_CHARS, EXCERPT_SHARE = 400, 120, 0.75
BINS = 100_000  # score bins that calibration counts in
BROADCAST_LANGUAGES = 100_000  # one row each
CHUNK = 1024  # characters compressed at once: short enough for the dictionary to matter in each
LEVEL, MIN_MATCH = 8, 4
FLOOR = 0.001  # a margin under this is always narrow
WRONG_COST = 5  # a wrong answer that stays costs as much as so many right ones that go
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Languages in code-point order, their dictionaries and the least margin."""

    dictionaries: dict[str, bytes]
    margin: float = FLOOR


def held_out(doc_id) -> F.Column:
    """True for the documents that no model may learn from: crc32 of the id as
    text leaves 2 modulo 4.  A null id gives false and isn't learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from the rows that aren't held out and have an id, a text and a
    language.  Per language the ``EXCERPTS`` different texts with the smallest
    hashes, at most ``EXCERPT_SHARE`` of all, give one excerpt each; all rows
    with other texts set the margin."""
    key, body, name = (F.col(f"`{c}`") for c in (doc_id, text, lang))
    labelled = docs.where(key.isNotNull() & body.isNotNull() & name.isNotNull() & ~held_out(key))
    rows = (labelled.select(key.alias("k"), name.alias("l"), F.xxhash64(body).alias("h"))
            .groupBy("l", "h").agg(F.min("k").alias("k")))
    rows = staged(rows, "language-hashes")
    # a window over a few times the wanted rows only, however common the language is
    most = F.least(F.lit(EXCERPTS), F.ceil(F.count("*") * F.lit(EXCERPT_SHARE)))
    share = staged(rows.groupBy("l").agg(F.least(F.lit(1.0), F.lit(4.0 * EXCERPTS) / F.count("*")).alias("share"),
                                         most.alias("want")), "language-shares")
    share = F.broadcast(share) if share.count() <= BROADCAST_LANGUAGES else share
    low = F.col("h").cast("double") / F.lit(2.0**64) + 0.5 <= F.col("share")
    few = (rows.join(share, "l").where(low)
           .withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy("h")))
           .where(F.col("n") <= F.col("want")).select("l", "h", "k", "n"))
    few = staged(few, "language-few")
    texts = docs.where(body.isNotNull()).select(key.alias("k"), body.alias("t"), F.xxhash64(body).alias("h"))
    found = (texts.join(F.broadcast(few), ["k", "h"])  # EXCERPTS rows a language
             .groupBy("l", "n").agg(F.min("t").alias("t")))
    room = F.greatest(F.length("t") - EXCERPT_CHARS, F.lit(0)) + 1
    at = (F.pmod(F.xxhash64("t", F.lit(1)), room) + 1).cast("int")
    train = found.select("l", "n", F.col("t").substr(at, F.lit(EXCERPT_CHARS)).alias("t"))
    sample: dict[str, list[str]] = {}
    for r in sorted(train.collect()):
        sample.setdefault(r["l"], []).append(normal(r["t"]))
    model = LanguageModel({k: "\n".join(sample[k]).encode("utf-8", "replace") for k in sorted(sample)})
    if len(model.dictionaries) > 1:
        used = F.broadcast(few.select(F.col("h").alias("used")))
        rest = labelled.select(name.alias("l"), body.alias("t")).join(used, F.xxhash64("t") == F.col("used"), "left_anti")
        model.margin = calibrated(predict(rest, model, text="t", keep=["l"]))
    return model


def calibrated(seen: DataFrame) -> float:
    """The margin from all predicted rows with their label ``l``, counted in
    bins; a bin stands for its largest score."""
    right = (F.col("lang_pred") == F.col("l")).cast("long")
    bins = (seen.where(F.col("lang_pred") != UNKNOWN).groupBy(F.floor(F.col("score") * BINS).alias("bin"))
            .agg(F.max("score").alias("score"), F.sum(right).alias("right"), F.sum(1 - right).alias("wrong")).collect())
    return narrowest([a for r in bins for a in ((r["score"], True, r["right"]), (r["score"], False, r["wrong"]))])


def narrowest(answers: list[tuple]) -> float:
    """The margin below which answers are rejected: the one that keeps the most
    right answers, each wrong one kept counting ``WRONG_COST`` times.  An answer
    is (score, right) or, for several of a score, (score, right, number)."""
    best, margin, value = 0, 0.0, 0
    gains: dict[float, int] = {}
    for score, right, *n in answers:
        gains[score] = gains.get(score, 0) + (-1 if right else WRONG_COST) * (n[0] if n else 1)
    for score in sorted(gains):  # raise the margin past one score after the other
        value += gains[score]
        if value > best:
            best, margin = value, score + 1e-9
    return max(margin, FLOOR)


def normal(text: str) -> str:
    return text.lower()


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``lang_pred``, ``score`` (the
    margin, 0 to 1) and ``rejected``.  Python tasks see the text only."""
    passing = [c for c in (docs.columns if keep is None else keep)
               if c.lower() not in ("lang_pred", "score", "rejected")]
    small_batches(docs.sparkSession)
    answer = free_name(docs.columns, "answer")
    udf = F.pandas_udf(classifier(model.dictionaries), T.StructType([
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    out = docs.select(*(F.col(f"`{c}`") for c in passing), udf(F.col(f"`{text}`")).alias(answer))
    return out.select(
        *(F.col(f"`{c}`") for c in passing), F.col(answer)["lang_pred"].alias("lang_pred"),
        F.col(answer)["score"].alias("score"),
        ((F.col(answer)["lang_pred"] == UNKNOWN) | (F.col(answer)["score"] < model.margin)).alias("rejected"))


def classifier(dictionaries: dict[str, bytes]):
    """The function that tasks run on a batch of texts."""
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import zstandard as z

        names = sorted(dictionaries)
        packers = []
        for n in names:
            d = z.ZstdCompressionDict(dictionaries[n], dict_type=z.DICT_TYPE_RAWCONTENT)
            how = z.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(dictionaries[n]), source_size=CHUNK, min_match=MIN_MATCH,
                write_checksum=0, write_content_size=0, write_dict_id=0)
            d.precompute_compress(compression_params=how)
            packers.append(z.ZstdCompressor(dict_data=d, compression_params=how).compress)

        def one(text):
            if not names or text is None or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0
            t = normal(text)
            parts = [t[i:i + CHUNK].encode("utf-8", "replace") for i in range(0, len(t), CHUNK)]
            sizes = [sum(len(pack(p)) for p in parts) for pack in packers]
            if len(sizes) == 1:
                return names[0], 1.0
            least, second = sorted(sizes)[:2]
            return names[sizes.index(least)], (second - least) / second

        for texts in batches:
            yield pd.DataFrame([one(t if isinstance(t, str) else None) for t in texts], columns=["lang_pred", "score"])

    return classify
