"""Text helpers used by search and fixtures: tokens and keyword lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a lower-cased run of letters or digits.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
# A keyword candidate is a run of at least five letters.
KEYWORD_PATTERN = r"\p{L}{5,}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    """array of lower-cased letter/digit runs; empty array for NULL text."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def keywords(text) -> Column:
    """The distinct lower-case words of five or more letters, in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(_c(text), F.lit(""))), F.lit(KEYWORD_PATTERN), 0)
    return F.array_distinct(words)


def normalised_theme(theme) -> Column:
    """Case, space and plural folding used by the vocabulary drift report."""
    t = F.regexp_replace(F.lower(F.trim(_c(theme))), r"[\s_\-]+", " ")
    return F.regexp_replace(t, r"([a-z]{3})s$", "$1")
