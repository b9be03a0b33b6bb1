"""Tokens and n-grams as Spark array expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: Unicode word characters, and those plus runs of punctuation.
# Java's \w alone is ASCII.
WORD = r"[\p{L}\p{N}_]+"
WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"


def word_count(content: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.size(F.regexp_extract_all(content, F.lit(r"(\S+)"), F.lit(0)))


def word_tokens(content: Column) -> Column:
    return F.regexp_extract_all(content, F.lit(WORD), F.lit(0))


def wordpunct_tokens(content: Column) -> Column:
    return F.regexp_extract_all(F.lower(content), F.lit(WORD_OR_PUNCT), F.lit(0))


def without(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens in order, those in ``words`` left out."""
    return F.filter(tokens, lambda t: ~t.isin(list(words))) if words else tokens


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined runs of ``n`` tokens; empty when there are fewer.

    The shifted arrays are arguments of ``zip_with``. A lambda that indexed into
    ``tokens`` would recompute it per element once the optimiser inlines it.
    """
    if n not in range(1, 10):
        raise ValueError("the length of an n-gram must be 1 to 9")
    length = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    grams = F.slice(tokens, F.lit(1), length) if n > 1 else tokens
    for k in range(2, n + 1):
        grams = F.zip_with(
            grams, F.slice(tokens, F.lit(k), length), lambda head, t: F.concat_ws(" ", head, t)
        )
    return grams


def ngram_range(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams for n from ``lo`` to ``hi`` in one array."""
    grams = [ngrams(tokens, n) for n in range(lo, hi + 1)]
    return grams[0] if len(grams) == 1 else F.concat(*grams)

