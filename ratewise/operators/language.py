"""Language of a text by stop-word overlap."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.stopwords import LANGUAGES, stop_words
from ratewise.functions.text import word_tokens, wordpunct_tokens

UNKNOWN = "unknown"


def default_lists() -> dict[str, Sequence[str]]:
    return {language: stop_words(language) for language in LANGUAGES}


def _members(array: str, words: Sequence[str]) -> str:
    """SQL text for the entries of ``array`` that are in ``words``, a hashed set in Spark.

    As a lambda it stays out of the generated code, which fourteen set
    intersections would push past the size the JVM compiles.
    """
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return f"filter({array}, w -> w IN ({quoted}))"


def _tokens(entries: Sequence[str]) -> Column:
    """Lower-case tokens of ``content``; punctuation runs only if some list has one."""
    if any(re.fullmatch(r"[^\w\s]+", entry) for entry in entries):
        return wordpunct_tokens(F.col("content"))
    return word_tokens(F.lower("content"))


def detect_language(
    reviews: DataFrame, lists: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Add ``language`` and ``n_hits``: the list sharing most distinct tokens with the text.

    Ties go to the first name in the alphabet, no hit at all to ``'unknown'``.
    The lists are literals of fixed size, so this is one pass without a shuffle.
    """
    lists = lists or default_lists()
    names = sorted(lists)
    every = sorted({w for words in lists.values() for w in words})
    hits = {f"_hits_{name}": F.size(F.expr(_members("_words", lists[name]))) for name in names}
    # Most tokens are in no list: one pass drops them before the lists are tried.
    distinct = reviews.withColumn("_words", F.array_distinct(_tokens(every)))
    counted = distinct.withColumn("_words", F.expr(_members("_words", every))).withColumns(hits)
    best = counted.withColumn("n_hits", F.greatest(*hits) if len(hits) > 1 else F.col(next(iter(hits))))
    language = F.when(F.col("n_hits") == 0, UNKNOWN)
    for name in names:
        language = language.when(F.col(f"_hits_{name}") == F.col("n_hits"), name)
    return best.withColumn("language", language).drop("_words", *hits)


def stop_word_table(
    spark: SparkSession, lists: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """The lists as rows (language, token)."""
    rows = [(name, word) for name, words in (lists or default_lists()).items() for word in words]
    return spark.createDataFrame(rows, "language string, token string")


def stop_word_overlap(reviews: DataFrame, lists: DataFrame) -> DataFrame:
    """Distinct tokens shared by each text and each list (texts without a hit are absent).

    The join is a broadcast of the fixed lists; partial aggregation leaves at
    most one row per text and language before the shuffle.
    """
    words = reviews.select(
        "id", F.explode_outer(F.array_distinct(wordpunct_tokens(F.col("content")))).alias("token")
    )
    return (
        words.join(F.broadcast(lists), "token")
        .groupBy("id", "language")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def language_counts(detected: DataFrame) -> DataFrame:
    return (
        detected.groupBy("language")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.desc("language"))
    )
