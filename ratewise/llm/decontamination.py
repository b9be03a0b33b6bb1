"""Benchmark passages in training documents, found by winnowing.

Both sides are cut into words of letters and digits. Of every ``span`` words the
hash of one k-gram is kept, the smallest (the last among equals), so a span of
words that both sides hold yields the same k-gram on both. Documents keep the
fingerprints that a Bloom filter of the benchmark's lets through, each with the
few words around it; an equi-join on the fingerprint then meets the benchmark's
spans, and a hit counts only if all words of the span are equal. Items of fewer
than ``span`` words are one span of their own length, with the hash of all of
it as fingerprint. Any shared span of at least ``span`` words is found.

Defined results: a null or empty text has no words and no hits; an item without
words is never found; items with equal words are all reported; each row is a
document of its own, also if rows repeat; empty tables give no hits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewise.llm import bloom
from ratewise.llm import kernels as K
from ratewise.llm.sizes import ids_for_join, text_key
from ratewise.session import checkpointed

_BENCH_BITS = 24  # 2 MB, whatever the benchmark's size


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Per window of consecutive k-grams, the position of the smallest, the last among equals."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(grams[::-1], window).argmin(axis=1)
    from_end = view + np.arange(len(view))
    return (len(grams) - 1 - from_end)[::-1]


def _words_of(data, starts, ends, a, b):
    raw = data.tobytes()
    return [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[a:b], ends[a:b])]


def benchmark_spans(benchmark: DataFrame, span: int, k: int) -> DataFrame:
    """(item_id, fp, length, at, words): every span of every item; its fingerprint starts at word ``at``."""

    def run(batch):
        out = {"spans": []}
        for text in K.text_bytes(batch.column("text")):
            data, starts, ends = K.alnum_words(text)
            hashes, n, spans = K.byte_hashes(data, starts, ends), len(starts), []
            if 0 < n < span:
                fp = int(K.signed(K.gram_hashes(hashes, n))[0])
                spans.append({"fp": fp, "length": n, "at": 0, "words": _words_of(data, starts, ends, 0, n)})
            elif n:
                grams = K.gram_hashes(hashes, k)
                words = _words_of(data, starts, ends, 0, n)
                for i, p in enumerate(winnowed(grams, span - k + 1)):
                    spans.append({"fp": int(K.signed(grams[p : p + 1])[0]), "length": span, "at": int(p) - i, "words": words[i : i + span]})
            out["spans"].append(spans)
        return out

    spans = K.map_batches(
        benchmark.select("item_id", "text"), run, "spans array<struct<fp: long, length: int, at: int, words: array<string>>>", ("item_id",)
    )
    return spans.select("item_id", F.inline("spans"))


def _candidates(docs: DataFrame, known: bloom.Filter, short: tuple[int, ...], span: int, k: int) -> DataFrame:
    """(row, doc_id, text_key, n_words, found): per document its fingerprints that the benchmark may have.

    ``found`` holds fingerprint, length (``span`` for winnowed ones), the word
    position ``start`` of the first word of ``words``, and the fingerprint's
    position ``at`` in it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)
    around = span - k

    def run(batch):
        counts, found = [], []
        for text in K.text_bytes(batch.column("text")):
            data, starts, ends = K.alnum_words(text)
            hashes, n, hits = K.byte_hashes(data, starts, ends), len(starts), []

            def add(fps, positions, length, left, width):
                keep = shared.value.has(fps)
                for fp, p in zip(K.signed(fps[keep]).tolist(), positions[keep].tolist()):
                    a, b = max(0, p - left), min(n, p + width)
                    hits.append({"fp": fp, "length": length, "start": a, "at": p - a, "words": _words_of(data, starts, ends, a, b)})

            if n >= span:
                grams = K.gram_hashes(hashes, k)
                chosen = np.unique(winnowed(grams, span - k + 1))
                add(grams[chosen], chosen, span, around, span)
            for length in short:
                grams = K.gram_hashes(hashes, length)
                add(grams, np.arange(len(grams)), length, 0, length)
            counts.append(n)
            found.append(hits)
        return {"n_words": counts, "found": found}

    made = K.map_batches(
        docs.select("doc_id", "text", text_key().alias("text_key")),
        run,
        "n_words long, found array<struct<fp: long, length: int, start: int, at: int, words: array<string>>>",
        ("doc_id", "text_key"),
        rows=256,
    )
    return made.withColumn("row", F.monotonically_increasing_id())


def hits(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5, filter_bits: int = _BENCH_BITS) -> DataFrame:
    """(row, doc_id, text_key, n_words, spans, items): per document the hit spans [start, length] and the items found."""
    spans = checkpointed(benchmark_spans(benchmark, span, k))
    short = tuple(sorted(r.length for r in spans.where(F.col("length") < span).select("length").distinct().collect()))
    known = bloom.build(spans.select(F.array("fp").alias("fps")), "fps", filter_bits, "once")
    rows = checkpointed(_candidates(docs, known, short, span, k))

    distinct = spans.groupBy("fp", "length", "at", "words").agg(F.count(F.lit(1)).alias("_n"))
    distinct = distinct.select(
        F.col("fp").alias("_fp"), F.col("length").alias("_length"), F.col("at").alias("_at"), F.col("words").alias("_words")
    )
    offset = F.col("at") - F.col("_at")
    matched = (
        rows.select("row", F.inline("found"))
        .join(distinct, (F.col("fp") == F.col("_fp")) & (F.col("length") == F.col("_length")))
        .where((offset >= 0) & (F.slice("words", F.greatest(offset, F.lit(0)) + 1, F.col("length")) == F.col("_words")))
        .select("row", (F.col("start") + offset).alias("start"), "length", F.col("_words").alias("words"))
    )
    matched = checkpointed(matched)
    covered = matched.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    items = (
        matched.select("row", "words")
        .distinct()
        .join(spans.select("item_id", "words").distinct(), "words")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    found = covered.join(items, "row")
    none = F.array().cast("array<struct<start:int,length:int>>")
    return rows.select("row", "doc_id", "text_key", "n_words").join(found, "row", "left").select(
        "row",
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def covered_words(spans) -> Column:
    """Number of words in the union of spans sorted by start."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def step(acc, s):
        end = s["start"] + s["length"]
        return F.struct(
            (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], s["start"]))).alias("n"),
            F.greatest(acc["end"], end).alias("end"),
        )

    return F.aggregate(spans, start, step)["n"].cast("long")


def scan(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) of every document."""
    found = hits(docs, benchmark, span, k, **options)
    return found.select(
        "doc_id", "n_words", covered_words(F.col("spans")).alias("n_hit"), "items", (F.size("items") > 0).alias("contaminated")
    )


def clean(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5, **options) -> DataFrame:
    """The documents without a hit, with all their columns; each row is judged by its own text."""
    found = hits(docs, benchmark, span, k, **options).where(F.size("items") > 0)
    bad = ids_for_join(found.select(F.col("doc_id").alias("_bad"), F.col("text_key").alias("_bad_text")).distinct())
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("_bad")) & (text_key() == F.col("_bad_text")), "left_anti")
