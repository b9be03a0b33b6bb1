"""The most frequent n-grams, exactly, without shuffling every n-gram.

Nearly all n-grams of a corpus are rare, and grouping by them moves each of them.
Here three passes, all under numeric keys, leave the rare ones in their tasks:

1. the best grams of a sample of the texts are taken as candidates;
2. one pass counts the candidates, and all grams in cells of their key, in arrays of
   each task. The k-th best count of the candidates bounds the k-th best count of all
   grams from below; the count of a cell bounds each of its grams from above;
3. grams of the cells that reach the bound are counted one by one, with their strings.

The sample decides how much the third pass still counts, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.numeric import seeded_fraction
from ratewise.operators.gram_cells import KEY, cell_counts, gram_cells, grams_of_cells
from ratewise.operators.tfidf import tokenize
from ratewise.session import checkpointed

SAMPLE_SHARE, SAMPLE_TEXTS = 0.05, 200_000
# Cells of a variant: 4 x grams / bound, so that the mean cell is a quarter of the bound. A task holds 4 bytes for each.
LEAST_BITS, MOST_BITS = 12, 22
CELLS_PER_BOUND = 4
BROADCAST_CELLS = 2_000_000

_VARIANT = ("n", "stop_words_removed")


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each variant; Spark drops the others in each task before it gathers rows."""
    best = Window.partitionBy(*_VARIANT).orderBy(F.desc("df"), "term")
    return counts.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= k)


def _bits(grams: int, bound: float) -> int:
    wanted = math.ceil(math.log2(max(2.0, CELLS_PER_BOUND * grams / max(bound, 1.0))))
    return min(MOST_BITS, max(LEAST_BITS, wanted))


def frequent_terms(
    reviews: DataFrame,
    stop_words: Sequence[str],
    lengths: Sequence[int] = (1, 2, 3, 4),
    k: int = 1000,
    lemmas: DataFrame | None = None,
    sample_share: float = SAMPLE_SHARE,
    stages: dict | None = None,
) -> DataFrame:
    """(n, stop_words_removed, rank, term, df): the ``k`` grams in most texts, ties in alphabetical order.

    Texts without content have no grams; a variant with fewer than ``k`` grams
    gives all of them; an empty table gives no rows. Texts without id take part,
    though not in the sample. On the driver: 2k candidates a variant with their counts, and the cells at the bound
    while they are at most ``BROADCAST_CELLS``; beyond, all grams are joined with them.
    ``stages``, if given, receives the intermediate tables.
    """
    stops, n_texts = tuple(stop_words), reviews.count()
    share = min(sample_share, SAMPLE_TEXTS / max(n_texts, 1))
    tokens = tokenize(reviews, (), lemmas).select("tokens")
    sampled = reviews.where(seeded_fraction(F.col("id"), 7) < share)
    sample = checkpointed(tokenize(sampled, (), lemmas).select("tokens"))
    bits: dict[int, int] = {}
    candidates: dict[int, np.ndarray] = {}
    for n in lengths:
        for removed in (1, 0):
            seen = checkpointed(gram_cells(sample, [n], stops if removed else ()).groupBy(*KEY).agg(F.sum("n").alias("df")))
            best = seen.orderBy(F.desc("df"), *KEY).limit(2 * k).select("h1", "df").collect()
            if best:
                grams = seen.agg(F.sum("df")).first()[0]
                bits[2 * n + removed] = _bits(grams / share, best[: k][-1].df / share)
                candidates[2 * n + removed] = np.array([r.h1 for r in best], np.int64)

    counts = cell_counts(tokens, lengths, stops, bits, LEAST_BITS, candidates)
    counted = checkpointed(counts.groupBy("variant", "slot").agg(F.sum("df").alias("df")))
    met: dict[int, list[int]] = {}
    for r in counted.where(F.col("slot") < 0).collect():
        met.setdefault(r.variant, []).append(r.df)
    bounds = {variant: sorted(found, reverse=True)[k - 1] for variant, found in met.items() if len(found) >= k}
    bound = F.lit(1)
    for variant, value in bounds.items():
        bound = F.when(F.col("variant") == variant, F.lit(value)).otherwise(bound)

    reached = checkpointed(counted.where((F.col("slot") >= 0) & (F.col("df") >= bound)).select("variant", "slot"))
    if reached.count() <= BROADCAST_CELLS:
        held = reached.toArrow()
        variant, slot = (held.column(c).to_numpy() for c in ("variant", "slot"))
        cells = {int(v): slot[variant == v] for v in np.unique(variant)}
        grams = grams_of_cells(tokens, lengths, stops, bits, LEAST_BITS, cells)
    else:
        grams = grams_of_cells(tokens, lengths, stops, bits, LEAST_BITS, None).join(reached, ["variant", "slot"], "left_semi")
    rest = grams.groupBy("variant", *KEY).agg(F.sum("df").alias("df"), F.min("term").alias("term")).where(F.col("df") >= bound)
    tags = [F.expr("CAST(variant DIV 2 AS INT)").alias("n"), (F.col("variant") % 2 == 1).alias("stop_words_removed")]
    rest = checkpointed(rest.select(*tags, "term", "df"))
    if stages is not None:
        stages |= {"counted": counted, "reached": reached, "rest": rest, "bits": bits, "bounds": bounds}
    return _ranked(rest, k).select(*_VARIANT, "rank", "term", "df")
