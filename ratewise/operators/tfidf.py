"""TF-IDF in long form and the corpus reports built on it.

Two passes over the texts: the first counts document frequencies (partial sums
before the shuffle, so frequent terms cost nothing), the second weighs. The
vocabulary is written once between them; its size decides how it is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewise.functions.numeric import seeded_fraction
from ratewise.functions.text import ngram_range, ngrams, without, word_tokens
from ratewise.operators.gram_cells import (
    KEY,
    MOST_SLOT_BITS,
    TASK_BYTES,
    WHOLE,
    dealt,
    frequent_counts,
    gram_cells,
    packed_cells,
    reached_slots,
    term_keys,
    text_counts,
    text_size,
    text_tasks,
    weighed_cells,
    with_terms,
)
from ratewise.operators.joins import BROADCAST_ROWS, fits_broadcast, lookup_join
from ratewise.operators.lemmas import lemmatize
from ratewise.operators.ordering import with_position
from ratewise.session import checkpointed

#: Texts whose n-grams give the first guess at the bounds of the rank curves.
SAMPLE_SHARE, SAMPLE_TEXTS = 0.05, 200_000
#: Norms of so many texts are broadcast, 16 bytes each.
BROADCAST_TEXTS = 8_000_000
#: Terms that go to every executor as numbers, 40 bytes each.
BROADCAST_TERMS = 1_000_000
#: Bytes of text from which on a pass of its own tells most rare n-grams before they are counted.
PRUNE_BYTES = 64 << 20


@dataclass(frozen=True)
class TermSpec:
    """Which terms a text is made of and which of them are kept.

    ``min_df`` and ``max_df`` are shares of the documents.
    """

    lo: int = 1
    hi: int = 1
    min_df: float = 0.0
    max_df: float = 1.0
    stop_words: Sequence[str] = ()


def tokenize(
    reviews: DataFrame, stop_words: Sequence[str] = (), lemmas: DataFrame | None = None
) -> DataFrame:
    """Replace ``content`` by ``tokens``: lower-cased words, lemmatised, stop words left out."""
    tokens = reviews.withColumn("tokens", word_tokens(F.lower("content"))).drop("content")
    if lemmas is not None:
        tokens = lemmatize(tokens, lemmas)
    return tokens.withColumn("tokens", without(F.col("tokens"), stop_words)) if stop_words else tokens


def _grams(reviews: DataFrame, spec: TermSpec, lemmas: DataFrame | None) -> DataFrame:
    tokens = tokenize(reviews, spec.stop_words, lemmas)
    return tokens.withColumn("_grams", ngram_range(F.col("tokens"), spec.lo, spec.hi)).drop("tokens")


def _exploded(df: DataFrame, array: Column) -> DataFrame:
    # The outer form, because for the plain one the optimiser adds a filter on
    # the array and computes the whole array a second time for it.
    others = [c for c in df.columns if c != "_grams"]
    return df.select(*others, F.explode_outer(array).alias("term")).where(F.col("term").isNotNull())


def term_counts(
    reviews: DataFrame, spec: TermSpec = TermSpec(), lemmas: DataFrame | None = None
) -> DataFrame:
    """(id, other columns, term, tf). Texts are co-located by id while they are
    whole, so counting the exploded terms, and any later grouping by id, needs no
    further shuffle. A task gets the same share of the texts however many there are.
    """
    exploded = _exploded_texts(reviews, spec, lemmas)
    return exploded.groupBy(*exploded.columns).agg(F.count(F.lit(1)).alias("tf"))


def _exploded_texts(reviews: DataFrame, spec: TermSpec, lemmas: DataFrame | None) -> DataFrame:
    _, tasks = text_tasks(reviews)
    grams = _grams(dealt(reviews, tasks), spec, lemmas)
    # Lemmas may have moved the texts.
    return _exploded(grams if lemmas is None else dealt(grams, tasks), F.col("_grams"))


def idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs + 1) / (df + 1)) + 1


def document_frequency(
    reviews: DataFrame, spec: TermSpec = TermSpec(), lemmas: DataFrame | None = None
) -> DataFrame:
    """(term, df, df_ratio, idf) of the terms within the document-frequency limits.

    Each text emits its distinct terms; partial sums leave one row per term and
    task before the shuffle.
    """
    counted = _counted(reviews, spec, lemmas)
    return counted.where(~F.col("_frequent")).drop("_frequent")


def _counted(reviews: DataFrame, spec: TermSpec, lemmas: DataFrame | None) -> DataFrame:
    """Document frequencies from ``min_df`` on; ``_frequent`` marks the terms above ``max_df``.

    With a lower limit most terms do not stay. They are counted under numeric
    keys, and the keys that stay are looked up as strings. Beyond PRUNE_BYTES the texts
    stay where they are and go to no more tasks than there are cores: what a task shuffles
    is then bounded by the slots of ``reached_slots`` and by the keys that stay, not by its texts.
    """
    n_texts, size = text_size(reviews)
    cores = reviews.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, -(-size // TASK_BYTES))
    texts = reviews.select(*[c for c in ("id", "content") if c in reviews.columns])
    total = F.lit(n_texts)
    if spec.min_df > 0:
        lengths = range(spec.lo, spec.hi + 1)
        least = spec.min_df * n_texts
        if lemmas is None and size > PRUNE_BYTES and least > 1:
            texts = texts.select("content").coalesce(cores)
            tokens = tokenize(texts).select("tokens")
            # Eight times the slots that would hold ``least`` n-grams each.
            bits = int(np.ceil(np.log2(max(8 * len(lengths) * size / 6 / least, 1 << 12))))
            reached = reached_slots(tokens, lengths, spec.stop_words, least, min(bits, MOST_SLOT_BITS))
        else:
            tokens, reached = tokenize(dealt(texts, tasks), (), lemmas).select("tokens"), None
        cells = text_counts(tokens, lengths, spec.stop_words, reached)
        counts = cells.groupBy(*KEY).agg(F.sum("n").alias("df")).where(F.col("df") >= spec.min_df * total)
        # Where a text lies does not matter to its strings: they are read from the texts as they came.
        read = tokenize(texts, (), lemmas).select("tokens") if lemmas is None else tokens
        counted = with_terms(checkpointed(counts), read, lengths, spec.stop_words)
    else:
        grams = _grams(dealt(texts, tasks), spec, lemmas).select("_grams")
        counted = _exploded(grams, F.array_distinct("_grams")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counted.select(
        (F.col("df") > spec.max_df * total).alias("_frequent"),
        "term",
        "df",
        (F.col("df") / total).alias("df_ratio"),
        idf(total, F.col("df")).alias("idf"),
    )


def vocabulary(frequency: DataFrame) -> DataFrame:
    """Add ``idx``: 0-based position of the term in alphabetical order."""
    return with_position(frequency, ["term"], "idx", start=0)


def weigh(
    reviews: DataFrame,
    spec: TermSpec,
    frequency: DataFrame,
    lemmas: DataFrame | None = None,
    frequent: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """TF-IDF cells with rows of norm 1; terms outside ``frequency`` are dropped.

    ``frequency`` must be materialised. While it is small enough to broadcast,
    other terms are dropped before they are counted, and the norm is taken where the terms were counted; otherwise the cells go
    through one shuffle by term and one by id. ``frequent``, the terms above
    ``max_df``, are dropped before that shuffle: they are its hottest keys, and
    at most (mean distinct terms per text) / ``max_df`` of them exist.
    """
    if fits_broadcast(frequency, "term", broadcast_rows):
        known = [c for c in frequency.columns if c != "term"]
        found = _exploded_texts(reviews, spec, lemmas).join(F.broadcast(frequency), "term")
        keys = [c for c in found.columns if c not in known]
        cells = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("tf"), *[F.first(c).alias(c) for c in known])
    else:
        counts = term_counts(reviews, spec, lemmas)
        cells = lookup_join(counts, frequency, "term", "df", broadcast_rows, absent=frequent)
    raw = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy("id")))
    return cells.withColumn("value", raw / norm)


def weigh_indexed(reviews: DataFrame, spec: TermSpec, index: DataFrame, most_terms: int = BROADCAST_TERMS) -> DataFrame | None:
    """(id, idx, value, scale) as ``weigh`` gives it for a materialised ``index`` (term, idf, idx, scale); None beyond ``most_terms`` terms.

    The keys of the terms go to every executor as numbers, and a task finds and counts them in its
    texts, so that no n-gram is made a string or shuffled.
    """
    if index.count() > most_terms:
        return None
    keyed = term_keys(index.select("idx", "idf", "scale", "term")).toArrow()
    _, tasks = text_tasks(reviews)
    tokens = tokenize(dealt(reviews.select("id", "content"), tasks))
    return weighed_cells(tokens, range(spec.lo, spec.hi + 1), spec.stop_words, keyed)


def pack_indexed(
    reviews: DataFrame, spec: TermSpec, index: DataFrame, start: int, weight: float, others: DataFrame | None, most_terms: int = BROADCAST_TERMS
) -> DataFrame | None:
    """(id, idx, value), one row of arrays for each id: the cells of ``weigh_indexed`` with idx from ``start`` on, times ``weight`` by
    scale, and the cells ``others`` (id, idx, value). None beyond ``most_terms`` terms.

    The other cells travel with the texts, so that the cells of the n-grams are not shuffled.
    """
    if index.count() > most_terms:
        return None
    keyed = term_keys(index.select("idx", "idf", "scale", "term")).toArrow()
    _, tasks = text_tasks(reviews)
    none = [F.lit(None).cast(kind).alias(c) for c, kind in (("idx", "long"), ("value", "double"))]
    rows = reviews.select("id", "content", *none)
    if others is not None:
        rows = rows.unionByName(others.select("id", F.lit(None).cast("string").alias("content"), "idx", "value"))
    return packed_cells(tokenize(dealt(rows, tasks)), range(spec.lo, spec.hi + 1), spec.stop_words, keyed, start, weight)


def fit_frequency(
    reviews: DataFrame, spec: TermSpec, lemmas: DataFrame | None = None
) -> DataFrame:
    """Document frequencies of a corpus, written once."""
    return checkpointed(document_frequency(reviews, spec, lemmas))


def fit_terms(
    reviews: DataFrame, spec: TermSpec, lemmas: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Document frequencies within the limits, and the terms above ``max_df``; written once."""
    counted = checkpointed(_counted(reviews, spec, lemmas))
    return counted.where(~F.col("_frequent")).drop("_frequent"), counted.where("_frequent").select("term")


def tfidf(reviews: DataFrame, spec: TermSpec, lemmas: DataFrame | None = None) -> DataFrame:
    """(id, other columns, term, tf, df, df_ratio, idf, value) of one corpus."""
    frequency, frequent = fit_terms(reviews, spec, lemmas)
    return weigh(reviews, spec, frequency, lemmas, frequent)


# --- reports ------------------------------------------------------------------------


def term_scores(cells: DataFrame) -> DataFrame:
    """Per term: corpus score (sum of TF-IDF over vocabulary size) and rating product.

    The product is the sum of (rating - 3) x TF-IDF over the texts. Sums of
    doubles depend on their order, so both are rounded before anything is ranked.
    """
    sums = cells.groupBy("term").agg(
        F.sum("value").alias("_sum"),
        F.sum((F.col("rating") - 3) * F.col("value")).alias("_product"),
        F.first("idf").alias("idf"),
        F.first("df").alias("df"),
    )
    return sums.withColumn("rating_product", F.round("_product", 9)).drop("_product")


def top_terms(scores: DataFrame, vocabulary_size: Column, k: int = 5) -> DataFrame:
    """The ``k`` highest corpus scores with score / idf and idf."""
    scored = scores.select("term", "idf", F.round(F.col("_sum") / vocabulary_size, 12).alias("tfidf"))
    return scored.orderBy(F.desc("tfidf"), F.desc("term")).limit(k).select(
        "tfidf", (F.col("tfidf") / F.col("idf")).alias("tf"), "idf", "term"
    )


def associated_terms(scores: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` highest and the ``k`` lowest rating products, numbered outwards-in."""
    pairs = scores.select("rating_product", "term")

    def side(name: str, *order: Column) -> DataFrame:
        number = F.row_number().over(Window.orderBy(*order)).cast("bigint")
        return pairs.orderBy(*order).limit(k).select(
            F.lit(name).alias("side"), number.alias("rank"), "rating_product", "term"
        )

    highest = side("highest", F.desc("rating_product"), F.desc("term"))
    lowest = side("lowest", F.asc("rating_product"), F.asc("term"))
    return highest.unionByName(lowest)


def _best_rows(k: int, slack: float):
    """Rows of a task that are among its ``k`` best or tie with them, and one row that counts all.

    Scores within ``slack`` may become one when they are rounded. Null products come last, as in the reports.
    """

    def run(batches):
        held, seen = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            seen += batch.num_rows
            table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            chosen = np.zeros(table.num_rows, bool)
            product = table.column("rating_product").to_numpy()
            product = np.where(np.isnan(product), -np.inf, product)
            for value, near in ((table.column("_sum").to_numpy(), slack), (product, 0.0), (-product, 0.0)):
                chosen |= value >= np.partition(value, -min(k, len(value)))[-min(k, len(value))] - near
            held = table.filter(pa.array(chosen))
        if held is not None:
            yield from held.to_batches()
            first = held.slice(0, 1).to_pydict() | {"df": [-seen]}
            yield pa.RecordBatch.from_pydict(first, schema=held.schema)

    return run


def report_scores(
    reviews: DataFrame,
    n: int,
    stop_words: Sequence[str] = (),
    lemmas: DataFrame | None = None,
    k: int = 5,
    broadcast_texts: int = BROADCAST_TEXTS,
) -> tuple[DataFrame, int]:
    """``term_scores`` of the n-grams that can be among the ``k`` best of a report, and the number of n-grams.

    The counts of n-grams in texts are shuffled once, under numeric keys. Where
    all texts with an n-gram have met, its document frequency is known. It goes
    back to the texts, which need it for their norms, only where it is above 1:
    a text takes its n-grams for rare ones at first. A score is then the idf
    times a sum of tf / norm, made from the same shuffle. Each task leaves its best n-grams
    and their ties, and only these are looked up as strings.

    The norms are broadcast up to ``broadcast_texts`` texts, else joined. Texts without id count as one, as
    they do in ``term_counts``.
    """
    others = [c for c in reviews.columns if c != "content"]
    n_texts, tasks = text_tasks(reviews)
    tokens = tokenize(dealt(reviews, tasks), (), lemmas)
    if lemmas is not None:
        tokens = dealt(tokens, tasks)
    marked = tokens.withColumn("h1", F.xxhash64(*others))
    cells = gram_cells(marked, [n], stop_words, whole=True).repartition(tasks, *KEY)

    total = F.lit(n_texts)
    rare = idf(total, F.lit(1))
    merged = cells.groupBy(*KEY, *others).agg(
        F.sum("tf").alias("tf"), F.sum(F.col("tf") * F.col("tf")).alias("_squares"), F.sum("n").alias("n")
    )
    known = merged.withColumn("df", F.sum("n").over(Window.partitionBy(*KEY)))
    weight = F.pow(idf(total, F.col("df")), F.lit(2))
    missing = F.col("tf") * F.col("tf") * weight - F.col("_squares") * rare * rare
    whole = F.col("h2") == WHOLE
    norms = (
        known.where(whole | (F.col("df") > 1))
        .groupBy(F.col("id").alias("_id"))
        .agg(F.sqrt(F.sum(F.when(whole, F.col("tf") * rare * rare).otherwise(missing))).alias("_norm"))
    )
    if n_texts <= broadcast_texts:
        norms = F.broadcast(norms)
    part = F.col("tf") / F.col("_norm")
    # Rows of whole texts leave after the sums: a filter before them would make the shuffle another one.
    sums = (
        cells.join(norms, F.col("id").eqNullSafe(F.col("_id")))
        .groupBy(*KEY)
        .agg(
            F.sum("n").alias("df"),
            F.sum(part).alias("_part"),
            F.sum((F.col("rating") - 3) * part).alias("_product"),
            F.max("h2").alias("_kind"),
        )
        .where(F.col("_kind") != WHOLE)
    )
    weighed = sums.withColumn("idf", idf(total, F.col("df"))).select(
        *KEY,
        "df",
        "idf",
        (F.col("idf") * F.col("_part")).alias("_sum"),
        F.round(F.col("idf") * F.col("_product"), 9).alias("rating_product"),
    )
    # A score is rounded to 12 digits after it is divided by the number of n-grams, which is below that of bytes.
    best = checkpointed(weighed.mapInArrow(_best_rows(k, 1e-12 * tasks * TASK_BYTES), weighed.schema))
    size = -(best.where(F.col("df") < 0).agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0])
    best = best.where(F.col("df") > 0)
    # Where a text lies does not matter to its strings: they are read from the texts as they came.
    read = tokenize(reviews, (), lemmas) if lemmas is None else marked
    return checkpointed(with_terms(best, read.select("tokens"), [n], stop_words)), size


def corpus_report(
    reviews: DataFrame,
    stop_words: Sequence[str],
    lengths: Sequence[int] = (1, 2, 3, 4),
    k: int = 5,
    lemmas: DataFrame | None = None,
    removal: Sequence[bool] = (True, False),
) -> tuple[DataFrame, DataFrame]:
    """Top-term and association reports for each n, with and without stop-word removal."""
    tops, associations = [], []
    for n in lengths:
        for removed in removal:
            scores, size = report_scores(reviews, n, tuple(stop_words) if removed else (), lemmas, k)
            tag = {"n": F.lit(n), "stop_words_removed": F.lit(removed)}
            tops.append(top_terms(scores, F.lit(size), k).withColumns(tag))
            associations.append(associated_terms(scores, k).withColumns(tag))
    return _union(tops), _union(associations)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def tagged_grams(
    reviews: DataFrame, stop_words: Sequence[str], lengths: Sequence[int], lemmas: DataFrame | None = None
) -> DataFrame:
    """(n, stop_words_removed, term): the distinct grams of each text, for each n, with and without stop words."""
    everything = tokenize(reviews, (), lemmas).select("tokens")
    both = everything.withColumn("_kept", without(F.col("tokens"), stop_words))
    grams = F.array(
        *[
            F.struct(
                F.lit(n).alias("n"),
                F.lit(removed).alias("stop_words_removed"),
                F.array_distinct(ngrams(F.col(source), n)).alias("grams"),
            )
            for n in lengths
            for source, removed in (("_kept", True), ("tokens", False))
        ]
    )
    return (
        both.select(F.inline_outer(grams))
        .select("n", "stop_words_removed", F.explode_outer("grams").alias("term"))
        .where(F.col("term").isNotNull())
    )


def rank_curves(
    reviews: DataFrame,
    stop_words: Sequence[str],
    lengths: Sequence[int] = (1, 2, 3, 4),
    k: int = 1000,
    lemmas: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` highest document-frequency ratios per n, with and without stop words.

    N-grams are counted under numeric keys, longer ones only where their parts
    are frequent enough. The texts are dealt out and written once for all passes.
    """
    n_texts, tasks = text_tasks(reviews)
    texts = reviews.select(*[c for c in ("id", "content") if c in reviews.columns])
    texts = checkpointed(dealt(texts, tasks))
    tokens = tokenize(texts, (), lemmas)
    share = min(SAMPLE_SHARE, SAMPLE_TEXTS / max(n_texts, 1))
    drawn = seeded_fraction(F.col("id") if "id" in texts.columns else F.xxhash64("content"), 7) < share
    sample = checkpointed(tokenize(texts.where(drawn), (), lemmas).select("tokens"))
    found = []
    for removed in (True, False):
        counts = frequent_counts(tokens.select("tokens"), sample, share, lengths, tuple(stop_words) if removed else (), k)
        found += [t.withColumns({"n": F.lit(n), "stop_words_removed": F.lit(removed)}) for n, t in counts.items()]
    best = Window.partitionBy("n", "stop_words_removed").orderBy(F.desc("df"), *KEY)
    return (
        _union(found)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("n", "stop_words_removed", F.col("rank").cast("bigint").alias("rank"), (F.col("df") / F.lit(n_texts)).alias("df_ratio"))
    )
