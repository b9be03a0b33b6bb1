"""Counts under numeric keys against the long form of TF-IDF."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.operators import gram_cells as G
from ratewise.operators import tfidf as V

STOP = ("the", "a")


def reviews_of(spark, seed=1, n=150):
    rng = random.Random(seed)
    words = ["the", "a", "été", *[f"w{i}" for i in range(25)]]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 30))) for _ in range(n)]
    rows = [(i, 1 + i % 5, t) for i, t in enumerate(texts + texts[:20] + ["one two three four"] * 4 + [None, "", "THE"])]
    # Ids that come twice, with the same rating and with another; texts without id.
    rows += [(3, 4, texts[3]), (3, 4, "w1 w2 w3 w1 w2 w3"), (4, 1, texts[9]), (None, 2, texts[5]), (None, 2, texts[6])]
    return spark.createDataFrame(rows, "id long, rating int, content string")


def plain(reviews, n, stop):
    spec = V.TermSpec(n, n, stop_words=stop)
    frequency = V.fit_frequency(reviews, spec)
    return V.term_scores(V.weigh(reviews, spec, frequency)), frequency.count()


def rounded(df, *names):
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()]


@pytest.mark.parametrize("n", [1, 2, 4])
@pytest.mark.parametrize("stop", [STOP, ()])
@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_report_equals_long_form(spark, monkeypatch, n, stop, broadcast):
    monkeypatch.setattr(G, "SLICE_TOKENS", 64)
    reviews = reviews_of(spark)
    expected, size = plain(reviews, n, stop)
    scores, found = V.report_scores(reviews, n, stop, k=5, broadcast_texts=broadcast)
    assert found == size
    assert rounded(V.top_terms(scores, F.lit(found))) == rounded(V.top_terms(expected, F.lit(size)))
    assert sorted(rounded(V.associated_terms(scores))) == sorted(rounded(V.associated_terms(expected)))


def test_counts_are_shuffled_once_and_not_as_strings(spark):
    """The document frequencies, the norms and the scores come from one shuffle of numbers."""
    reviews = reviews_of(spark, 2)
    scores, _ = V.report_scores(reviews, 3, STOP)
    assert 0 < scores.count() < plain(reviews, 3, STOP)[0].count() / 2


def test_no_text(spark):
    scores, size = V.report_scores(spark.createDataFrame([], "id long, rating int, content string"), 2)
    assert size == 0 and scores.count() == 0


def test_cells(spark):
    tokens = spark.createDataFrame([(1, list("abab")), (2, list("ab")), (3, []), (4, None)], "id long, tokens array<string>")
    terms = {(r.h1, r.h2): r.term for r in G.gram_cells(tokens, [1, 2], terms=True).collect()}
    found = sorted((r.id, terms[r.h1, r.h2], r.tf) for r in G.gram_cells(tokens, [1, 2]).collect())
    assert found == [(1, "a", 2), (1, "a b", 2), (1, "b", 2), (1, "b a", 1), (2, "a", 1), (2, "a b", 1), (2, "b", 1)]
    key = next(k for k, term in terms.items() if term == "a b")[0]
    assert {r.term for r in G.gram_cells(tokens, [1, 2], only=np.array([key]), terms=True).collect()} == {"a b"}
    assert G.gram_cells(tokens, [1, 2], only=np.array([], np.int64)).count() == 0


def test_limited_frequencies_equal_all_of_them(spark):
    """Terms counted under keys are those counted as strings."""
    reviews = reviews_of(spark, 3)
    every = V.document_frequency(reviews, V.TermSpec(1, 2, 0.0, 0.5, STOP)).where("df_ratio >= 0.04")
    some = V.document_frequency(reviews, V.TermSpec(1, 2, 0.04, 0.5, STOP))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.collect())) != []


def test_only_fitted_terms_are_counted(spark):
    """A broadcast vocabulary meets the terms before they are counted; the cells are those of the join after it."""
    reviews = reviews_of(spark, 4)
    spec = V.TermSpec(1, 2, 0.05, 0.5, STOP)
    frequency, frequent = V.fit_terms(reviews, spec)
    columns = ["id", "rating", "term", "tf", "df", F.round("value", 6).alias("value")]
    one, other = (V.weigh(reviews, spec, frequency, frequent=frequent, broadcast_rows=b).select(*columns) for b in (10**6, 0))
    assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())) != []


def test_lemmas_where_the_tokens_are(spark, monkeypatch):
    """A small lemma table replaces tokens in place; the result is that of the join, also for ids that come twice."""
    from ratewise.operators import lemmas as L

    table = spark.createDataFrame([("cats", "cat"), ("b", "a")], "form string, lemma string")
    rows = [(1, ["cats", "x", "b"]), (2, []), (3, None), (4, ["q", "b"]), (4, ["cats", "a", "z"]), (None, ["b"])]
    tokens = spark.createDataFrame(rows, "id long, tokens array<string>")
    small = sorted(map(str, L.lemmatize(tokens, table).collect()))
    monkeypatch.setattr(L, "fits_broadcast", lambda *_: False)
    assert small == sorted(map(str, L.lemmatize(tokens, table).collect()))
    assert "Row(id=1, tokens=['cat', 'x', 'a'])" in small


@pytest.mark.parametrize("share", [0.01, 0.3, 3.0])
def test_frequent_counts(spark, share):
    """The best counts are exact: whether the sample's guess at the bound is too high, fits, or prunes nothing."""
    rows = [(r.id, (r.content or "").lower().split()) for r in reviews_of(spark, 5, 300).collect()]
    tokens = spark.createDataFrame(rows, "id long, tokens array<string>").select("tokens").repartition(3)
    sample = tokens if share > 0.1 else tokens.limit(150)
    made = G.frequent_counts(tokens, sample, share, (1, 2, 3), STOP, 10)
    for n in (1, 2, 3):
        every = G.gram_cells(tokens, [n], STOP).groupBy("h1", "h2").agg(F.sum("n").alias("df"))
        best = lambda t: [r.df for r in t.orderBy(F.desc("df")).limit(10).collect()]
        assert best(made[n]) == best(every)
    if share == 0.3:  # the guess is three times the counts at first
        assert G.frequent_counts(tokens, sample, 1.0, (1, 2), STOP, 10)[2].count() < every.count()


def test_cells_of_a_text_lie_together(spark):
    """Rows of one text follow each other, also with whole texts among them, so that the shuffle packs them."""
    reviews = reviews_of(spark, 6).coalesce(1)
    marked = V.tokenize(reviews).withColumn("h1", F.xxhash64("id", "rating")).withColumn("at", F.monotonically_increasing_id())
    at = [r["at"] for r in G.gram_cells(marked, [2], STOP, whole=True).select("at").collect()]
    assert len(at) > 500 and at == sorted(at)


def test_counts_of_texts_and_cells_from_numeric_keys(spark):
    from ratewise.operators.sparse_blocks import fit_blocks

    texts = ["a b a c", "b c d", None, "", "a b", "c c c the a", "q"]
    rows = [(i % 5, t, "p", "u") for i, t in enumerate(texts)]  # two ids come twice
    reviews = spark.createDataFrame([*rows, (None, "a c", "p", "u"), (None, "b b", "p", "u")], "id long, content string, product string, author string")
    spec = V.TermSpec(1, 3, 0.05, 0.9, ("the",))
    counted = {(r.term, r.df) for r in V.document_frequency(reviews.select("content"), spec).collect()}
    grams = {}
    for text in [*texts, "a c", "b b"]:
        words = [w for w in (text or "").split() if w != "the"]
        for gram in {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}:
            grams[gram] = grams.get(gram, 0) + 1
    assert counted == set(grams.items())

    block = fit_blocks(reviews, spec).blocks[0]
    known = reviews.select("id", "content").where("content is not null")
    plain = V.weigh(known, spec, block.index, frequent=block.frequent)
    cells = lambda df: {(r.id, r.idx): (round(r.value, 12), r.scale) for r in df.collect()}
    found = V.weigh_indexed(known, spec, block.index)
    assert found.count() == plain.count() > 20 and cells(found) == cells(plain)
    assert V.weigh_indexed(known, spec, block.index, most_terms=3) is None
    # None of the terms: no cells.
    assert V.weigh_indexed(known, spec, block.index.limit(0)).count() == 0
