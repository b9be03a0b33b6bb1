import math
from collections import Counter

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ratewise.functions import text as X
from ratewise.functions.stopwords import english_stop_words, stop_words
from ratewise.operators import features as FT
from ratewise.operators import joins, language, lemmas, tfidf
from ratewise.session import checkpointed

DOCS = [
    (1, 5, "the cat sat on the mat"),
    (2, 1, "The dog ate the cats; café 42!"),
    (3, 3, ""),
    (4, 4, "cat cat cat dog"),
    (5, 2, "... !!!"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, rating int, content string")


def brute_tokens(text):
    import re

    return re.findall(r"\w+", text.lower())


def brute_tfidf(n):
    grams = {}
    for i, _, text in DOCS:
        t = brute_tokens(text)
        grams[i] = Counter(" ".join(t[j : j + n]) for j in range(len(t) - n + 1))
    df = Counter(t for c in grams.values() for t in c)
    cells = {}
    for i, c in grams.items():
        raw = {t: tf * (math.log((1 + len(DOCS)) / (1 + df[t])) + 1) for t, tf in c.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        cells.update({(i, t): v / norm for t, v in raw.items()})
    return cells


@pytest.mark.parametrize("n", [1, 2, 3])
def test_tfidf_against_brute_force(docs, n):
    got = {(r.id, r.term): r.value for r in tfidf.tfidf(docs, tfidf.TermSpec(n, n)).collect()}
    want = brute_tfidf(n)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_shuffled_join_equals_broadcast(docs, monkeypatch):
    want = {(r.id, r.term): r.value for r in tfidf.tfidf(docs, tfidf.TermSpec()).collect()}
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(joins.lookup_join, "__defaults__", (joins.BROADCAST_ROWS, 2))
    got = {(r.id, r.term): r.value for r in tfidf.tfidf(docs, tfidf.TermSpec()).collect()}
    assert got == pytest.approx(want)


def test_ngram_lengths(docs):
    tokens = tfidf.tokenize(docs)
    for n in range(1, 10):
        for r in tokens.select("tokens", X.ngrams(F.col("tokens"), n).alias("g")).collect():
            want = [" ".join(r.tokens[i : i + n]) for i in range(len(r.tokens) - n + 1)]
            assert r.g == want
    for n in (0, 10):
        with pytest.raises(ValueError):
            X.ngrams(F.col("tokens"), n)


def test_filter_on_grams_stays_cheap(spark):
    # A filter on the n-grams must not make each element recompute its array.
    long = spark.range(1).select(F.lit(1).alias("id"), F.repeat(F.lit("alpha beta gamma "), 20_000).alias("content"))
    tokens = tfidf.tokenize(long)
    grams = tokens.select(X.ngram_range(F.col("tokens"), 1, 3).alias("g")).where(F.size("g") > 0)
    assert len(grams.first().g) == 3 * 60_000 - 3


def test_stop_words():
    assert len(stop_words("english")) == 181
    assert {"s", "t", "2", "m", "ve", "the"} <= set(english_stop_words())
    with pytest.raises(ValueError):
        stop_words("klingon")


def test_word_count_ignores_outer_blanks(spark):
    row = spark.createDataFrame([("  a  b\tc\n",), ("",)], "c string").select(X.word_count(F.col("c")).alias("n"))
    assert [r.n for r in row.collect()] == [3, 0]


def test_language_ties_and_unknown(spark):
    lists = {"b": ["x", "y"], "a": ["x", "z"], "c": ["q"]}
    df = spark.createDataFrame([(1, "X x"), (2, "y x"), (3, "none")], "id long, content string")
    got = {r.id: (r.language, r.n_hits) for r in language.detect_language(df, lists).collect()}
    assert got == {1: ("a", 1), 2: ("b", 2), 3: ("unknown", 0)}


def test_lemmas(spark, docs):
    vocabulary = ["cat", "cats", "church", "churches", "city", "cities", "man", "bus", "ss", "s"]
    lexicon = spark.createDataFrame([(w,) for w in vocabulary], "term string")
    forms = lexicon.union(spark.createDataFrame([("men",)], "term string"))
    table = checkpointed(lemmas.build_lemmas(forms, lexicon))
    assert {r.form: r.lemma for r in table.collect()} == {
        "cats": "cat", "churches": "church", "cities": "city", "men": "man", "ss": "s",
    }
    tokens = tfidf.tokenize(docs, lemmas=table)
    rows = {r.id: r.tokens for r in tokens.collect()}
    assert rows[2] == ["the", "dog", "ate", "the", "cat", "café", "42"]
    assert rows[3] == [] and len(rows) == len(DOCS)


def test_vector_form_equals_long_form(docs, folder):
    spec = tfidf.TermSpec(1, 2, 0.0, 0.9, ("the",))
    model = Pipeline(stages=[FT.TfidfVectorizer(spec, outputCol="features")]).fit(docs)
    model.write().overwrite().save(folder + "/m")
    model = PipelineModel.load(folder + "/m")
    cells = FT.sparse_cells(model.transform(docs), "features")
    got = {(r.id, r.idx): r.value for r in cells.collect()}
    frequency = tfidf.fit_frequency(docs, spec)
    index = {r.term: r.idx for r in tfidf.vocabulary(frequency).collect()}
    want = {(r.id, index[r.term]): r.value for r in tfidf.weigh(docs, spec, frequency).collect()}
    assert got == pytest.approx(want)
    assert sorted(index, key=index.get) == sorted(index)


def test_unseen_terms_are_dropped(spark, docs):
    model = FT.TfidfVectorizer(tfidf.TermSpec(), outputCol="f").fit(docs)
    new = spark.createDataFrame([(9, "zebra"), (10, "zebra cat")], "id long, content string")
    assert {r.id for r in FT.sparse_cells(model.transform(new), "f").collect()} == {10}
