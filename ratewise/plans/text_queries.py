"""Text queries over the documents, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.stopwords import EXTRA_ENGLISH, LANGUAGES, english_stop_words, stop_words
from ratewise.functions.text import ngrams, without, word_tokens, wordpunct_tokens
from ratewise.operators import language as L
from ratewise.operators import tfidf as V
from ratewise.operators.evaluation import holdout
from ratewise.operators.frequent_terms import frequent_terms
from ratewise.operators.lemmas import NOUN_ENDINGS, build_lemmas
from ratewise.plans.explore_queries import SPLIT_SQL, TEXT_SQL, _rounded
from ratewise.plans.registration import registrar
from ratewise.session import checkpointed
from ratewise.sources.bindings import review_text

QUERIES, ORACLE, register = registrar()


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


WORD_SQL = "regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}_]+')"
PUNCT_SQL = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_\\s]+')"
_TOKENS = WORD_SQL.format("lower(content)")
_STOPS = _quoted(english_stop_words())
LISTS_SQL = "stops(language, token) AS (VALUES " + ", ".join(
    f"('{name}', {_quoted([word])})" for name in LANGUAGES for word in stop_words(name)
) + ")"
_OVERLAP = f"""overlap AS (
  SELECT id, language, count(*) AS n
  FROM (SELECT DISTINCT id, unnest({PUNCT_SQL.format('content')}) AS token FROM reviews) t JOIN stops USING (token)
  GROUP BY id, language)"""
DETECTED_SQL = f"""{_OVERLAP}, detected AS (
  SELECT r.id, coalesce(o.language, 'unknown') AS language, CAST(coalesce(o.n, 0) AS INTEGER) AS n_hits
  FROM reviews r LEFT JOIN (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, language) AS r FROM overlap) o
  ON r.id = o.id AND o.r = 1)"""


def tokens_sql(stop: bool, source: str = "reviews") -> str:
    tokens = f"list_filter({_TOKENS}, lambda t: t NOT IN ({_STOPS}))" if stop else _TOKENS
    return f"tokens AS (SELECT id, rating, {tokens} AS tokens FROM {source})"


def grams_sql(lo: int, hi: int) -> str:
    parts = []
    for n in range(lo, hi + 1):
        gram = "tokens" if n == 1 else (
            f"list_transform(range(1, len(tokens) - {n} + 2), lambda i: array_to_string(tokens[i:i + {n - 1}], ' '))"
        )
        parts.append(f"SELECT id, rating, unnest({gram}) AS term FROM tokens")
    return f"grams AS ({' UNION ALL '.join(parts)})"


def cells_sql(lo: int, hi: int, stop: bool, min_df: float = 0.0, max_df: float = 1.0) -> str:
    """CTEs tokens, grams, tf, docs, vocab, cells."""
    return f"""{tokens_sql(stop)}, {grams_sql(lo, hi)},
    tf AS (SELECT id, rating, term, count(*) AS tf FROM grams GROUP BY ALL),
    docs AS (SELECT count(*) AS n_docs FROM reviews),
    vocab AS (SELECT term, df, df / n_docs AS df_ratio, ln((n_docs + 1) / (df + 1)) + 1 AS idf
              FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), docs
              WHERE df >= {min_df} * n_docs AND df <= {max_df} * n_docs),
    cells AS (SELECT id, rating, term, tf, df, idf,
                     tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)) AS value
              FROM tf JOIN vocab USING (term))"""


# --- language ------------------------------------------------------------------


@register("language_detect", f"WITH {TEXT_SQL}, {LISTS_SQL}, {DETECTED_SQL} SELECT id, language, n_hits FROM detected")
def language_detect(spark, sf_dir):
    return L.detect_language(review_text(spark, sf_dir)).select("id", "language", "n_hits")


@register("language_counts", f"WITH {TEXT_SQL}, {LISTS_SQL}, {DETECTED_SQL} SELECT language, count(*) AS n FROM detected GROUP BY 1")
def language_counts(spark, sf_dir):
    return L.language_counts(L.detect_language(review_text(spark, sf_dir)))


@register(
    "language_top5",
    f"""WITH {TEXT_SQL}, {LISTS_SQL}, {DETECTED_SQL} SELECT language, count(*) AS n FROM detected GROUP BY 1
    ORDER BY n DESC, language DESC LIMIT 5""",
)
def language_top5(spark, sf_dir):
    return L.language_counts(L.detect_language(review_text(spark, sf_dir))).limit(5)


@register("stopword_overlap", f"WITH {TEXT_SQL}, {LISTS_SQL}, {_OVERLAP} SELECT id, language, n FROM overlap")
def stopword_overlap(spark, sf_dir):
    return L.stop_word_overlap(review_text(spark, sf_dir), L.stop_word_table(spark))


# --- tokens ---------------------------------------------------------------------


@register("word_tokens", f"WITH {TEXT_SQL} SELECT id, {WORD_SQL.format('content')} AS tokens FROM reviews")
def word_tokens_query(spark, sf_dir):
    return review_text(spark, sf_dir).select("id", word_tokens(F.col("content")).alias("tokens"))


@register("wordpunct_tokens", f"WITH {TEXT_SQL} SELECT id, {PUNCT_SQL.format('content')} AS tokens FROM reviews")
def wordpunct_tokens_query(spark, sf_dir):
    return review_text(spark, sf_dir).select("id", wordpunct_tokens(F.col("content")).alias("tokens"))


def _ngram_query(n):
    def run(spark, sf_dir):
        tokens = V.tokenize(review_text(spark, sf_dir).select("id", "content"))
        return tokens.select("id", ngrams(F.col("tokens"), n).alias("grams"))

    return run


for _n in (2, 3, 4):
    register(
        f"ngrams_{_n}",
        f"""WITH {TEXT_SQL}, {tokens_sql(False)} SELECT id, list_transform(range(1, len(tokens) - {_n} + 2),
        lambda i: array_to_string(tokens[i:i + {_n - 1}], ' ')) AS grams FROM tokens""",
    )(_ngram_query(_n))


@register(
    "stopwords_union",
    f"""WITH {TEXT_SQL}, w AS (SELECT unnest({_TOKENS}) AS token FROM reviews)
    SELECT token, count(*) AS n FROM w WHERE token IN ({_quoted(stop_words('english'))})
    OR token IN ({_quoted(EXTRA_ENGLISH)}) GROUP BY token""",
)
def stopwords_union(spark, sf_dir):
    """Occurrences of each word of the united list."""
    english = spark.createDataFrame([(w,) for w in stop_words("english")], "token string")
    extra = spark.createDataFrame([(w,) for w in EXTRA_ENGLISH], "token string")
    united = english.unionByName(extra).distinct()
    words = V.tokenize(review_text(spark, sf_dir).select("content")).select(
        F.explode_outer("tokens").alias("token")
    )
    return words.join(F.broadcast(united), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@register("stopword_filter", f"WITH {TEXT_SQL}, {tokens_sql(True)} SELECT id, tokens FROM tokens")
def stopword_filter(spark, sf_dir):
    tokens = review_text(spark, sf_dir).select("id", word_tokens(F.lower("content")).alias("tokens"))
    return tokens.select("id", without(F.col("tokens"), english_stop_words()).alias("tokens"))


_LEMMA_SQL = f"""w AS (SELECT DISTINCT unnest({_TOKENS}) AS form FROM reviews),
    c AS (SELECT form, form AS lemma, 0 AS rule FROM w """ + " ".join(
    f"UNION ALL SELECT form, left(form, length(form) - {len(old)}) || '{new}', {i} FROM w WHERE ends_with(form, '{old}')"
    for i, (old, new) in enumerate(NOUN_ENDINGS, start=1)
) + """), lemma AS (SELECT form, arg_min(lemma, (length(lemma), rule)) AS lemma FROM c
      WHERE lemma IN (SELECT form FROM w) GROUP BY form)"""


@register("lemmas", f"WITH {TEXT_SQL}, {_LEMMA_SQL} SELECT form, lemma FROM lemma WHERE form <> lemma")
def lemmas(spark, sf_dir):
    """Lemma table of the corpus vocabulary checked against itself."""
    tokens = V.tokenize(review_text(spark, sf_dir).select("id", "content"))
    forms = checkpointed(tokens.select(F.explode_outer("tokens").alias("term")).where("term IS NOT NULL").distinct())
    return build_lemmas(forms, forms)


# --- terms ----------------------------------------------------------------------


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_text(spark, sf_dir).select("id", "content")


@register(
    "document_frequency",
    f"""WITH {TEXT_SQL}, {cells_sql(1, 1, True)} SELECT term, df, round(df_ratio, 6) AS df_ratio, round(idf, 6) AS idf
    FROM vocab""",
)
def document_frequency(spark, sf_dir):
    spec = V.TermSpec(stop_words=english_stop_words())
    return _rounded(V.document_frequency(_reviews(spark, sf_dir), spec), "df_ratio", "idf")


_VOCAB = V.TermSpec(1, 2, 0.003, 0.3, english_stop_words())


@register(
    "vocabulary",
    f"""WITH {TEXT_SQL}, {cells_sql(1, 2, True, 0.003, 0.3)}
    SELECT term, df, round(idf, 6) AS idf, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab""",
)
def vocabulary(spark, sf_dir):
    frequency = V.document_frequency(_reviews(spark, sf_dir), _VOCAB)
    return _rounded(V.vocabulary(frequency).drop("df_ratio"), "idf")


@register(
    "tfidf",
    f"""WITH {TEXT_SQL}, {cells_sql(1, 2, True, 0.003, 0.3)}
    SELECT id, term, tf, round(value, 6) AS value FROM cells""",
)
def tfidf(spark, sf_dir):
    reviews = review_text(spark, sf_dir).select("id", "content")
    return _rounded(V.tfidf(reviews, _VOCAB).select("id", "term", "tf", "value"), "value")


_SCORES_SQL = """
scores AS (SELECT term, sum(value) AS s, round(sum((rating - 3) * value), 9) AS product, any_value(idf) AS idf
           FROM cells GROUP BY term),
tops AS (SELECT round(s / (SELECT count(*) FROM vocab), 12) AS tfidf, idf, term FROM scores)"""


def _report(n: int, stop: bool):
    def run(spark, sf_dir):
        reviews = review_text(spark, sf_dir).select("id", "rating", "content")
        return V.corpus_report(reviews, english_stop_words(), (n,), removal=(stop,))

    return run


for _n in (1, 2, 3, 4):
    for _stop in (True, False):
        _suffix = ("" if _n == 1 else f"_{_n}gram") + ("" if _stop else "_all_words")
        register(
            f"tfidf_top_terms{_suffix}",
            f"""WITH {TEXT_SQL}, {cells_sql(_n, _n, _stop)}, {_SCORES_SQL}
            SELECT round(tfidf, 9) AS tfidf, round(tfidf / idf, 9) AS tf, round(idf, 6) AS idf, term,
                   {_n} AS n, {_stop} AS stop_words_removed FROM tops ORDER BY tops.tfidf DESC, term DESC LIMIT 5""",
        )(lambda s, d, f=_report(_n, _stop): _rounded(_rounded(f(s, d)[0], "idf"), "tfidf", "tf", digits=9))
        register(
            f"term_rating_association{_suffix}",
            f"""WITH {TEXT_SQL}, {cells_sql(_n, _n, _stop)}, {_SCORES_SQL},
            h AS (SELECT 'highest' AS side, row_number() OVER (ORDER BY product DESC, term DESC) AS rank, product, term FROM scores),
            l AS (SELECT 'lowest' AS side, row_number() OVER (ORDER BY product, term) AS rank, product, term FROM scores)
            SELECT side, rank, round(product, 6) AS rating_product, term, {_n} AS n, {_stop} AS stop_words_removed
            FROM (FROM h UNION ALL FROM l) WHERE rank <= 5""",
        )(lambda s, d, f=_report(_n, _stop): _rounded(f(s, d)[1], "rating_product"))


# --- lemmatised TF-IDF ---------------------------------------------------------

@register(
    "tfidf_lemmas",
    f"""WITH {TEXT_SQL}, {_LEMMA_SQL},
    terms AS (SELECT id, lemma AS term FROM (SELECT id, unnest({_TOKENS}) AS form FROM reviews) JOIN lemma USING (form)
      WHERE lemma NOT IN ({_STOPS})),
    tf AS (SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term), n AS (SELECT count(*) AS n FROM reviews),
    vocab AS (SELECT term, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), n
      WHERE df >= 0.01 * n AND df <= 0.3 * n)
    SELECT id, term, tf, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)), 6) AS value
    FROM tf JOIN vocab USING (term)""",
)
def tfidf_lemmas(spark, sf_dir):
    """TF-IDF of the lemmatised texts; the corpus vocabulary is the lexicon."""
    reviews = _reviews(spark, sf_dir)
    forms = checkpointed(V.document_frequency(reviews).select("term"))
    cells = V.tfidf(reviews, V.TermSpec(1, 1, 0.01, 0.3, english_stop_words()), checkpointed(build_lemmas(forms, forms)))
    return _rounded(cells.select("id", "term", "tf", "value"), "value")


_CURVE_SQL = ", ".join(
    f"""t{n}{int(stop)} AS (SELECT {tokens_sql(stop)[len('tokens AS (SELECT '):-1]}),
    c{n}{int(stop)} AS (SELECT term, count(DISTINCT id) AS df FROM (
      SELECT id, unnest({'tokens' if n == 1 else f"list_transform(range(1, len(tokens) - {n} + 2), lambda i: array_to_string(tokens[i:i + {n - 1}], ' '))"}) AS term
      FROM t{n}{int(stop)}) GROUP BY term),
    r{n}{int(stop)} AS (SELECT {n} AS n, {stop} AS stop_words_removed, row_number() OVER (ORDER BY df DESC) AS rank,
      round(df / (SELECT count(*) FROM reviews), 6) AS df_ratio FROM c{n}{int(stop)} ORDER BY df DESC LIMIT 1000)"""
    for n in (1, 2, 3, 4)
    for stop in (True, False)
)


@register(
    "ngram_rank_curve",
    f"WITH {TEXT_SQL}, {_CURVE_SQL} SELECT * FROM ("
    + " UNION ALL ".join(f"FROM r{n}{int(stop)}" for n in (1, 2, 3, 4) for stop in (True, False))
    + ")",
)
def ngram_rank_curve(spark, sf_dir):
    curves = V.rank_curves(review_text(spark, sf_dir), english_stop_words())
    return _rounded(curves, "df_ratio")


_FREQUENT_SQL = " UNION ALL ".join(
    f"""(SELECT {n} AS n, {stop} AS stop_words_removed, row_number() OVER (ORDER BY df DESC, term) AS rank, term, df
      FROM c{n}{int(stop)} ORDER BY df DESC, term LIMIT 200)"""
    for n in (1, 2, 3, 4)
    for stop in (True, False)
)


@register("frequent_ngrams", f"WITH {TEXT_SQL}, {_CURVE_SQL} SELECT * FROM ({_FREQUENT_SQL})")
def frequent_ngrams(spark, sf_dir):
    """The 200 n-grams in most texts for each n, with and without stop words; rare ones are not shuffled."""
    return frequent_terms(review_text(spark, sf_dir), english_stop_words(), k=200)


@register(
    "unseen_terms_dropped",
    f"""WITH {TEXT_SQL}, {SPLIT_SQL}, w AS (SELECT id, is_test, unnest({_TOKENS}) AS term FROM split),
    train AS (SELECT DISTINCT term FROM w WHERE NOT is_test)
    SELECT id, count(*) AS n_terms, count(t.term) AS n_known, CAST(sum(tf) AS BIGINT) AS n_words FROM (
      SELECT id, term, count(*) AS tf FROM w WHERE is_test GROUP BY id, term) LEFT JOIN train t USING (term) GROUP BY id""",
)
def unseen_terms_dropped(spark, sf_dir):
    """Per test text: distinct terms, and how many of them the training vocabulary knows."""
    train, test = holdout(_reviews(spark, sf_dir))
    seen = checkpointed(V.document_frequency(train).select("term", "df"))
    cells = V.term_counts(test)
    every = cells.groupBy("id").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("n_words"))
    known = V.lookup_join(cells, seen, "term", "df").groupBy("id").agg(F.count(F.lit(1)).alias("n_known"))
    return every.join(known, "id", "left").withColumn("n_known", F.coalesce("n_known", F.lit(0)))
