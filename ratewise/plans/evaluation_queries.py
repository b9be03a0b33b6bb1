"""Feature, selection, score, vote and trial queries, each with its SQL twin."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.numeric import clamp_round, log_grid_value
from ratewise.functions.stopwords import english_stop_words
from ratewise.operators import evaluation as E
from ratewise.operators import features as X
from ratewise.operators import selection as S
from ratewise.operators import tfidf as V
from ratewise.operators.distributions import value_histogram
from ratewise.plans.explore_queries import SPLIT_SQL, TEXT_SQL, _rounded
from ratewise.plans.registration import registrar
from ratewise.plans.text_queries import cells_sql
from ratewise.sources.bindings import review_text, table

QUERIES, ORACLE, register = registrar()


# --- items, one-hot, blocks ---------------------------------------------------------


@register("item_select", f"WITH {TEXT_SQL} SELECT id, content AS item FROM reviews")
def item_select(spark, sf_dir):
    return X.select_item(review_text(spark, sf_dir), "content")


@register("item_map", f"WITH {TEXT_SQL} SELECT id, author AS key, CAST(1 AS INTEGER) AS value FROM reviews")
def item_map(spark, sf_dir):
    items = X.select_item(review_text(spark, sf_dir), "author", as_map=True)
    return items.select("id", F.explode("item").alias("key", "value"))


@register("target", f"WITH {TEXT_SQL} SELECT id, rating, CAST(rating - 1 AS DOUBLE) AS label FROM reviews")
def target(spark, sf_dir):
    reviews = review_text(spark, sf_dir)
    return reviews.select("id", "rating", (F.col("rating") - 1).cast("double").alias("label"))


@register(
    "one_hot_long",
    f"""WITH {TEXT_SQL}, {SPLIT_SQL},
    known AS (SELECT author, row_number() OVER (ORDER BY author) - 1 AS idx FROM (SELECT DISTINCT author FROM split WHERE NOT is_test))
    SELECT id, idx, CAST(1 AS DOUBLE) AS value FROM split JOIN known USING (author)""",
)
def one_hot_long(spark, sf_dir):
    reviews = review_text(spark, sf_dir)
    train, _ = E.holdout(reviews)
    return X.one_hot_cells(reviews, "author", X.categories(train, "author"))


_SPEC = V.TermSpec(1, 1, 0.003, 0.3, english_stop_words())


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.tfidf(review_text(spark, sf_dir).select("id", "rating", "content"), _SPEC)


@register(
    "block_weights",
    f"""WITH {TEXT_SQL}, {cells_sql(1, 1, True, 0.003, 0.3)}
    SELECT id, 'content' AS block, term, round(value * 5, 6) AS value FROM cells
    UNION ALL SELECT id, 'product', product, 0.5 FROM reviews""",
)
def block_weights(spark, sf_dir):
    reviews = review_text(spark, sf_dir)
    one = F.lit(1.0).alias("value")
    blocks = {
        "content": _cells(spark, sf_dir),
        "product": reviews.select("id", F.col("product").alias("term"), one),
        "author": reviews.select("id", F.col("author").alias("term"), one),
    }
    return _rounded(X.weighted_blocks(blocks, {"content": 5, "product": 0.5, "author": 0}), "value")


@register(
    "nonzero_cells",
    """WITH c AS (SELECT vec_id AS id, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)
    SELECT id, count(*) AS n FROM c WHERE value <> 0 GROUP BY id""",
)
def nonzero_cells(spark, sf_dir):
    cells = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.explode(F.col("embedding").cast("array<double>")).alias("value")
    )
    return cells.where(F.col("value") != 0).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


# --- scaling -------------------------------------------------------------------------

_VECTOR_SQL = """c AS (SELECT vec_id AS id, CAST(unnest(range(len(embedding))) AS INTEGER) AS idx,
  CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), array_to_vector(F.col("embedding").cast("array<double>")).alias("raw")
    )


@register(
    "minmax_scale",
    f"""WITH {_VECTOR_SQL}, s AS (SELECT idx, min(x) AS lo, max(x) AS hi FROM c GROUP BY idx)
    SELECT id, idx, round(CASE WHEN hi = lo THEN 0 ELSE (x - lo) / (hi - lo) END, 6) AS value FROM c JOIN s USING (idx)""",
)
def minmax_scale(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    scaled = X.UnitRange("raw", "scaled").fit(vectors).transform(vectors)
    return _rounded(X.vector_cells(scaled, "scaled"), "value")


@register(
    "maxabs_scale",
    f"""WITH {_VECTOR_SQL}, s AS (SELECT idx, max(abs(x)) AS m FROM c GROUP BY idx)
    SELECT id, idx, round(CASE WHEN m = 0 THEN x ELSE x / m END, 6) AS value FROM c JOIN s USING (idx)""",
)
def maxabs_scale(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    scaled = X.max_abs("raw", "scaled").fit(vectors).transform(vectors)
    return _rounded(X.vector_cells(scaled, "scaled"), "value")


for _bins in (10, 50):

    @register(
        "feature_value_histogram" + ("" if _bins == 10 else f"_{_bins}"),
        f"""WITH {_VECTOR_SQL}, z AS (SELECT x FROM c WHERE x <> 0), s AS (SELECT min(x) AS lo, (max(x) - min(x)) / {_bins} AS w FROM z),
        b AS (SELECT least(CAST(floor((x - lo) / w) AS BIGINT), {_bins - 1}) AS bin, lo, w, count(*) AS n FROM z, s GROUP BY ALL)
        SELECT bin, round(lo + bin * w, 6) AS bin_left, round(lo + (bin + 1) * w, 6) AS bin_right, n FROM b""",
    )
    def feature_value_histogram(spark, sf_dir, bins=_bins):
        cells = table(spark, sf_dir, "embeddings").select(
            F.explode(F.col("embedding").cast("array<double>")).alias("value")
        )
        return _rounded(value_histogram(cells, "value", bins), "bin_left", "bin_right")


# --- chi-square ------------------------------------------------------------------------

_CHI2_SQL = f"""WITH {TEXT_SQL}, {cells_sql(1, 1, True, 0.003, 0.3)},
  p AS (SELECT rating, count(*) / (SELECT count(*) FROM reviews) AS share FROM reviews GROUP BY rating),
  o AS (SELECT term, rating, sum(value) AS o FROM cells GROUP BY ALL),
  t AS (SELECT term, sum(value) AS t FROM cells GROUP BY term),
  x AS (SELECT term, sum((coalesce(o, 0) - t * share) ** 2 / (t * share)) AS chi2
        FROM t CROSS JOIN p LEFT JOIN o USING (term, rating) GROUP BY term)"""


@register("chi2_scores", f"{_CHI2_SQL} SELECT term, round(chi2, 6) AS chi2 FROM x")
def chi2_scores(spark, sf_dir):
    return _rounded(S.chi2_scores(_cells(spark, sf_dir), review_text(spark, sf_dir)), "chi2")


@register("select_k_best", f"{_CHI2_SQL} SELECT term, round(chi2, 6) AS chi2 FROM x ORDER BY round(x.chi2, 9) DESC, term DESC LIMIT 100")
def select_k_best(spark, sf_dir):
    scores = S.chi2_scores(_cells(spark, sf_dir), review_text(spark, sf_dir))
    return _rounded(S.select_k_best(scores, 100), "chi2")


# --- scores ---------------------------------------------------------------------------

_PRED_SQL = """
pred AS (
  SELECT l_partkey, CAST(ceil(l_quantity / 10) AS INTEGER) AS rating,
         ceil(l_quantity / 10) + (round(l_tax * 100) - 4) / 2 AS raw FROM lineitem),
lab AS (SELECT *, round_even(greatest(0.0, least(5.0, raw)), 0) AS prediction FROM pred)"""


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rating = F.ceil(F.col("l_quantity") / 10)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        rating.cast("int").alias("rating"),
        (rating + (F.round(F.col("l_tax") * 100) - 4) / 2).cast("double").alias("raw"),
    )
    return lines.withColumn("prediction", clamp_round(F.col("raw")))


@register("clamp_round", f"WITH {_PRED_SQL} SELECT l_partkey, CAST(raw AS DOUBLE) AS raw, CAST(prediction AS DOUBLE) AS prediction FROM lab")
def clamp_round_query(spark, sf_dir):
    return _predictions(spark, sf_dir).drop("rating")


@register("mae", f"WITH {_PRED_SQL} SELECT round(avg(abs(rating - prediction)), 6) AS mae FROM lab")
def mae(spark, sf_dir):
    return _rounded(E.mae(_predictions(spark, sf_dir)), "mae")


_CLASSES = (0, 1, 2, 3, 4, 5)
_MATRIX_SQL = f"""WITH {_PRED_SQL}, m AS (SELECT CAST(p AS INTEGER) AS prediction, """ + ", ".join(
    f"count(*) FILTER (WHERE rating = {c}) AS truth_{c}" for c in _CLASSES
) + " FROM range(0, 6) r(p) LEFT JOIN lab ON CAST(lab.prediction AS INTEGER) = p GROUP BY p)"


@register("confusion_matrix", f"{_MATRIX_SQL} SELECT * FROM m")
def confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(_predictions(spark, sf_dir), _CLASSES)


_ROW_SUM = " + ".join(f"truth_{c}" for c in _CLASSES)


@register(
    "confusion_matrix_normalized",
    f"{_MATRIX_SQL} SELECT prediction, " + ", ".join(f"round(truth_{c} / nullif({_ROW_SUM}, 0), 6) AS truth_{c}" for c in _CLASSES) + " FROM m",
)
def confusion_matrix_normalized(spark, sf_dir):
    matrix = E.normalize_rows(E.confusion_matrix(_predictions(spark, sf_dir), _CLASSES))
    return _rounded(matrix, *[f"truth_{c}" for c in _CLASSES])


@register(
    "id_contiguity",
    """SELECT count(*) AS n, min(doc_id) AS min_id, max(doc_id) AS max_id, count(DISTINCT doc_id) AS n_distinct,
    min(doc_id) = 1 AND max(doc_id) = count(*) AND count(DISTINCT doc_id) = count(*) AS contiguous FROM documents""",
)
def id_contiguity(spark, sf_dir):
    return E.id_contiguity(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")))


# --- votes -----------------------------------------------------------------------------

# Weight of class c in model m for document id: 1 + (id * (m + 2) + c * c * m) % 7.


def _model_weights(m: int) -> list[str]:
    return [f"(1 + (id * {m + 2} + {c * c * m}) % 7)" for c in range(1, 6)]


def _votes(spark: SparkSession, sf_dir: str, n_models: int) -> DataFrame:
    df = review_text(spark, sf_dir).select("id")
    for m in range(1, n_models + 1):
        weights = _model_weights(m)
        total = " + ".join(weights)
        df = df.withColumn(f"p{m}", F.expr(f"array({', '.join(f'{w} / ({total})' for w in weights)})"))
    return df


def _votes_sql(n_models: int, weights) -> str:
    probabilities = ", ".join(
        "[" + ", ".join(f"CAST({w} AS DOUBLE) / ({' + '.join(_model_weights(m))})" for w in _model_weights(m)) + f"] AS p{m}"
        for m in range(1, n_models + 1)
    )
    mean = ", ".join(
        "(" + " + ".join(f"CAST({w} AS DOUBLE) * p{m}[{c}]" for m, w in enumerate(weights, start=1)) + f") / CAST({float(sum(weights))!r} AS DOUBLE)"
        for c in range(1, 6)
    )
    return f"""WITH p AS (SELECT doc_id AS id FROM documents), q AS (SELECT id, {probabilities} FROM p),
    v AS (SELECT id, [{mean}] AS v FROM q)
    SELECT id, CAST(list_position(v, list_max(v)) AS INTEGER) AS vote, round(list_max(v), 6) AS probability FROM v"""


# Weights of the five networks and the linear model.
VOTE_WEIGHTS = (0.3, 0.27, 0.24, 0.21, 0.18, 1.0)


@register("soft_vote", _votes_sql(5, [1.0] * 5))
def soft_vote(spark, sf_dir):
    voted = E.soft_vote(_votes(spark, sf_dir, 5), [f"p{m}" for m in range(1, 6)])
    return _rounded(voted.select("id", "vote", F.array_max("vote_probability").alias("probability")), "probability")


@register("weighted_soft_vote", _votes_sql(6, VOTE_WEIGHTS))
def weighted_soft_vote(spark, sf_dir):
    voted = E.soft_vote(_votes(spark, sf_dir, 6), [f"p{m}" for m in range(1, 7)], VOTE_WEIGHTS)
    return _rounded(voted.select("id", "vote", F.array_max("vote_probability").alias("probability")), "probability")


# --- trials ------------------------------------------------------------------------------

# Order lines read as tuning trials: C on a log grid of 6, k on a grid of 4, 4 seeds.
_K = (10, 58, 341, 1995)
_TRIAL_SQL = """
trials AS (
  SELECT round(pow(10.0, -5 + (l_partkey % 6) * 1.0), 8) AS c, [10, 58, 341, 1995][l_suppkey % 4 + 1] AS k,
         CAST(l_orderkey % 4 AS INTEGER) AS seed, l_discount AS score_training,
         l_extendedprice / 100000 AS score_validate, l_tax AS t_training FROM lineitem),
grid AS (SELECT c, k, avg(score_training) AS mean_score_training, avg(score_validate) AS mean_score_validate,
         avg(t_training) AS mean_t_training, stddev_pop(score_training) AS std_score_training,
         stddev_pop(score_validate) AS std_score_validate, stddev_pop(t_training) AS std_t_training,
         count(*) AS n_trials FROM trials GROUP BY c, k)"""


def _trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.round(log_grid_value(F.col("l_partkey") % 6, -5, 0, 6), 8).alias("c"),
        F.get(F.array(*map(F.lit, _K)), (F.col("l_suppkey") % 4).cast("int")).alias("k"),
        (F.col("l_orderkey") % 4).cast("int").alias("seed"),
        F.col("l_discount").alias("score_training"),
        (F.col("l_extendedprice") / 100000).alias("score_validate"),
        F.col("l_tax").alias("t_training"),
    )


_MEASURES = [f"{kind}_{m}" for kind in ("mean", "std") for m in E.METRICS]


@register("trial_summary", f"WITH {_TRIAL_SQL} SELECT c, k, n_trials, {', '.join(f'round({m}, 6) AS {m}' for m in _MEASURES)} FROM grid")
def trial_summary(spark, sf_dir):
    return _rounded(E.trial_summary(_trials(spark, sf_dir), ["c", "k"]), *_MEASURES)


@register("best_trial", f"WITH {_TRIAL_SQL} SELECT * FROM trials ORDER BY score_validate, c, k, seed, score_training, t_training LIMIT 1")
def best_trial(spark, sf_dir):
    order = ["c", "k", "seed", "score_training", "t_training"]
    return E.best_trial(_trials(spark, sf_dir), "score_validate", order)


@register(
    "best_k_trials",
    f"""WITH {_TRIAL_SQL}, s AS (SELECT c, k, round(mean_score_validate, 6) AS score FROM grid)
    SELECT * FROM s WHERE score < (SELECT score FROM s ORDER BY score LIMIT 1 OFFSET 5)""",
)
def best_k_trials(spark, sf_dir):
    cells = E.trial_summary(_trials(spark, sf_dir), ["c", "k"])
    scores = _rounded(cells.select("c", "k", F.col("mean_score_validate").alias("score")), "score")
    return E.best_k_trials(scores, "score")


@register(
    "trial_pivot",
    f"WITH {_TRIAL_SQL} SELECT c, " + ", ".join(f"round(avg(score_validate) FILTER (WHERE k = {k}), 6) AS k{k}" for k in _K) + " FROM trials GROUP BY c",
)
def trial_pivot(spark, sf_dir):
    grid = E.trial_pivot(_trials(spark, sf_dir), "c", "k", _K, "score_validate", "k")
    return _rounded(grid, *[f"k{k}" for k in _K])


# --- vectors ------------------------------------------------------------------------------


@register(
    "tfidf_vectors",
    f"WITH {TEXT_SQL}, {cells_sql(1, 2, True, 0.003, 0.3)}, v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab)"
    " SELECT id, CAST(idx AS INTEGER) AS idx, round(value, 6) AS value FROM cells JOIN v USING (term)",
)
def tfidf_vectors(spark, sf_dir):
    """The vector form of the TF-IDF, taken apart again into its non-zero cells."""
    reviews = review_text(spark, sf_dir).select("id", "content")
    spec = V.TermSpec(1, 2, 0.003, 0.3, english_stop_words())
    vectors = Pipeline(stages=[X.TfidfVectorizer(spec, outputCol="features")]).fit(reviews).transform(reviews)
    return _rounded(X.sparse_cells(vectors, "features"), "value")


@register(
    "exact_holdout",
    f"""WITH {TEXT_SQL}, drawn AS (SELECT id, rating, row_number() OVER (ORDER BY substr(md5(CAST(id AS VARCHAR) || ':659'), 1, 15), id) AS place FROM reviews)
    SELECT id, rating, place <= (SELECT ceil(0.05::DOUBLE * count(*)) FROM reviews) AS is_test FROM drawn""",
)
def exact_holdout(spark, sf_dir):
    """Every document, marked if it is one of the 5 per cent, rounded up, that are held out."""
    train, test = E.exact_holdout(review_text(spark, sf_dir).select("id", "rating"))
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
