"""Feature builds whose indexes and singular vectors are tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.stopwords import english_stop_words
from ratewise.operators.features import default_spec
from ratewise.operators.randomized_svd import truncated_svd
from ratewise.operators.sparse_blocks import fit_blocks
from ratewise.operators.tfidf import TermSpec
from ratewise.plans import features as P
from ratewise.plans.explore_queries import TEXT_SQL
from ratewise.plans.registration import registrar
from ratewise.plans.text_queries import grams_sql, tokens_sql
from ratewise.sources.bindings import review_text, table

QUERIES, ORACLE, register = registrar()

_WEIGHTS = {"product": 2.0, "author": 0.5}


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    reviews = review_text(spark, sf_dir).select("id", "content", "product", "author", "rating")
    return reviews.where(F.col("id") % 3 != 0), reviews.where(F.col("id") % 3 == 0)


_BLOCKS_SQL = f"""WITH {TEXT_SQL}, {tokens_sql(True)}, {grams_sql(1, 2)},
  tf AS (SELECT id, term, count(*) AS tf FROM grams GROUP BY ALL),
  train AS (SELECT id, product, author FROM reviews WHERE id % 3 <> 0), n AS (SELECT count(*) AS n_docs FROM train),
  vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, ln((n_docs + 1) / (df + 1)) + 1 AS idf
    FROM (SELECT term, count(*) AS df FROM tf SEMI JOIN train USING (id) GROUP BY term), n WHERE df >= 0.01 * n_docs AND df <= 0.3 * n_docs),
  products AS (SELECT product, row_number() OVER (ORDER BY product) - 1 + (SELECT count(*) FROM vocab) AS idx
    FROM (SELECT DISTINCT product FROM train WHERE product IS NOT NULL)),
  authors AS (SELECT author, row_number() OVER (ORDER BY author) - 1 + (SELECT count(*) FROM vocab) + (SELECT count(*) FROM products) AS idx
    FROM (SELECT DISTINCT author FROM train WHERE author IS NOT NULL)),
  cells AS (SELECT id, idx, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)) AS value FROM tf JOIN vocab USING (term)
    UNION ALL SELECT id, idx, 2.0::DOUBLE FROM reviews JOIN products USING (product)
    UNION ALL SELECT id, idx, 0.5::DOUBLE FROM reviews JOIN authors USING (author)),
  most AS (SELECT idx, max(abs(value)) AS most FROM cells SEMI JOIN train USING (id) GROUP BY idx)
  SELECT id, CAST(idx AS BIGINT) AS idx, round(value / most, 9) AS value FROM cells JOIN most USING (idx)"""


@register("wide_features", _BLOCKS_SQL)
def wide_features(spark, sf_dir):
    """All cells of content, product and author, indexed and scaled over the training part."""
    train, test = _both(spark, sf_dir)
    index = fit_blocks(train, TermSpec(1, 2, 0.01, 0.3, english_stop_words()), weights=_WEIGHTS).scaled(train)
    cells = index.cells(train.unionByName(test))
    return cells.select("id", "idx", F.round("value", 9).alias("value"))


@register(
    "svd_row_norms",
    """SELECT vec_id AS id, round(sqrt(sum(x * x)), 6) AS norm
    FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY vec_id""",
)
def svd_row_norms(spark, sf_dir):
    """Lengths of the projected embeddings: with all components, a projection keeps the length of every row."""
    vectors = table(spark, sf_dir, "embeddings")
    cells = vectors.select(F.col("vec_id").alias("id"), F.posexplode("embedding").alias("idx", "value")).withColumn("value", F.col("value").cast("double"))
    factors = truncated_svd(cells, k=4000, passes=1)
    norm = F.sqrt(F.aggregate("z", F.lit(0.0), lambda total, x: total + x * x))
    return factors.project(cells).select("id", F.round(norm, 6).alias("norm"))


@register("wide_feature_build")
def wide_feature_build(spark, sf_dir):
    """Content of up to three words at the default limits, product and author, reduced to 20 components in [0, 1]."""
    train, test = _both(spark, sf_dir)
    built = P.build_wide_features(train, test, default_spec(), svd=True, k=20)
    return built.select("id", "split", "features")
