"""Loader and model queries over the driver's tables."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.operators import features as X
from ratewise.operators import evaluation as E
from ratewise.operators.evaluation import holdout
from ratewise.plans import features as P
from ratewise.plans import models as M
from ratewise.plans import network as N
from ratewise.plans import tuning as U
from ratewise.plans.registration import registrar
from ratewise.plans.text_queries import TEXT_SQL, cells_sql
from ratewise.session import checkpointed, scratch_path
from ratewise.sources import reviews as R
from ratewise.sources import tables as S
from ratewise.sources.bindings import review_text, table

QUERIES, ORACLE, register = registrar()


# --- loaders: every document written in the file format and parsed back -----------------

_ONE_LINE = "rtrim(regexp_replace(text, '[ \\t\\n\\v\\f\\r]+', ' ', 'g'))"
_RENDERED = f"""SELECT {{id}} 'u' || CAST(doc_id % 97 AS VARCHAR) AS author, source AS product,
  make_date(CAST(2001 + doc_id % 7 AS INTEGER), CAST(1 + doc_id % 12 AS INTEGER), CAST(1 + doc_id % 28 AS INTEGER)) AS date,
  CAST(n_chars AS VARCHAR) AS summary, {_ONE_LINE} AS content"""
_FILE_REVIEWS = 500


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    part = lambda first, n: (first + F.col("doc_id") % n).cast("string")
    return docs.withColumn(
        "value",
        F.concat_ws(
            "\n",
            F.concat(F.lit("<Author>u"), part(0, 97)),
            F.concat(F.lit("<Product>"), "source"),
            F.concat(F.lit("<Date>"), part(1, 12), F.lit(" "), part(1, 28), F.lit(", "), part(2001, 7)),
            F.concat(F.lit("<Summary>"), F.col("n_chars").cast("string")),
            F.concat(F.lit("<Content>"), F.regexp_replace("text", r"\s+", " ")),
        ),
    )


def _written_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents written as training files of up to _FILE_REVIEWS reviews, and loaded from them."""
    tail = F.concat(
        F.lit("\n<Helpful>"), (F.col("doc_id") % 4).cast("string"), F.lit("/3\n<Rating>"), (1 + F.col("doc_id") % 5).cast("string")
    )
    folder = scratch_path(spark, "train")
    files = (
        _lines(spark, sf_dir)
        .groupBy(F.floor(F.col("doc_id") / _FILE_REVIEWS).alias("file"))
        .agg(F.array_join(F.collect_list(F.concat("value", tail)), "\n\n").alias("value"))
    )
    files.select("value").write.option("maxRecordsPerFile", 1).text(folder)
    return R.load_train(spark, folder)


@register(
    "load_train",
    _RENDERED.format(id="") + ", CAST(doc_id % 4 AS INTEGER) AS positive, CAST(3 AS INTEGER) AS total,"
    " CAST(1 + doc_id % 5 AS INTEGER) AS rating FROM documents",
)
def load_train(spark, sf_dir):
    loaded = _written_train(spark, sf_dir)
    return loaded.select("author", "product", "date", "summary", "content", "helpful.positive", "helpful.total", "rating")


@register(
    "train_keys",
    "SELECT count(*) AS n, count(*) AS n_distinct, -count(*) AS first, CAST(-1 AS BIGINT) AS last FROM documents",
)
def train_keys(spark, sf_dir):
    """Keys of the loaded training reviews: one each, -1 to -n."""
    return _written_train(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_distinct"), F.min("id").alias("first"), F.max("id").alias("last")
    )


@register("load_test", _RENDERED.format(id="doc_id AS id,") + " FROM documents")
def load_test(spark, sf_dir):
    files = _lines(spark, sf_dir).select("value", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"))
    return R.parse_test_files(files).select("id", "author", "product", "date", "summary", "content")


@register(
    "mini_batches",
    """WITH n AS (SELECT count(*) AS n FROM documents), b AS (SELECT unnest(range(7)) AS batch_no)
    SELECT batch_no, CAST(ceil((batch_no + 1) * n / 7.0) - ceil(batch_no * n / 7.0) AS BIGINT) AS n_rows FROM b, n""",
)
def mini_batches(spark, sf_dir):
    """Sizes of seven batches; together they hold every document."""
    docs = review_text(spark, sf_dir).select("id")
    return E.numbered_batches(docs, n_batches=7).groupBy("batch_no").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "submission",
    "SELECT CAST(doc_id AS VARCHAR) AS id, CAST(1 + doc_id % 5 AS VARCHAR) || '.500000000000000000' AS rating FROM documents",
)
def submission(spark, sf_dir):
    predictions = review_text(spark, sf_dir).select("id", (F.col("rating") + 0.5).alias("prediction"))
    return S.submission(predictions)


# --- models: quality (0/1) of the labelled documents as rating 1 or 2 ----------------------

_CLASSES = 2


def labelled_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = review_text(spark, sf_dir, with_labels=True).where(F.col("label").isNotNull())
    return rows.withColumn("rating", (F.col("label") + 1).cast("int")).withColumn("label", F.col("label").cast("double"))


def _content_split(spark: SparkSession, sf_dir: str, k: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(training, validation) with features fitted on the training part: TF-IDF, reduced to k components."""
    train, validate = holdout(labelled_reviews(spark, sf_dir), 0.2)
    stages = P.content_stages(1, min_df=0.01, outputCol="features" if k is None else "raw")
    if k is not None:
        stages = stages + [X.TruncatedSVD(k, "raw", "reduced"), X.UnitRange("reduced", "features")]
    model = Pipeline(stages=stages).fit(train)
    keep = ["id", "rating", "label", "features"]
    return checkpointed(model.transform(train).select(*keep)), checkpointed(model.transform(validate).select(*keep))


@register(
    "feature_union",
    f"""WITH {TEXT_SQL}, {cells_sql(1, 1, True, 0.01, 0.3)}, c AS (SELECT id, count(*) AS n, sum(value) AS s FROM cells GROUP BY id)
    SELECT id, CAST(coalesce(n, 0) + 2 AS BIGINT) AS n_cells, round(coalesce(s, 0) + 1, 6) AS total FROM reviews LEFT JOIN c USING (id)""",
)
def feature_union(spark, sf_dir):
    """Non-zero cells per document of content, product and author side by side."""
    reviews = review_text(spark, sf_dir).select("id", "content", "product", "author")
    model = Pipeline(stages=P.all_stages(ngram=1, min_df=0.01, w_ct=1, w_pd=0.5, w_au=0.5)).fit(reviews)
    cells = X.sparse_cells(model.transform(reviews), "features")
    return cells.groupBy("id").agg(F.count(F.lit(1)).alias("n_cells"), F.round(F.sum("value"), 6).alias("total"))


@register("svd_projection")
def svd_projection(spark, sf_dir):
    reviews = review_text(spark, sf_dir).select("id", "content")
    stages = P.content_stages(1, min_df=0.01, outputCol="raw") + [X.TruncatedSVD(5, "raw", "reduced")]
    projected = Pipeline(stages=stages).fit(reviews).transform(reviews)
    return projected.select("id", F.transform(vector_to_array("reduced"), lambda x: F.round(F.abs(x), 6)).alias("components"))


def _predict(model, df):
    return M.predicted_rating(model, df).select("id", "rating", "prediction")


@register("logistic_regression")
def logistic_regression(spark, sf_dir):
    train, validate = _content_split(spark, sf_dir)
    return _predict(M.logistic_regression(1.0, train.count()).fit(train), validate)


@register("one_vs_rest")
def one_vs_rest(spark, sf_dir):
    """Language of every document from its content, by one binary regression per language, with the normalised probabilities."""
    docs = table(spark, sf_dir, "documents").where(F.col("lang").isNotNull())
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("content"), "lang")
    indexed = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    train, validate = holdout(indexed.transform(rows), 0.2)
    content = Pipeline(stages=P.content_stages(1, min_df=0.01, outputCol="features")).fit(train)
    train, validate = (checkpointed(content.transform(df).select("id", "label", "features")) for df in (train, validate))
    model = M.one_vs_rest(train, 1.0, len(indexed.labels))
    scored = M.class_probabilities(model, validate, "p")
    return scored.select("id", "label", F.transform("p", lambda v: F.round(v, 6)).alias("probabilities"))


@register("random_forest")
def random_forest(spark, sf_dir):
    train, validate = _content_split(spark, sf_dir, 10)
    return _predict(M.random_forest(10).fit(train), validate)


@register("mlp")
def mlp(spark, sf_dir):
    train, validate = _content_split(spark, sf_dir, 10)
    return _predict(M.mlp(M.feature_count(train), 10, _CLASSES, max_iter=50).fit(train), validate)


@register("mlp_learning_curve")
def mlp_learning_curve(spark, sf_dir):
    train, validate = _content_split(spark, sf_dir, 10)
    curve = M.learning_curve(train, validate, 10, max_batches=3, n_classes=_CLASSES)
    return spark.createDataFrame(curve.history, M.CURVE_SCHEMA)


@register("network_grid")
def network_grid(spark, sf_dir):
    """All 30 points of penalty and hidden width, in three folds; 90 tanh networks learn in one pass over the batches."""
    train, _ = _content_split(spark, sf_dir, 10)
    return N.network_search(train, n_classes=_CLASSES, n_batches=5)


@register("grid_search")
def grid_search(spark, sf_dir):
    """Each fold fits its own features."""
    grid = [U.candidate({"c": c}, (), lambda: P.content_stages(1, min_df=0.01), U.lr(c, True)) for c in (0.1, 1.0, 10.0)]
    rows = labelled_reviews(spark, sf_dir).select("id", "content", "rating", "label")
    return U.grid_search(checkpointed(rows), grid).summary


@register("repeated_holdout")
def repeated_holdout(spark, sf_dir):
    rows = checkpointed(labelled_reviews(spark, sf_dir).select("id", "content", "rating", "label"))
    grid = [
        U.candidate({"ngram": n}, ("ngram",), lambda n=n: P.content_stages(n, min_df=0.01), U.lr(1.0, False))
        for n in (1, 2)
    ]
    return U.repeated_holdout(rows, grid, (1, 2), test_size=0.2)


@register("ensemble_predict")
def ensemble_predict(spark, sf_dir):
    train, validate = _content_split(spark, sf_dir, 10)
    models = M.fit_ensemble(train, linear=True, n_classes=_CLASSES, max_iter=30)
    weights = (*M.ENSEMBLE_WEIGHTS, M.LINEAR_WEIGHT)
    return M.ensemble_predict(models, validate, weights, _CLASSES).select("id", "rating", "prediction")
