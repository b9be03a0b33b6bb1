"""Whole workflows over the driver's tables: sinks read back, feature builds, model runs and searches."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.functions.stopwords import LANGUAGES
from ratewise.operators import features as X
from ratewise.operators.distributions import predict_average, predict_zero
from ratewise.operators.evaluation import holdout, mae
from ratewise.operators.language import detect_language, language_counts
from ratewise.plans import features as P
from ratewise.plans import models as M
from ratewise.plans import tuning as U
from ratewise.plans.model_queries import labelled_reviews
from ratewise.plans.registration import registrar
from ratewise.plans.text_queries import DETECTED_SQL, LISTS_SQL, TEXT_SQL
from ratewise.schema import FEATURES, REVIEW
from ratewise.session import checkpointed, scratch_path
from ratewise.sources import tables as S
from ratewise.sources.bindings import review_text, table

QUERIES, ORACLE, register = registrar()

_CLASSES = 2


# --- sinks, each written to the shared folder and read back -------------------------------


@register(
    "dataset_cache",
    """SELECT doc_id AS id, 'u' || CAST(doc_id % 97 AS VARCHAR) AS author, source AS product, text AS content,
      CAST(1 + doc_id % 5 AS INTEGER) AS rating, 'train' AS split FROM documents WHERE doc_id % 3 <> 0""",
)
def dataset_cache(spark, sf_dir):
    """The training part of the review table, by its partition."""
    path = scratch_path(spark, "dataset")
    reviews = review_text(spark, sf_dir).withColumn("split", F.when(F.col("id") % 3 == 0, "test").otherwise("train"))
    known = [F.col(f.name) if f.name in reviews.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in REVIEW]
    S.write_dataset(reviews.select(*known), path)
    return S.load_dataset(spark, path, "train").select("id", "author", "product", "content", "rating", "split")


@register(
    "feature_table",
    """SELECT vec_id AS id, CAST(unnest(range(len(embedding))) AS INTEGER) AS idx, CAST(unnest(embedding) AS DOUBLE) AS value,
      CASE WHEN vec_id % 4 = 0 THEN 'test' ELSE 'train' END AS split FROM embeddings""",
)
def feature_table(spark, sf_dir):
    path = scratch_path(spark, "features")
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.lit(None).cast("int").alias("rating"),
        F.when(F.col("vec_id") % 4 == 0, "test").otherwise("train").alias("split"),
    )
    S.save_features(vectors.select(*FEATURES.fieldNames()), path)
    parts = [X.vector_cells(S.load_features(spark, path, part), "features").withColumn("split", F.lit(part)) for part in ("train", "test")]
    return parts[0].unionByName(parts[1])


@register(
    "prediction_store",
    """WITH t AS (SELECT CAST(round(avg(1 + doc_id % 5), 9) AS DOUBLE) AS mean FROM documents WHERE doc_id % 3 <> 0)
    SELECT 'average' AS model, doc_id AS id, mean AS prediction FROM documents, t WHERE doc_id % 3 = 0
    UNION ALL SELECT 'zero', doc_id, 0.0::DOUBLE FROM documents WHERE doc_id % 3 = 0""",
)
def prediction_store(spark, sf_dir):
    """Both baselines appended to one store."""
    path = scratch_path(spark, "predictions")
    reviews = review_text(spark, sf_dir).select("id", "rating")
    train, test = reviews.where(F.col("id") % 3 != 0), reviews.where(F.col("id") % 3 == 0)
    S.append_predictions(predict_average(train, test), path, "average")
    S.append_predictions(predict_zero(test), path, "zero")
    return S.load_predictions(spark, path).withColumn("prediction", F.round("prediction", 9))


@register(
    "submission_csv",
    """SELECT CAST(doc_id AS VARCHAR) AS id, CAST(1 + doc_id % 5 AS VARCHAR) || '.250000000000000000' AS rating FROM documents""",
)
def submission_csv(spark, sf_dir):
    path = scratch_path(spark, "submission")
    S.write_submission(review_text(spark, sf_dir).select("id", (F.col("rating") + 0.25).alias("prediction")), path)
    return spark.read.option("header", True).option("quote", "|").option("lineSep", "\r\n").csv(path)


@register(
    "submission_parts",
    """SELECT 'id,rating' AS line UNION ALL
    SELECT CAST(doc_id AS VARCHAR) || ',' || CAST(1 + doc_id % 5 AS VARCHAR) || '.250000000000000000' FROM documents""",
)
def submission_parts(spark, sf_dir):
    """Lines of the submission whose parts join to one file."""
    path = scratch_path(spark, "submission")
    S.write_submission_parts(review_text(spark, sf_dir).select("id", (F.col("rating") + 0.25).alias("prediction")), path)
    return spark.read.option("lineSep", "\r\n").text(path).withColumnRenamed("value", "line")


@register(
    "report_file",
    f"""WITH {TEXT_SQL}, {LISTS_SQL}, {DETECTED_SQL} SELECT language, CAST(count(*) AS VARCHAR) AS n FROM detected GROUP BY 1""",
)
def report_file(spark, sf_dir):
    """The language report as a CSV file."""
    path = scratch_path(spark, "report")
    S.write_report(language_counts(detect_language(review_text(spark, sf_dir))).limit(len(LANGUAGES) + 1), path)
    return spark.read.option("header", True).csv(path)


# --- feature builds ------------------------------------------------------------------------


def _both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    reviews = review_text(spark, sf_dir).select("id", "content", "product", "author", "rating")
    return reviews.where(F.col("id") % 3 != 0), reviews.where(F.col("id") % 3 == 0)


def _summary(features: DataFrame) -> DataFrame:
    cells = X.sparse_cells(features, "features").groupBy("id").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.max("value"), 6).alias("largest")
    )
    return features.select("id", "split").join(cells, "id", "left")


@register("feature_build_sparse")
def feature_build_sparse(spark, sf_dir):
    """Content, product and author of all documents, fitted on the training part, scaled by the largest values."""
    train, test = _both(spark, sf_dir)
    return _summary(P.build_features(train, test, svd=False, stages=P.all_stages(1, min_df=0.01, outputCol="raw"))[0])


@register("feature_build_svd")
def feature_build_svd(spark, sf_dir):
    """The same blocks projected to five components in [0, 1]."""
    train, test = _both(spark, sf_dir)
    return _summary(P.build_features(train, test, svd=True, k=5, stages=P.all_stages(1, min_df=0.01, outputCol="raw"))[0])


@register("content_svd_union")
def content_svd_union(spark, sf_dir):
    """Content reduced to four components beside product and author."""
    train, test = _both(spark, sf_dir)
    model = Pipeline(stages=P.all_stages(1, min_df=0.01, k=4)).fit(train)
    cells = X.sparse_cells(model.transform(test), "features")
    return cells.groupBy("id").agg(F.count(F.lit(1)).alias("n_cells"))


# --- model runs: split first, features fitted on the training part --------------------------


def _features(spark: SparkSession, sf_dir: str, k: int = 8) -> DataFrame:
    """(id, features, rating, split) of the labelled documents; the test part has no rating."""
    rows = labelled_reviews(spark, sf_dir).select("id", "content", "rating")
    train, test = holdout(rows, 0.2)
    stages = P.content_stages(1, min_df=0.01, outputCol="raw")
    built, _ = P.build_features(train, test, svd=True, k=k, stages=stages)
    return checkpointed(built)


def _split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = M.with_label(features)
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


def _mean_baseline(train: DataFrame, test: DataFrame) -> float:
    return mae(predict_average(train, test)).first().mae


@register("validation_report")
def validation_report(spark, sf_dir):
    """Learning curve and confusion matrix of a network, with the error of the mean beside them."""
    train, test = _split(_features(spark, sf_dir))
    report = M.validation_report(train, test, 8, n_classes=_CLASSES, max_batches=3, iterations=15)
    return report.withColumn("mae_mean", F.lit(_mean_baseline(train, test)))


@register("vote_learning_curve")
def vote_learning_curve(spark, sf_dir):
    """Errors of each network and of their vote after every batch."""
    train, test = _split(_features(spark, sf_dir))
    curve = M.vote_learning_curve(train, test, widths=(6, 4, 5), weights=(0.5, 0.3, 0.2), n_classes=_CLASSES, max_batches=3, iterations=15)
    return spark.createDataFrame(curve, "batch int, model string, mae_train double, mae_validate double")


@register("ensemble_submission")
def ensemble_submission(spark, sf_dir):
    """Votes with and without the linear model, stored, submitted and read back."""
    train, test = _split(_features(spark, sf_dir))
    store, made = scratch_path(spark, "votes"), []
    for linear in (False, True):
        weights = (*M.ENSEMBLE_WEIGHTS[:3], *((M.LINEAR_WEIGHT,) if linear else ()))
        models = M.fit_ensemble(train, M.ENSEMBLE_WIDTHS[:3], linear, _CLASSES, max_iter=15)
        voted = M.ensemble_predict(models, test, weights, _CLASSES).select("id", "prediction")
        name, path = f"vote{'_linear' if linear else ''}", scratch_path(spark, "submission")
        S.append_predictions(voted, store, name)
        S.write_submission(voted, path)
        made.append(spark.read.option("header", True).option("quote", "|").option("lineSep", "\r\n").csv(path).withColumn("model", F.lit(name)))
    submitted = made[0].unionByName(made[1]).select("model", F.col("id").cast("long").alias("id"), F.col("rating").cast("double").alias("submitted"))
    return S.load_predictions(spark, store).join(submitted, ["model", "id"])


@register("linear_single_run")
def linear_single_run(spark, sf_dir):
    """Errors of one L1 regression on a hold-out of the training part."""
    features = _features(spark, sf_dir)
    scores = M.evaluate_linear(features, c=1.0)
    train, test = _split(features)
    return spark.createDataFrame(
        [(scores["score_training"], scores["score_validate"], _mean_baseline(train, test))],
        "score_training double, score_validate double, mae_mean double",
    )


@register("train_and_predict")
def train_and_predict(spark, sf_dir):
    """A network over all training rows, and its stored predictions of the test rows."""
    path = scratch_path(spark, "predictions")
    M.train_and_predict(_features(spark, sf_dir), 8, path, n_classes=_CLASSES, max_batches=3, iterations=15)
    return S.load_predictions(spark, path)


# --- searches: one row per distinct point and seed, from the log ------------------------------


def _search(spark: SparkSession, sf_dir: str, points: list, *columns: str) -> DataFrame:
    rows = checkpointed(labelled_reviews(spark, sf_dir).select("id", "content", "product", "author", "rating", "label"))
    log = scratch_path(spark, "trials")
    U.repeated_holdout(rows, points, (1, 2), log_path=log, test_size=0.2)
    return spark.read.parquet(log).select(*columns, "seed", "score_training", "score_validate")


@register("weight_search")
def weight_search(spark, sf_dir):
    points = [
        U.candidate({"w_ct": ct, "w_pd": pd, "w_au": 0.0}, ("w_ct", "w_pd", "w_au"),
                    lambda ct=ct, pd=pd: P.all_stages(1, min_df=0.02, w_ct=ct, w_pd=pd, w_au=0), U.lr(1.0, False))
        for ct in (0.5, 5.0) for pd in (0.0, 1.0)
    ]
    return _search(spark, sf_dir, points, "w_ct", "w_pd", "w_au")


@register("reduction_search")
def reduction_search(spark, sf_dir):
    """Both reductions; a number of features beyond those there are is the same point as all of them."""
    grid = [*U.reduction_grid("svd", (3, 6), ngram=1, min_df=0.02), *U.reduction_grid("kbest", (5, 50), ngram=1, min_df=0.02)]
    return _search(spark, sf_dir, grid, "method", "k")


@register("forest_grid")
def forest_grid(spark, sf_dir):
    """Forests by depth; depths beyond Spark's limit are one point."""
    points = U.distinct_candidates(
        U.candidate({"max_depth": U.depth(d)}, (), lambda: P.content_stages(1, min_df=0.02), lambda _, __, d=d: M.random_forest(d))
        for d in (2.0, 5.0, 100.0, 1000.0)
    )
    return _search(spark, sf_dir, points, "max_depth")
