"""Classifiers of the rating, incremental training, ensembles and prediction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.functions.numeric import clamp_round, class_of_best, mean_absolute_error
from ratewise.operators.evaluation import confusion_matrix, holdout, numbered_batches, soft_vote
from ratewise.session import scratch_path
from ratewise.sources.tables import append_predictions, write_submission

N_CLASSES = 5
MAX_DEPTH = 30  # Spark's limit

# Hidden widths of the voting networks, their weights, and the linear model's.
ENSEMBLE_WIDTHS = (50, 10, 20, 10, 15)
ENSEMBLE_WEIGHTS = (0.3, 0.27, 0.24, 0.21, 0.18)
LINEAR_WEIGHT = 1.0
LINEAR_C = 1.3


def with_label(df: DataFrame) -> DataFrame:
    """Add ``label``, the 0-based class of the rating."""
    return df.withColumn("label", (F.col("rating") - 1).cast("double"))


def logistic_regression(c: float, n_rows: int, l1: bool = False, max_iter: int = 100) -> LogisticRegression:
    """Multinomial regression; ``c`` is the inverse penalty on the summed loss.

    Spark penalises the mean loss, hence the division by the number of rows.
    """
    return LogisticRegression(
        family="multinomial",
        regParam=1.0 / (c * max(n_rows, 1)),
        elasticNetParam=1.0 if l1 else 0.0,
        standardization=False,
        maxIter=max_iter,
    )


@dataclass
class OneVsRest:
    """A binary regression for each class; the class probabilities are their probabilities, normalised.

    Spark's own one-vs-rest gives a class only. ``transform`` adds ``probability``
    and ``prediction`` as the other classifiers do, so it takes part in votes and
    scores. Ties go to the first class; where every binary model gives 0, all
    classes get equal shares. A class without training rows gets 0 elsewhere.
    """

    models: list[Model]

    def transform(self, df: DataFrame) -> DataFrame:
        scored = df
        for i, model in enumerate(self.models):
            named = model.copy().setProbabilityCol(f"_p{i}").setRawPredictionCol("").setPredictionCol("")
            scored = named.transform(scored).withColumn(f"_p{i}", F.get(vector_to_array(f"_p{i}"), F.lit(1)))
        own = [F.col(f"_p{i}") for i in range(len(self.models))]
        total = sum(own[1:], own[0])
        shares = F.array(*[F.when(total > 0, p / total).otherwise(F.lit(1.0 / len(own))) for p in own])
        return (
            scored.withColumn("_shares", shares)
            .withColumn("probability", array_to_vector("_shares"))
            .withColumn("prediction", (class_of_best(F.col("_shares")) - 1).cast("double"))
            .drop("_shares", *[f"_p{i}" for i in range(len(own))])
        )


def one_vs_rest(
    train: DataFrame, c: float, n_classes: int = N_CLASSES, l1: bool = False, max_iter: int = 100
) -> OneVsRest:
    """Binary regressions of each class against the others; ``c`` as in :func:`logistic_regression`.

    The features are kept in the executors while the classes are fitted one after another.
    """
    rows = train.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        learner = logistic_regression(c, rows.count(), l1, max_iter).setFamily("binomial").setLabelCol("_is_class")
        return OneVsRest(
            [learner.fit(rows.withColumn("_is_class", (F.col("label") == k).cast("double"))) for k in range(n_classes)]
        )
    finally:
        rows.unpersist()


def random_forest(max_depth: float, n_trees: int = 10, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=n_trees, maxDepth=int(min(max_depth, MAX_DEPTH)), impurity="gini", seed=seed)


def feature_count(df: DataFrame) -> int:
    return df.select("features").first().features.size


def mlp(
    n_features: int, hidden: int, n_classes: int = N_CLASSES, seed: int = 42, max_iter: int = 100, solver: str = "l-bfgs", step: float = 0.03
) -> MultilayerPerceptronClassifier:
    """One hidden layer. Spark's network is sigmoid and has no weight penalty."""
    return MultilayerPerceptronClassifier(
        layers=[n_features, hidden, n_classes], seed=seed, maxIter=max_iter, solver=solver, stepSize=step
    )


def predicted_rating(model: Model, df: DataFrame) -> DataFrame:
    """``prediction`` as a rating (class index + 1), rounded and clipped."""
    scored = model.transform(df)
    return scored.withColumn("prediction", clamp_round(F.col("prediction") + 1))


def class_probabilities(model: Model, df: DataFrame, name: str) -> DataFrame:
    """Add array column ``name`` with the probability of each class."""
    drop = ["rawPrediction", "probability", "prediction"]
    return model.transform(df).withColumn(name, vector_to_array("probability")).drop(*drop)


def score(model: Model, df: DataFrame) -> float:
    """Mean absolute error of the predicted ratings."""
    rated = predicted_rating(model, df)
    return rated.agg(mean_absolute_error(F.col("rating"), F.col("prediction")).alias("mae")).first().mae


# --- incremental training -----------------------------------------------------------


@dataclass
class Curve:
    model: MultilayerPerceptronClassificationModel
    history: list[dict]


def batch_table(df: DataFrame, batch_size: int | None = None, n_batches: int | None = None) -> tuple[str, int]:
    """Rows written by batch, so that a step reads its own batch only; (path, batches)."""
    path = scratch_path(df.sparkSession, "batches")
    numbered = numbered_batches(df, batch_size, n_batches)
    # Ranges of (batch, hash): a task writes a batch or two, and a batch is spread over tasks.
    ranged = numbered.repartitionByRange("batch_no", F.xxhash64("id"))
    ranged.write.partitionBy("batch_no").parquet(path)
    # Without a batch there is no file to take the schema from.
    stored = df.sparkSession.read.schema(numbered.schema).parquet(path)
    last = stored.agg(F.max("batch_no").alias("m")).first().m
    return path, 0 if last is None else int(last) + 1


def learning_curve(
    train: DataFrame,
    validate: DataFrame | None,
    hidden: int,
    batch_size: int | None = None,
    max_batches: int = 20,
    n_classes: int = N_CLASSES,
    iterations: int = 20,
    evaluate_every: int = 1,
) -> Curve:
    """One pass over batches, each continuing from the weights of the last.

    Without a batch size all rows are dealt over ``max_batches`` steps whatever
    the data size: a step is a Spark job and has to be worth one.
    """
    rows = train.select("id", "features", "rating", "label")
    path, n_batches = batch_table(rows, batch_size, None if batch_size else max_batches)
    if n_batches == 0:
        raise ValueError("fewer rows than one batch")
    stored = train.sparkSession.read.parquet(path)
    n_features, model, history = feature_count(train), None, []
    for i in range(n_batches):
        model = _step(model, stored.where(F.col("batch_no") == i), n_features, hidden, n_classes, iterations)
        if (i + 1) % evaluate_every == 0 or i + 1 == n_batches:
            history.append(
                {
                    "batch": i,
                    "mae_train": score(model, train),
                    "mae_validate": score(model, validate) if validate is not None else None,
                }
            )
    return Curve(model, history)


def _step(model, batch: DataFrame, n_features: int, hidden: int, n_classes: int, iterations: int, seed: int = 42):
    """A network trained on from ``model``'s weights, or from the start."""
    learner = mlp(n_features, hidden, n_classes, seed=seed, max_iter=iterations)
    return (learner if model is None else learner.setInitialWeights(model.weights)).fit(batch)


def validation_report(train: DataFrame, validate: DataFrame, hidden: int, n_classes: int = N_CLASSES, **curve) -> DataFrame:
    """Learning curve (section ``curve``, step = batch) and, after the last batch, confusion
    matrix of the validation rows (section ``confusion``, step = predicted class)."""
    fitted = learning_curve(train, validate, hidden, n_classes=n_classes, **curve)
    spark = train.sparkSession
    steps = spark.createDataFrame(fitted.history, CURVE_SCHEMA).withColumnRenamed("batch", "step")
    counts = confusion_matrix(predicted_rating(fitted.model, validate), range(1, n_classes + 1)).withColumnRenamed("prediction", "step")
    return steps.withColumn("section", F.lit("curve")).unionByName(
        counts.withColumn("section", F.lit("confusion")), allowMissingColumns=True
    )


CURVE_SCHEMA = "batch int, mae_train double, mae_validate double"


# --- ensembles -----------------------------------------------------------------------


def fit_ensemble(
    train: DataFrame,
    widths: Sequence[int] = ENSEMBLE_WIDTHS,
    linear: bool = False,
    n_classes: int = N_CLASSES,
    max_iter: int = 100,
) -> list[Model]:
    """The voting networks, and the linear model last if asked for.

    All members train on the same rows, kept on executors meanwhile.
    """
    rows = train.select("features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_features = feature_count(rows)
        models = [mlp(n_features, w, n_classes, seed=i, max_iter=max_iter).fit(rows) for i, w in enumerate(widths)]
        if linear:
            models.append(logistic_regression(LINEAR_C, rows.count(), l1=True, max_iter=max_iter).fit(rows))
        return models
    finally:
        rows.unpersist()


def ensemble_predict(models: Sequence[Model], df: DataFrame, weights: Sequence[float] | None = None, n_classes: int = N_CLASSES) -> DataFrame:
    """Soft vote of all models in one pass over ``df``; ``prediction`` is a rating."""
    names = [f"p{i}" for i in range(len(models))]
    for model, name in zip(models, names):
        df = class_probabilities(model, df, name)
    voted = soft_vote(df, names, weights, n_classes)
    return voted.withColumn("prediction", F.col("vote").cast("double")).drop(*names, "vote")


def _vote_scores(models: Sequence[Model], df: DataFrame, weights: Sequence[float], n_classes: int) -> list[float]:
    """Errors of each model and, last, of their vote, in one pass."""
    names = [f"p{i}" for i in range(len(models))]
    for model, name in zip(models, names):
        df = class_probabilities(model, df, name)
    voted = soft_vote(df, names, weights, n_classes)
    error = lambda rating: mean_absolute_error(F.col("rating"), rating)
    row = voted.agg(*[error(class_of_best(F.col(n))).alias(n) for n in names], error(F.col("vote")).alias("vote")).first()
    return list(row)


def vote_learning_curve(
    train: DataFrame,
    validate: DataFrame,
    widths: Sequence[int] = ENSEMBLE_WIDTHS,
    weights: Sequence[float] = ENSEMBLE_WEIGHTS,
    n_classes: int = N_CLASSES,
    batch_size: int | None = None,
    max_batches: int = 20,
    iterations: int = 20,
) -> list[dict]:
    """All networks trained batch by batch; rows (batch, model, mae_train, mae_validate), model ``vote`` for all together."""
    rows = train.select("id", "features", "rating", "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        path, n_batches = batch_table(rows, batch_size, None if batch_size else max_batches)
        stored = train.sparkSession.read.parquet(path)
        n_features = feature_count(rows)
        models: list = [None] * len(widths)
        history = []
        for i in range(n_batches):
            batch = stored.where(F.col("batch_no") == i)
            models = [_step(m, batch, n_features, w, n_classes, iterations, seed=k) for k, (m, w) in enumerate(zip(models, widths))]
            scores = zip(_vote_scores(models, rows, weights, n_classes), _vote_scores(models, validate, weights, n_classes))
            names = [*(f"mlp_{w}" for w in widths), "vote"]
            history += [{"batch": i, "model": n, "mae_train": a, "mae_validate": b} for n, (a, b) in zip(names, scores)]
        return history
    finally:
        rows.unpersist()


# --- workflows -------------------------------------------------------------------------


def evaluate_linear(features: DataFrame, c: float = 1e-3, seed: int = 659) -> dict:
    """Hold-out error of an L1 logistic regression on a feature table."""
    train, validate = holdout(with_label(features.where(F.col("split") == "train")), seed=seed)
    model = logistic_regression(c, train.count(), l1=True).fit(train)
    return {"score_training": score(model, train), "score_validate": score(model, validate)}


def train_and_predict(
    features: DataFrame, hidden: int = 50, predictions_path: str | None = None, submission_path: str | None = None, n_classes: int = N_CLASSES, **curve
) -> DataFrame:
    """Train on every training row, predict the test rows, store and submit."""
    train = with_label(features.where(F.col("split") == "train"))
    fitted = learning_curve(train, None, hidden, n_classes=n_classes, **curve)
    predictions = predicted_rating(fitted.model, features.where(F.col("split") == "test")).select("id", "prediction")
    if predictions_path:
        append_predictions(predictions, predictions_path, "mlp")
    if submission_path:
        write_submission(predictions, submission_path)
    return predictions
