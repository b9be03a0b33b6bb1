"""One-vs-rest with probabilities against its binary models."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ratewise.operators.evaluation import soft_vote
from ratewise.plans import models as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = np.where(x[:, 0] > 0.5, 2, np.where(x[:, 1] > 0, 1, 0))
    data = [(i, Vectors.dense(r), float(c), int(c) + 1) for i, (r, c) in enumerate(zip(x.tolist(), y))]
    return spark.createDataFrame(data, ["id", "features", "label", "rating"])


def logit(model, x):
    return 1 / (1 + np.exp(-(model.coefficients.toArray() @ x + model.intercept)))


def test_normalised_votes_of_the_binary_fits(rows):
    found = M.one_vs_rest(rows, 10.0, 3)
    for r in found.transform(rows).collect():
        own = np.array([logit(m, r.features.toArray()) for m in found.models])
        assert np.allclose(r.probability.toArray(), own / own.sum()) and r.prediction == own.argmax()


def test_binary_fit_is_the_one_of_its_class(rows):
    third = M.logistic_regression(10.0, 300).setFamily("binomial").fit(rows.withColumn("label", (F.col("label") == 2).cast("double")))
    found = M.one_vs_rest(rows, 10.0, 3).models[2]
    assert np.allclose(found.coefficients.toArray(), third.coefficients.toArray(), atol=1e-6)


def test_class_without_rows_scores_and_votes(rows):
    found = M.one_vs_rest(rows, 10.0, 5)
    assert M.score(found, rows) < 0.3
    p = M.class_probabilities(found, rows, "p")
    assert p.columns == [*rows.columns, "p"]
    assert p.where((F.get("p", F.lit(3)) > 0) | (F.get("p", F.lit(4)) > 0)).count() == 0
    voted = soft_vote(p.withColumn("q", F.col("p")), ["p", "q"], [1.0, 2.0])
    assert voted.count() == 300


def test_equal_shares_where_no_model_speaks(rows):
    found = M.one_vs_rest(rows.where("label = 0"), 10.0, 3)
    silent = M.OneVsRest(found.models[1:])
    r = silent.transform(rows).first()
    assert r.probability.toArray().tolist() == [0.5, 0.5] and r.prediction == 0.0
