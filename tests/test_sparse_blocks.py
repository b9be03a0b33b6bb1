"""Feature matrices from distributed indexes against the stages that build vectors."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from ratewise.operators import features as X
from ratewise.operators import sparse_blocks as B
from ratewise.plans import features as P
from ratewise.plans import models as M
from ratewise.sources import tables as S

COLUMNS = "id long, content string, product string, author string, rating int"


@pytest.fixture(scope="module")
def reviews(spark):
    words = "good bad nice poor thing box cable light sound price again never".split()
    rows = [
        (i, " ".join(words[(i * k + k * k) % 12] for k in range(1, 3 + i % 9)), f"p{i % 7}", f"a{(i * 7) % 23}", 1 + i % 5) for i in range(90)
    ]
    rows += [(200, "", "p1", None, 3), (201, "unseen words only", "other", "new", 3), (202, None, None, None, 3)]
    return spark.createDataFrame(rows, COLUMNS)


def dense(features):
    return {r.id: r.features.toArray().round(9).tolist() for r in features.collect()}


@pytest.mark.parametrize("weights", [{}, {"content": 2.0, "product": 0.5, "author": 0.0}])
def test_equals_the_vector_stages(spark, reviews, weights):
    known = reviews.fillna("", ["content"])  # the stages do not take a null text
    train, test = known.where("id < 60"), known.where("id >= 60")
    w = {"w_ct": weights.get("content", 1), "w_pd": weights.get("product", 1), "w_au": weights.get("author", 1)}
    stages = P.all_stages(2, 0.9, 0.02, outputCol="raw", **w)
    want = dense(P.build_features(train, test, svd=False, stages=stages)[0])
    spec = P.default_spec(2, 0.9, 0.02)
    assert dense(P.build_wide_features(train, test, spec, svd=False, **weights)) == want


def test_null_columns_and_unseen_values(spark, reviews):
    train, test = reviews.where("id < 60"), reviews.where("id >= 60")
    got = {r.id: r for r in P.build_wide_features(train, test.drop("rating"), P.default_spec(1, 1.0, 0.0), svd=False).collect()}
    assert got[202].features.numNonzeros() == 0 == got[201].features.numNonzeros() and got[200].features.numNonzeros() == 1
    assert got[202].split == "test" and got[202].rating is None and got[5].rating == 1


def test_projection_equals_the_stage(spark, reviews):
    """With as many components as columns, the random basis spans them all and both are exact."""
    known = reviews.fillna("", ["content"])
    train, test = known.where("id < 60"), known.where("id >= 60")
    wide = P.build_wide_features(train, test, P.default_spec(1, 1.0, 0.0), svd=True, k=40)
    plain, _ = P.build_features(train, test, svd=True, k=40, stages=P.all_stages(1, 1.0, 0.0, outputCol="raw"))
    mine, other = ({r.id: r.features.toArray() for r in f.where("split = 'train'").collect()} for f in (wide, plain))
    mine, other = (np.array([rows[i] for i in sorted(rows)]) for rows in (mine, other))
    assert mine.shape[0] == 60 and mine.min() == 0 and np.isclose(mine.max(axis=0), 1).all()
    for j in range(5):  # a component may have the other sign: then it runs from 1 to 0
        assert min(np.abs(mine[:, j] - other[:, j]).max(), np.abs(mine[:, j] - 1 + other[:, j]).max()) < 1e-6


def test_stage_beyond_the_driver_limit(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 9)) * (rng.random((40, 9)) < 0.5)
    rows = [(i, Vectors.sparse(9, [(j, float(x)) for j, x in enumerate(r) if x])) for i, r in enumerate(a)] + [(99, Vectors.sparse(9, []))]
    df = spark.createDataFrame(rows, ["id", "features"])
    near, far = X.TruncatedSVD(3).fit(df), X.TruncatedSVD(3, driver_cells=10).fit(df)
    assert isinstance(far, X.SparseProjection)
    one, two = ({r.id: r.reduced.toArray() for r in m.transform(df).collect()} for m in (near, far))
    assert one.keys() == two.keys() and all(np.allclose(np.abs(one[i]), np.abs(two[i]), atol=1e-6) for i in one)


def test_chosen_columns_equal_dense_scores(spark):
    rng = np.random.default_rng(5)
    a = rng.random((80, 14)) * (rng.random((80, 14)) < 0.3)
    a[:, 3] = 0
    a[:, 9] = a[:, 2]
    label = rng.integers(0, 3, 80)
    df = spark.createDataFrame([(Vectors.dense(r), float(c)) for r, c in zip(a, label)], ["features", "label"])
    observed = np.array([a[label == c].sum(axis=0) for c in range(3)])
    expected = np.outer([(label == c).mean() for c in range(3)], a.sum(axis=0))
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.nan_to_num((observed - expected) ** 2 / expected).sum(axis=0).round(9)
    for k in (1, 5, 13, 14, 50):
        want = sorted(sorted(range(14), key=lambda i: (score[i], i))[::-1][:k])
        assert list(X.SelectKBest(k).fit(df).getIndices()) == want


def test_many_values_in_small_memory(spark, folder):
    """More values than the vector stage allows in a list would be; none is collected."""
    rows = spark.range(300_000).selectExpr("id", "concat('w', id % 50) as content", "'p' as product", "concat('a', id) as author", "1 as rating")
    index = B.fit_blocks(rows, P.default_spec(1, 1.0, 0.0))
    assert [b.size for b in index.blocks] == [50, 1, 300_000]
    features = B.stored_vectors(rows.select("id", "rating"), index.cells(rows), index.size, f"{folder}/v")
    assert features.count() == 300_000 and features.first().features.size == 300_051
    S.save_features(features.selectExpr("id", "features", "rating", "'train' as split"), f"{folder}/f")
    assert M.with_label(S.load_features(spark, f"{folder}/f")).count() == 300_000
