import glob

import pytest
from pyspark.ml.linalg import Vectors

from ratewise.operators.distributions import predict_average
from ratewise.operators.evaluation import mae
from ratewise.plans import features as P
from ratewise.plans import models as M
from ratewise.plans import tuning as U
from ratewise.sources import tables as S

WORDS = ["awful", "poor", "fair", "good", "great"]


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [
        (i, f"a{i % 11}", f"p{i % 7}", f"{WORDS[i % 5]} {WORDS[i % 5]} thing number{i % 4}", 1 + i % 5)
        for i in range(200)
    ]
    return M.with_label(spark.createDataFrame(rows, "id long, author string, product string, content string, rating int"))


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, Vectors.dense([float(i % 5 == c) for c in range(5)]), 1 + i % 5, "train") for i in range(200)]
    rows += [(1000 + i, Vectors.dense([float(i % 5 == c) for c in range(5)]), None, "test") for i in range(10)]
    return spark.createDataFrame(rows, S.FEATURES).cache()


def baseline(df):
    return mae(predict_average(df, df)).first().mae


def test_classifiers_beat_the_mean(vectors):
    train = M.with_label(vectors.where("split = 'train'"))
    limit = baseline(train)
    for learner in (
        M.logistic_regression(1.0, 200),
        M.logistic_regression(1.0, 200, l1=True),
        M.random_forest(10_000),
        M.mlp(5, 8, max_iter=60),
    ):
        assert M.score(learner.fit(train), train) < limit / 2


def test_learning_curve_and_prediction(spark, vectors, folder):
    train = M.with_label(vectors.where("split = 'train'"))
    curve = M.learning_curve(train, train, 8, batch_size=60, iterations=60, )
    assert [h["batch"] for h in curve.history] == [0, 1, 2]
    out = M.train_and_predict(vectors, 8, folder + "/p", folder + "/s", max_batches=2, iterations=5)
    assert out.count() == 10
    assert S.load_predictions(spark, folder + "/p").count() == 10
    assert glob.glob(folder + "/s/part-*.csv")
    assert set(M.evaluate_linear(vectors, c=1.0)) == {"score_training", "score_validate"}


def test_ensemble_of_one_is_that_model(vectors):
    train = M.with_label(vectors.where("split = 'train'"))
    models = M.fit_ensemble(train, (4,), max_iter=40)
    voted = M.ensemble_predict(models, train).select("id", "prediction").collect()
    alone = M.predicted_rating(models[0], train).select("id", "prediction").collect()
    assert {tuple(r) for r in voted} == {tuple(r) for r in alone}


def test_feature_build(spark, reviews, folder):
    train, test = reviews.where("id < 150"), reviews.where("id >= 150").drop("rating", "label")
    stages = lambda: P.all_stages(ngram=1, max_df=1.0, min_df=0.01, w_ct=2, outputCol="raw")
    features, model = P.build_features(train, test, svd=False, stages=stages())
    S.save_features(features, folder + "/f", model)
    stored = S.load_features(spark, folder + "/f")
    assert stored.where("split = 'train'").count() == 150
    assert stored.where("split = 'test' and rating is null").count() == 50
    reduced, _ = P.build_features(train, test, svd=True, k=4, stages=stages())
    assert all(r.features.size == 4 for r in reduced.take(3))


def test_searches(spark, reviews, folder):
    grid = [
        U.candidate({"k": k, "c": c}, ("k",), lambda k=k: _kbest(k), U.lr(c, False)) for k in (2, 5) for c in (0.01, 10.0)
    ]
    trials = U.repeated_holdout(reviews, grid, (1, 2), folder + "/log", test_size=0.3)
    assert trials.count() == 8 == spark.read.parquet(folder + "/log").count()
    search = U.grid_search(reviews, grid)
    assert search.summary.count() == 4 and search.trials.count() == 12
    assert search.best["mean_score_validate"] == min(r.mean_score_validate for r in search.summary.collect())
    assert search.model.transform(reviews).count() == 200


def _kbest(k):
    from ratewise.operators.features import SelectKBest

    return P.content_stages(1, max_df=1.0, min_df=0.0, outputCol="raw") + [SelectKBest(k, "raw", "features")]


def test_grid_sizes():
    sizes = {n: len(U.linear_grid(n)) for n in ("lr", "lr_all", "lr_all_svd", "lr_mixed_svd", "rf_all", "other")}
    assert sizes == {"lr": 15, "lr_all": 15, "lr_all_svd": 24, "lr_mixed_svd": 25, "rf_all": 9, "other": 15}  # depths beyond 30 are one
    assert len(U.content_grid()) == 40 and len(U.weight_grid()) == 125
    assert len(U.reduction_grid("svd")) == 20 and len(U.mlp_grid()) == 5
    with pytest.raises(ValueError):
        U.reduction_grid("pca", [3])[0].stages()


def test_equal_points_are_one_and_a_failed_trial_is_kept(spark, reviews, folder):
    assert [c.params["k"] for c in U.reduction_grid("kbest", [3, 9, 50, 70], n_features=9)] == [3, 9]
    good = U.candidate({"k": 2}, ("k",), lambda: _kbest(2), U.lr(1.0, False))
    bad = U.candidate({"k": 3}, ("k",), lambda: P.content_stages(1, min_df=0.9, max_df=0.91), U.lr(1.0, False))
    trials = {r.k: r for r in U.repeated_holdout(reviews, [good, bad], (1,), folder + "/log", test_size=0.3).collect()}
    assert trials[2].score_validate is not None and trials[3].score_validate is None
    assert spark.read.parquet(folder + "/log").count() == 2


def test_reports_of_networks(vectors):
    train = M.with_label(vectors.where("split = 'train'"))
    rows = M.validation_report(train, train, 8, max_batches=3, iterations=30).collect()
    curve = [r for r in rows if r.section == "curve"]
    matrix = [r for r in rows if r.section == "confusion"]
    assert [r.step for r in sorted(curve, key=lambda r: r.step)] == [0, 1, 2] and len(matrix) == 5
    assert sum(r[f"truth_{c}"] for r in matrix for c in range(1, 6)) == 200
    voted = M.vote_learning_curve(train, train, (4, 6), (0.6, 0.4), max_batches=2, iterations=30)
    assert [(r["batch"], r["model"]) for r in voted] == [(b, m) for b in (0, 1) for m in ("mlp_4", "mlp_6", "vote")]
    assert all(0 <= r["mae_train"] == r["mae_validate"] <= 4 for r in voted)


def test_weighted_one_hot_with_a_null_value(spark):
    from ratewise.operators.features import OneHotBlock

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id long, product string")
    rows = {r.id: r.v.toArray().tolist() for r in OneHotBlock("product", "v", 0.5).fit(df).transform(df).collect()}
    assert rows == {1: [0.5, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.5]}


def test_lemmas_in_vectors_equal_the_long_form(spark):
    from ratewise.operators import tfidf as V
    from ratewise.operators.features import sparse_cells

    texts = ["cats and a cat", "boxes of the box", "cat in boxes", "dogs dog dogs"]
    reviews = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("boxes", "box"), ("dogs", "dog")], "form string, lemma string")
    stages = P.content_stages(1, max_df=1.0, min_df=0.0, lemmas=lemmas)
    from pyspark.ml import Pipeline

    model = Pipeline(stages=stages).fit(reviews)
    vector = sorted((r.id, round(r.value, 9)) for r in sparse_cells(model.transform(reviews), "features").collect())
    spec = P.default_spec(1, 1.0, 0.0)
    cells = V.tfidf(reviews, spec, lemmas).collect()
    assert sorted((r.id, round(r.value, 9)) for r in cells) == vector
    assert {r.term for r in cells} == {"cat", "box", "dog"}


def test_document_frequency_follows_from_its_idf(spark):
    import math

    from ratewise.operators import tfidf as V

    reviews = spark.createDataFrame([(i, " ".join(f"t{k}" for k in range(i))) for i in range(1, 30)], "id long, content string")
    for r in V.document_frequency(reviews).collect():
        assert round((29 + 1) / math.exp(r.idf - 1) - 1) == r.df


def test_sparse_cells_of_both_kinds_of_vector(spark):
    from ratewise.operators.features import sparse_cells

    rows = [(1, Vectors.dense([0.0, 2.0])), (2, Vectors.sparse(5, [1, 4], [0.0, 3.0])), (3, Vectors.sparse(5, [], []))]
    cells = sparse_cells(spark.createDataFrame(rows, ["id", "v"]), "v").collect()
    assert sorted(map(tuple, cells)) == [(1, 1, 2.0), (2, 4, 3.0)]


def test_tfidf_is_the_same_without_a_broadcast_vocabulary(spark):
    from ratewise.operators import tfidf as V

    reviews = spark.createDataFrame([(i, f"all common t{i % 4} t{i % 7} only{i}") for i in range(40)], "id long, content string")
    spec = V.TermSpec(1, 2, 0.05, 0.5)
    cells = lambda df: sorted((r.id, r.term, round(r.value, 9)) for r in df.collect())
    frequency = V.fit_frequency(reviews, spec)
    frequent = spark.createDataFrame([("all",), ("common",), ("all common",)], "term string")
    want = cells(V.tfidf(reviews, spec))
    assert want == cells(V.weigh(reviews, spec, frequency, None, frequent, broadcast_rows=0))
    assert want == cells(V.weigh(reviews, spec, frequency, broadcast_rows=0))


def test_an_interrupted_search_repeats_no_trial(spark, reviews, folder, monkeypatch):
    grid = [U.candidate({"k": k, "c": c}, ("k",), lambda k=k: _kbest(k), U.lr(c, False)) for k in (2, 5) for c in (0.01, 10)]
    real, ran = U._run_group, []

    def counted(train, validate, group, seed):
        ran.extend((c.params["k"], c.params["c"], seed) for c in group)
        return real(train, validate, group, seed)

    monkeypatch.setattr(U, "_run_group", counted)
    log = folder + "/log"
    # As left by a search that ended after one seed and a part of the other.
    U.repeated_holdout(reviews, grid, (1,), log, test_size=0.3, resume=True)
    U.repeated_holdout(reviews, grid[:1], (2,), log, test_size=0.3)
    before = {(r.k, r.c, r.seed): r.score_validate for r in spark.read.parquet(log).collect()}
    assert len(before) == 5
    ran.clear()
    trials = U.repeated_holdout(reviews, grid, (1, 2), log, test_size=0.3, resume=True).collect()
    assert sorted(ran) == [(2, 10, 2), (5, 0.01, 2), (5, 10, 2)]
    assert len(trials) == 8 == spark.read.parquet(log).count()
    assert all(r.score_validate == before[r.k, r.c, r.seed] for r in trials if (r.k, r.c, r.seed) in before)
    ran.clear()
    assert U.repeated_holdout(reviews, grid, (1, 2), log, test_size=0.3, resume=True).count() == 8 and not ran


def test_settings_that_differ_in_weights_share_their_blocks(reviews, monkeypatch):
    from pyspark.sql import functions as F

    from ratewise.operators import features as X

    rows = reviews.withColumn("product", F.concat(F.lit("p"), F.col("id") % 3)).withColumn("author", F.concat(F.lit("a"), F.col("id") % 5))
    weights = [(1.0, 1.0, 1.0), (0.5, 0.0, 2.0)]

    def points(some):
        return [
            U.candidate({"ct": c, "pd": p, "au": a}, ("ct", "pd", "au"), lambda c=c, p=p, a=a: P.all_stages(1, 1.0, 0.01, c, p, a), U.lr(1.0, False))
            for c, p, a in some
        ]

    # A setting whose stages cannot be made fails alone.
    broken = U.candidate({"ct": 9.0, "pd": 9.0, "au": 9.0}, ("ct", "pd", "au"), lambda: 1 / 0, U.lr(1.0, False))
    fitted, real = [], X.TfidfVectorizer._fit
    monkeypatch.setattr(X.TfidfVectorizer, "_fit", lambda self, df: (fitted.append(self.spec), real(self, df))[1])
    scores = lambda grid: {r.ct: (r.score_training, r.score_validate) for r in U.repeated_holdout(rows, grid, (1,), test_size=0.3).collect()}
    together = scores([*points(weights), broken])
    assert len(fitted) == 1
    assert together == {**scores(points(weights[:1])), **scores(points(weights[1:])), 9.0: (None, None)}
    assert None not in together[1.0] + together[0.5]
