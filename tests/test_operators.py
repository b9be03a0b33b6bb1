import datetime
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ratewise.functions import dates, numeric
from ratewise.operators import distributions as D
from ratewise.operators import evaluation as E
from ratewise.operators import features as FT
from ratewise.operators import ordering, selection


def test_positions_and_totals(spark):
    rows = [(i % 7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6)
    got = ordering.with_position(df, ["a", "b"]).collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == sorted(rows)
    assert sorted(r.position for r in got) == list(range(1, 501))
    total = {(r.a, r.b): r.t for r in ordering.with_running_total(df, ["a", "b"], "b", "t").collect()}
    running = 0
    for key in sorted(rows):
        running += key[1]
        assert total[key] == running
    small = ordering.smallest(df, ["a", "b"], 5).collect()
    large = ordering.smallest(df, ["a", "b"], 5, unique_limit=1).collect()
    assert {tuple(r) for r in small} == {tuple(r) for r in large} == set(sorted(rows)[:5])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40))
def test_rating_distributions(spark, ratings):
    df = spark.createDataFrame([(r,) for r in ratings], "rating int")
    histogram = D.rating_histogram(df).collect()
    assert sum(r.n for r in histogram) == len(ratings)
    assert sum(r.density * (r.bin_right - r.bin_left) for r in histogram) == pytest.approx(1)
    for small in (True, False):
        steps = sorted((r.value, r.ecdf_first, r.ecdf_last) for r in D.ecdf(df, "rating", small).collect())
        flat = [x for _, a, b in steps for x in (a, b)]
        assert flat == sorted(flat) and flat[0] == 0 and flat[-1] == pytest.approx(1 - 1 / len(ratings))


def test_correlation_of_a_constant_is_null(spark):
    stats = spark.createDataFrame([(1.0, 5), (2.0, 5)], "avg_rating double, n_reviews long")
    assert D.popularity_correlation(stats).first().abs_corr is None


def test_moving_average(spark):
    values = [float(v) for v in (3, 1, 4, 1, 5, 9, 2, 6)]
    start = datetime.date(2020, 1, 1)
    df = spark.createDataFrame(
        [(start + datetime.timedelta(days=i), v) for i, v in enumerate(values)], "date date, avg_rating double"
    )
    got = sorted((r.date, r.smoothed) for r in D.moving_average(df, 4).collect())
    want = np.convolve(values, np.ones(4) / 4, mode="valid")
    assert [v for _, v in got] == pytest.approx(list(want))
    assert got[0][0] == start + datetime.timedelta(days=2)


def test_value_histogram_closes_last_bin(spark):
    values = [0.0, 1.0, 2.0, 5.0, 11.0, 11.0, 6.0]
    df = spark.createDataFrame([(v,) for v in values], "value double")
    got = {r.bin: r.n for r in D.value_histogram(df, "value", 10).collect()}
    want, _ = np.histogram([v for v in values if v], 10)
    assert got == {i: int(n) for i, n in enumerate(want) if n}
    same = spark.createDataFrame([(2.0,), (2.0,)], "value double")
    assert D.value_histogram(same, "value", 10).first().n == 2


def test_dates(spark):
    df = spark.createDataFrame([("3 7, 2005",), ("12;  31, 1999",), ("bad",)], "d string")
    got = [r.x for r in df.select(dates.parse_review_date(F.col("d")).alias("x")).collect()]
    assert got == [datetime.date(2005, 3, 7), datetime.date(1999, 12, 31), None]
    day = datetime.date(2005, 3, 7)
    row = spark.createDataFrame([(day,)], "d date").select(
        dates.day_ordinal(F.col("d")).alias("o"), dates.from_ordinal(dates.day_ordinal(F.col("d"))).alias("r")
    ).first()
    assert row.o == day.toordinal() and row.r == day


def test_clamp_round(spark):
    values = [-1.0, 0.5, 1.5, 2.5, 3.49, 5.5, 9.0]
    df = spark.createDataFrame([(v,) for v in values], "prediction double")
    once = FT.ClampRound().transform(df)
    twice = FT.ClampRound("label", "again").transform(once).collect()
    assert [r.label for r in twice] == [float(np.rint(min(max(v, 0), 5))) for v in values]
    assert all(r.label == r.again for r in twice)


def test_log_grid(spark):
    grid = numeric.log_grid(-3, 2, 15)
    assert grid == pytest.approx(list(np.logspace(-3, 2, 15)))
    rows = spark.range(15).select(numeric.log_grid_value(F.col("id"), -3, 2, 15).alias("v")).collect()
    assert [r.v for r in rows] == pytest.approx(grid)
    assert list(map(int, numeric.log_grid(1, 3.3, 4))) == [10, 58, 341, 1995]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(1, 5)), min_size=1, max_size=20))
def test_mae_and_confusion(spark, pairs):
    df = spark.createDataFrame(pairs, "rating int, prediction int")
    one, other = E.mae(df).first().mae, E.mae(df, "prediction", "rating").first().mae
    assert one == other and (one == 0) == all(a == b for a, b in pairs)
    matrix = E.confusion_matrix(df, (1, 2, 3, 4, 5))
    assert sum(sum(r[1:]) for r in matrix.collect()) == len(pairs)
    for row in E.normalize_rows(matrix).collect():
        cells = [c for c in row[1:] if c is not None]
        assert not cells or math.isclose(sum(cells), 1)


def test_votes(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.3], [0.6, 0.2, 0.2])], "a array<double>, b array<double>")
    assert E.soft_vote(df, ["a"], n_classes=3).first().vote == 2
    assert E.soft_vote(df, ["a", "b"], n_classes=3).first().vote == 1
    assert E.soft_vote(df, ["a", "b"], [5, 1], 3).first().vote == 2
    tie = spark.createDataFrame([([0.4, 0.2, 0.4],)], "a array<double>")
    assert E.soft_vote(tie, ["a"], n_classes=3).first().vote == 1


def test_holdout_folds_batches(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3 == 0).cast("int").alias("label"))
    train, test = E.holdout(df)
    assert train.count() + test.count() == 3000 and 90 < test.count() < 210
    assert {r.id for r in test.collect()} == {r.id for r in E.holdout(df.repartition(5))[1].collect()}
    folds = {tuple(r) for r in E.stratified_folds(df, "label").groupBy("label", "fold").count().collect()}
    assert {(a, n) for a, _, n in folds} <= {(1, 333), (1, 334), (0, 666), (0, 667)} and len(folds) == 6
    sizes = E.numbered_batches(df, 700).groupBy("batch_no").count().collect()
    assert sorted(tuple(r) for r in sizes) == [(0, 700), (1, 700), (2, 700), (3, 700)]


def test_best_k_keeps_ties_out(spark):
    cells = spark.createDataFrame([(i, s) for i, s in enumerate([1.0, 2.0, 3.0, 3.0, 3.0, 3.0, 9.0])], "i int, s double")
    assert sorted(r.s for r in E.best_k_trials(cells, "s").collect()) == [1.0, 2.0]
    assert E.best_k_trials(cells.limit(3), "s").count() == 3


def test_chi2_and_k_best(spark):
    x = np.array([[1.0, 0, 2], [0, 3, 1], [2, 0, 1], [0, 1, 0]])
    y = [1, 2, 1, 3]
    cells = [(i, f"t{j}", float(x[i, j]), y[i]) for i in range(4) for j in range(3) if x[i, j]]
    long = spark.createDataFrame(cells, "id int, term string, value double, rating int")
    docs = spark.createDataFrame([(i, r) for i, r in enumerate(y)], "id int, rating int")
    observed = np.array([[x[[k for k in range(4) if y[k] == c], j].sum() for j in range(3)] for c in (1, 2, 3)])
    expected = np.outer([0.5, 0.25, 0.25], x.sum(axis=0))
    want = ((observed - expected) ** 2 / expected).sum(axis=0)
    scores = selection.chi2_scores(long, docs)
    assert {r.term: r.chi2 for r in scores.collect()} == pytest.approx({f"t{j}": want[j] for j in range(3)})
    best = {r.term for r in selection.select_k_best(scores, 2).collect()}
    vectors = spark.createDataFrame([(Vectors.dense(x[i]), float(y[i])) for i in range(4)], ["features", "label"])
    sliced = FT.SelectKBest(2).fit(vectors).transform(vectors)
    chosen = sorted(int(t[1:]) for t in best)
    assert np.allclose([r.reduced.toArray() for r in sliced.collect()], x[:, chosen])


def test_svd_is_not_centred(spark, folder):
    from pyspark.ml.feature import PCAModel

    x = np.random.default_rng(0).normal(size=(40, 6)) + 3
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(x)], ["id", "features"])
    model = FT.TruncatedSVD(3).fit(df)
    model.write().overwrite().save(folder + "/svd")
    rows = PCAModel.load(folder + "/svd").transform(df).orderBy("id").collect()
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs([r.reduced.toArray() for r in rows]), np.abs(u[:, :3] * s[:3]))


def test_scaling_and_one_hot(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0, 7.0]), "b"), (Vectors.dense([3.0, 7.0]), "a")], ["x", "p"])
    scaled = FT.UnitRange("x", "y").fit(df).transform(df).collect()
    assert [list(r.y) for r in scaled] == [[0.0, 0.0], [1.0, 0.0]]
    model = FT.OneHotBlock("p", "h", weight=0.5).fit(df)
    new = spark.createDataFrame([("a",), ("b",), ("zzz",)], ["p"])
    assert [list(r.h.toArray()) for r in model.transform(new).collect()] == [[0.5, 0], [0, 0.5], [0, 0]]
    with pytest.raises(ValueError):
        FT.select_item(df, "rating")


def test_ids(spark):
    ok = spark.range(1, 6)
    assert E.id_contiguity(ok).first().contiguous
    for bad in (spark.range(0, 5), ok.where("id <> 3"), ok.union(spark.range(2, 3))):
        assert not E.id_contiguity(bad).first().contiguous


def test_exact_holdout_sizes(spark):
    import math

    from ratewise.operators import evaluation as E

    for n, size in ((0, 0.05), (1, 0.05), (19, 0.05), (20, 0.05), (21, 0.05), (500, 0.3), (500, 1.0), (500, 0.0)):
        rows = spark.range(n).withColumnRenamed("id", "key")
        train, test = E.exact_holdout(rows, size, seed=4, key="key")
        held = {r.key for r in test.collect()}
        assert len(held) == math.ceil(size * n)
        assert {r.key for r in train.collect()} == set(range(n)) - held
    again = {r.id for r in E.exact_holdout(spark.range(300).repartition(7), 0.3)[1].collect()}
    assert again == {r.id for r in E.exact_holdout(spark.range(300), 0.3)[1].collect()}
    assert again != {r.id for r in E.exact_holdout(spark.range(300), 0.3, seed=5)[1].collect()}


def test_nth_draw_among_equals(spark):
    from ratewise.operators.evaluation import nth_draw

    values = [0, 5, 5, 5, 9, (1 << 60) - 1, 1 << 45, (1 << 45) + 1]
    draws = spark.createDataFrame([(v,) for v in values], "draw long")
    for n in range(1, 9):
        value, rest = nth_draw(draws, n)
        assert value == sorted(values)[n - 1] and rest == n - sum(v < value for v in values)


def test_holdout_of_clashing_hashes(spark, monkeypatch):
    from pyspark.sql import functions as F

    from ratewise.operators import evaluation as E

    monkeypatch.setattr(E, "seeded_draw", lambda key, seed: (key % 3).cast("bigint"))
    held = {r.id for r in E.exact_holdout(spark.range(30), 0.5)[1].select(F.col("id")).collect()}
    assert held == {i for i in range(30) if i % 3 == 0} | {1, 4, 7, 10, 13}


def _text_features(spark, rows, **options):
    from ratewise.plans import features as P

    reviews = spark.createDataFrame(rows, "id long, content string, product string, author string, rating int")
    stages = P.all_stages(1, max_df=1.0, min_df=0.01, outputCol="raw")
    return P.build_features(reviews, reviews, stages=stages, **options)[0]


def test_null_texts_in_the_feature_build(spark):
    """A null text has the features of an empty one."""
    rows = [(i, f"w{i % 7} w{i % 5} x", f"p{i % 2}", f"u{i % 3}", 1 + i % 5) for i in range(40)]
    made = []
    for text in (None, ""):
        more = [*rows, (99, text, "p1", "u1", 3)]
        assert _text_features(spark, more, svd=True, k=3).count() == 2 * len(more)
        made.append({(r.id, r.split): r.features.toArray() for r in _text_features(spark, more, svd=False).collect()})
    assert set(made[0]) == set(made[1]) and all(np.allclose(v, made[1][k]) for k, v in made[0].items())


def test_svd_that_does_not_converge(spark, monkeypatch):
    """Where Spark's iteration gives up, singular vectors come from random projections; other errors are raised."""
    a = np.random.default_rng(5).normal(size=(90, 50)) * 0.8 ** np.arange(50)
    df = spark.createDataFrame([(i, Vectors.dense(x)) for i, x in enumerate(a)], ["id", "features"])
    said = "ARPACK returns non-zero info = 1"
    monkeypatch.setattr(FT.RowMatrix, "computeSVD", lambda *_: spark._jvm.java.util.Objects.requireNonNull(None, said))
    found = {r.id: r.reduced.toArray() for r in FT.TruncatedSVD(2).fit(df).transform(df).collect()}
    _, _, v = np.linalg.svd(a)
    assert np.allclose(np.abs([found[i] for i in range(90)]), np.abs(a @ v[:2].T), atol=1e-3)
    said = "other"
    with pytest.raises(Exception, match="other"):
        FT.TruncatedSVD(2).fit(df)
