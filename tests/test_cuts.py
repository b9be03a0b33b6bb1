"""Folds and batches cut by hashes, without moving rows."""

import random

import pytest
from pyspark.sql import functions as F

from ratewise.operators import evaluation as E


@pytest.mark.parametrize("spread", [1 << 60, 50])
def test_cuts_are_order_statistics(spark, spread):
    """Also where many draws are equal."""
    rng = random.Random(spread)
    draws = [(g, rng.randrange(spread)) for g in "aab" for _ in range(400)]
    found = E.draw_cuts(spark.createDataFrame(draws, "group string, draw long"), {"a": [1, 300, 800], "b": [7], "c": []})
    assert found["c"] == []
    for group, ranks in (("a", [1, 300, 800]), ("b", [7])):
        own = sorted(d for g, d in draws if g == group)
        for rank, cut in zip(ranks, found[group]):
            # Between the wanted draw and the one after it.
            assert own[rank - 1] <= cut and all(cut < d for d in own[rank:] if d > own[rank - 1])
    with pytest.raises(ValueError, match="fewer rows"):
        E.draw_cuts(spark.createDataFrame(draws, "group string, draw long"), {"b": [401]})


def test_folds_move_nothing(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("double").alias("label"), F.lit("text").alias("content"))
    folds = E.stratified_folds(df, "label", 3)
    assert "Exchange" not in folds._jdf.queryExecution().executedPlan().toString()
    sizes = {(r.label, r.fold): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    assert sizes == {(1.0, 0): 34, (1.0, 1): 33, (1.0, 2): 33, (0.0, 0): 300, (0.0, 1): 300, (0.0, 2): 300}
    again = E.stratified_folds(df.repartition(7), "label", 3)
    assert folds.exceptAll(again).count() == 0


def test_folds_of_small_classes_and_rows_without_label(spark):
    rows = [(1, "x"), (2, "x"), (3, "y"), (4, None)]
    found = E.stratified_folds(spark.createDataFrame(rows, "id long, label string"), "label", 5).collect()
    assert sorted((r.label, r.fold) for r in found) == [("x", 0), ("x", 1), ("y", 0)]
    assert E.stratified_folds(spark.createDataFrame([], "id long, label string"), "label").count() == 0


def test_many_classes_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(E, "MOST_CUTS", 4)
    df = spark.range(300).withColumn("label", F.col("id") % 30)
    sizes = E.stratified_folds(df, "label", 2).groupBy("label", "fold").count().collect()
    assert len(sizes) == 60 and {r["count"] for r in sizes} == {5}


@pytest.mark.parametrize("n, batches", [(100, 7), (3, 7), (0, 7), (50, 1)])
def test_batches(spark, n, batches):
    found = E.numbered_batches(spark.range(n), n_batches=batches)
    dealt = max(1, min(n, batches))
    want = {}
    for position in range(n):
        want[position * dealt // n] = want.get(position * dealt // n, 0) + 1
    assert {r.batch_no: r["count"] for r in found.groupBy("batch_no").count().collect()} == want
