"""What the wide build leaves on disk, and that its parts for large tables give what those for small ones do."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise import session as S
from ratewise.operators import gram_cells as G
from ratewise.operators import randomized_svd as R
from ratewise.operators import sparse_blocks as B
from ratewise.operators import tfidf as V
from ratewise.plans import features as P

STOP = ("the", "a")


def files(*folders):
    return {os.path.join(d, n) for top in folders for d, _, names in os.walk(top) for n in names}


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for f in files(*[d.getPath() for d in folders]) if os.path.basename(f).startswith("shuffle_")}


def reviews_of(spark, seed=1, n=120):
    rng = random.Random(seed)
    words = ["the", "a", "été", *[f"w{i}" for i in range(40)]]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 30))), f"p{i % 7}", f"u{i % 11}", 1 + i % 5) for i in range(n)]
    # Ids that come twice, one without text; texts without id; no product, no author.
    rows += [(3, "w1 w2 w3 w1", "p1", "u1", 4), (4, None, "p2", None, 1), (n, None, None, "u3", 2), (n + 1, "w5 w6", None, None, 2)]
    rows += [(None, "w1 w9", "p1", "u1", 3), (None, "w9 w9 w2", None, "u2", 3)]
    return spark.createDataFrame(rows, "id long, content string, product string, author string, rating int")


def long_cells(spark, n=90, m=50, seed=3):
    a = np.random.default_rng(seed).normal(size=(n, 12)) * 0.6 ** np.arange(12) @ np.random.default_rng(seed + 1).normal(size=(12, m))
    a = np.where(np.random.default_rng(seed + 2).random((n, m)) < 0.4, a, 0.0)
    return a, spark.createDataFrame([(int(i), int(j) * 3, float(a[i, j])) for i, j in zip(*np.nonzero(a))], "id long, idx long, value double")


def test_a_build_leaves_no_shuffle(spark):
    """The shuffles of a build go with its steps, and the session's setting is as it was."""
    reviews = reviews_of(spark).where("id is not null").dropDuplicates(["id"])
    before = shuffle_files(spark)
    P.build_wide_features(reviews.where("id < 80"), reviews.where("id >= 80"), P.default_spec(1, 1.0, 0.0), svd=True, k=5)
    assert shuffle_files(spark) - before == set()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_factors_leave_their_vectors_only(spark, folder, monkeypatch):
    """Cells, panels and bases of earlier passes are removed: what stays is one table of vectors."""
    _, cells = long_cells(spark)
    monkeypatch.setattr(S, "shared_dir", lambda _: folder)
    found = R.truncated_svd(cells, 6)
    tables = {os.path.dirname(f) for f in files(folder) if f.endswith(".parquet")}
    assert found.k == 6 and {os.path.basename(t) for t in tables} == {"vectors"} and len(tables) == 1


@pytest.mark.parametrize("columns", [0, 5])
def test_few_columns_or_joins(spark, monkeypatch, columns):
    """A panel of fewer columns, and products by joins, give the same factors and projections."""
    a, cells = long_cells(spark)
    one = R.truncated_svd(cells, 12, passes=3)
    monkeypatch.setattr(R, "BROADCAST_BYTES", 8 * 50 * columns)
    monkeypatch.setattr(R, "BLOCK", 16)
    monkeypatch.setattr(R, "SLICE_CELLS", 64)
    other = R.truncated_svd(cells, 12, passes=3)
    assert other.panel == (columns or R.PANEL) and np.allclose(one.singular, other.singular, rtol=1e-6)
    rows, again = ({r.id: np.abs(r.z) for r in f.project(cells).collect()} for f in (one, other))
    assert rows.keys() == again.keys() and all(np.allclose(rows[i], again[i], atol=1e-5) for i in rows)


def test_rows_of_cells_equal_cells(spark):
    """Rows of cells are the cells, given as rows or one by one; the parts of an id add up."""
    _, cells = long_cells(spark)
    rows, _ = S.stored(R.packed(cells))
    found = R.truncated_svd(rows, 6)
    want = {r.id: r.z for r in found.project(cells).collect()}
    halves = rows.select("id", F.slice("idx", 1, 3).alias("idx"), F.slice("value", 1, 3).alias("value")).unionByName(
        rows.select("id", F.slice("idx", 4, 99).alias("idx"), F.slice("value", 4, 99).alias("value"))
    )
    for given in (rows, halves):
        got = {r.id: r.z for r in found.project(given).collect()}
        assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)


@pytest.mark.parametrize("most_terms", [10**6, 3])
@pytest.mark.parametrize("weights", [{}, {"content": 2.0, "product": 0.5, "author": 0.0}, {"content": 0.0}])
def test_packed_equals_cells(spark, monkeypatch, most_terms, weights):
    """Every cell, also of ids that come twice, of null ids and of rows without text; an id has one row."""
    index, pack = None, V.pack_indexed
    reviews = reviews_of(spark)
    index = B.fit_blocks(reviews.where("id % 3 <> 0"), V.TermSpec(1, 2, 0.02, 0.9, STOP), weights=weights).scaled(reviews.where("id % 3 <> 0"))
    monkeypatch.setattr(V, "pack_indexed", lambda *a: pack(*a, most_terms=most_terms))
    rows = index.packed(reviews)
    plain = lambda df: sorted(map(str, df.select("id", "idx", F.round("value", 10).alias("value")).collect()))
    assert rows.count() == rows.select("id").distinct().count()
    assert plain(rows.select("id", F.inline(F.arrays_zip("idx", "value")))) == plain(index.cells(reviews)) != []


@pytest.mark.parametrize("bits", [4, 12])
@pytest.mark.parametrize("stop", [STOP, ()])
def test_rare_terms_left_out_early(spark, monkeypatch, bits, stop):
    """Frequencies are the same where a first pass tells the slots of rare n-grams, however many n-grams share one."""
    monkeypatch.setattr(G, "SLICE_TOKENS", 64)
    reviews = reviews_of(spark, 5)
    spec = V.TermSpec(1, 3, 0.04, 0.5, stop)
    want = sorted(map(tuple, V.document_frequency(reviews, spec).collect()))
    monkeypatch.setattr(V, "PRUNE_BYTES", 0)
    monkeypatch.setattr(V, "MOST_SLOT_BITS", bits)
    assert sorted(map(tuple, V.document_frequency(reviews, spec).collect())) == want != []


def test_slots(spark, monkeypatch):
    """Most rare n-grams are not counted; none that is frequent is lost, also where a task empties its slots between."""
    reviews = reviews_of(spark, 6)
    tokens = V.tokenize(reviews).select("tokens").repartition(3)
    every = {(r.h1, r.h2): r.n for r in G.text_counts(tokens, [1, 2]).groupBy("h1", "h2").agg(F.sum("n").alias("n")).collect()}
    reached = G.reached_slots(tokens, [1, 2], (), 12, 18)
    some = {(r.h1, r.h2): r.n for r in G.text_counts(tokens, [1, 2], (), reached).groupBy("h1", "h2").agg(F.sum("n").alias("n")).collect()}
    assert {k: n for k, n in every.items() if n >= 12}.items() <= some.items() <= every.items() and len(some) < len(every) / 4
    assert not G.reached_slots(tokens.limit(0), [1, 2], (), 12, 18).any()
