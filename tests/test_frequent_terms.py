"""The most frequent n-grams against plain counting."""

import random
import re
from collections import Counter

import pytest

from ratewise.operators import frequent_terms as T

STOP = ("the", "a")


def plain(texts, lengths, k):
    rows = []
    for n in lengths:
        for removed in (True, False):
            df = Counter()
            for text in texts:
                words = re.findall(r"\w+", (text or "").lower())
                words = [w for w in words if not (removed and w in STOP)]
                df.update({" ".join(words[i : i + n]) for i in range(len(words) - n + 1)})
            best = sorted(df.items(), key=lambda item: (-item[1], item[0]))[:k]
            rows += [(n, removed, rank, term, count) for rank, (term, count) in enumerate(best, 1)]
    return sorted(rows)


def texts_of(seed, n):
    rng = random.Random(seed)
    words = ["the", "a", *[f"w{i}" for i in range(60)]]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(0, 40))) for _ in range(n)]


def found(spark, rows, k, **more):
    reviews = spark.createDataFrame(rows, "id long, content string")
    return sorted(tuple(r) for r in T.frequent_terms(reviews, STOP, (1, 2, 3), k, **more).collect())


@pytest.mark.parametrize("share", [0.0, 0.1, 1.0])
def test_equals_plain_counting(spark, share):
    """Whatever the sample: none of the texts, some, all of them."""
    texts = texts_of(1, 300) + ["the a w1 w2"] * 50 + [None, "", "THE", "a a a"]
    assert found(spark, list(enumerate(texts)), 25, sample_share=share) == plain(texts, (1, 2, 3), 25)


def test_shared_cells_are_counted_apart(spark, monkeypatch):
    """With very few cells nearly every gram meets others in its cell; the counts stay exact. The join of cells is not broadcast."""
    monkeypatch.setattr(T, "LEAST_BITS", 1)
    monkeypatch.setattr(T, "MOST_BITS", 2)
    monkeypatch.setattr(T, "BROADCAST_CELLS", 0)
    texts = texts_of(2, 200)
    assert found(spark, list(enumerate(texts)), 10, sample_share=0.2) == plain(texts, (1, 2, 3), 10)


def test_rare_grams_stay_in_their_tasks(spark):
    texts = texts_of(3, 2000)
    reviews = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    stages = {}
    rows = T.frequent_terms(reviews, STOP, (1, 2, 3), 5, stages=stages).collect()
    every = sum(len(v) for v in [plain(texts, (1, 2, 3), 10**9)])
    assert sorted(map(tuple, rows)) == plain(texts, (1, 2, 3), 5)
    assert stages["rest"].count() * 10 < every


def test_empty_and_without_ids(spark):
    assert found(spark, [], 3) == []
    assert found(spark, [(None, "x y"), (None, "x y"), (1, None)], 3) == plain(["x y", "x y", None], (1, 2, 3), 3)


def test_no_string_is_counted_before_the_last_pass(spark):
    """Candidates and cells are numbers; strings are made of the grams of the reached cells only, once for a slice of texts."""
    texts = texts_of(5, 400)
    reviews = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    stages = {}
    rows = T.frequent_terms(reviews, STOP, (1, 2, 3), 5, stages=stages).collect()
    assert sorted(map(tuple, rows)) == plain(texts, (1, 2, 3), 5)
    assert "string" not in dict(stages["counted"].dtypes).values() and stages["counted"].columns == ["variant", "slot", "df"]
    # Every candidate has its own count beside its cell's.
    own = stages["counted"].where("slot < 0")
    assert own.count() >= 5 * len(stages["bounds"]) == 30
