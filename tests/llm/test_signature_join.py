"""The signature-tree join against brute force."""

import random

import numpy as np
import pytest

from ratewise.llm import signature_join as S
from tests.llm.test_near_dup import brute, corpus


def random_sets(rng, n, size=60, edits=6):
    out, base = [], None
    for i in range(n):
        if base is None or rng.random() < 0.2:
            base = {rng.getrandbits(64) for _ in range(rng.randrange(1, size))}
        copy = set(base)
        for _ in range(rng.randrange(edits)):
            copy.discard(rng.choice(sorted(copy))) if copy and rng.random() < 0.5 else copy.add(rng.getrandbits(64))
        out.append(np.array(sorted(copy or {i}), np.uint64))
    rng.shuffle(out)
    return out


def similar(a, b, percent):
    both = len(set(a.tolist()) & set(b.tolist()))
    return 100 * both >= percent * (len(a) + len(b) - both)


def connected(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_linked_sets_share_a_part(percent):
    rng = random.Random(percent)
    sets = random_sets(rng, 120)
    keys = [set(S.part_keys(s, percent).tolist()) for s in sets]
    linked = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if similar(a, sets[j], percent) and a.tolist() != sets[j].tolist():
                linked += 1
                assert keys[i] & keys[j]
    assert linked or percent == 100


def test_sizes_at_the_edges_of_bands():
    rng = random.Random(1)
    members = sorted(rng.getrandbits(64) for _ in range(400))
    for percent in (80, 90):
        for a in range(2, 330):
            b = 100 * a // percent
            if b > a:
                x, y = (np.array(members[:n], np.uint64) for n in (a, b))
                assert set(S.part_keys(x, percent).tolist()) & set(S.part_keys(y, percent).tolist()), (percent, a, b)
            low, high = S.band(a, percent)
            assert low <= a <= high and S.band(b, percent)[0] <= high + 1


@pytest.mark.parametrize("bits", [64, 1 << 14])
@pytest.mark.parametrize("percent", [50, 90])
def test_tree_finds_all_components(monkeypatch, percent, bits):
    monkeypatch.setattr(S, "MOST_BITS", bits)
    for seed in range(12):
        rng = random.Random(seed)
        sets = random_sets(rng, rng.randrange(2, 150))
        n = len(sets)
        pairs = [(i, j) for i in range(n) for j in range(i) if similar(sets[i], sets[j], percent)]
        made = list(S.links(sets, list(range(n)), np.zeros(n, bool), percent))
        assert all(similar(sets[a], sets[b], percent) for a, b in made)
        assert connected(n, made) == connected(n, pairs)
        outside = np.array([rng.random() < 0.3 for _ in range(n)])
        if outside.any():
            across = [(i, j) for i, j in pairs if outside[i] or outside[j]]
            assert connected(n, S.links(sets, list(range(n)), outside, percent)) == connected(n, across)
        known = [find % 5 for find in range(n)]
        labelled = list(S.links(sets, known, np.zeros(n, bool), percent))
        ties = [(i, i - 5) for i in range(5, n)]
        assert connected(n, ties + labelled) == connected(n, ties + pairs)


@pytest.mark.parametrize("shingle,similarity,block", [(3, 0.9, 500_000), (3, 0.9, 120), (5, 0.8, 300), (1, 0.5, 90)])
def test_documents_match_brute_force(spark, shingle, similarity, block):
    rows = corpus(shingle * block)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.jaccard_components(docs, shingle, similarity, block_shingles=block).collect()
    want = brute(rows, shingle, round(100 * similarity))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(rows)


def test_many_small_components_in_one_group(spark):
    """Weak ties: a chain of sets that share parts with the next but are linked in pairs only."""
    rows, words = [], [f"w{i}" for i in range(4000)]
    for g in range(60):
        base = words[g * 5 : g * 5 + 60]
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join([*base[:-1], "x"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 1, 90)
    for block in (500_000, 130):
        got = S.jaccard_components(docs, 1, 0.9, block_shingles=block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_rows_of_all_kinds(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [
        (1, text, "x"), (1, text, "x"), (None, text, None), (2, text.upper() + " b", "y"), (3, None, "y"), (4, "", None),
        (5, " \t\n\v\f\r", None), (6, "one", "z"), (7, "ONE", "z"), (8, "one two", "z"), (9, "long " * 60_000, "z"), (2, "other words here", "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in S.jaccard_components(docs, 3, 0.9).collect())
    assert got == [
        (0, 38, None), (1, 38, 1), (1, 38, 1), (2, 1, 2), (2, 39, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, 1, 8), (9, 1, 9),
    ]
    assert S.jaccard_components(docs.limit(0)).count() == 0
