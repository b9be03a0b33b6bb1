"""Near duplicates against brute force on small tables."""

import random

import pytest

from ratewise.llm import near_dup
from ratewise.llm.components import components


def shingles(text, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\v\f\r":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, k, percent):
    sets = {d: shingles(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def corpus(seed, groups=12, copies=9, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = rng.sample(vocabulary, 40)
    rows = []
    for g in range(groups):
        base = rng.sample(vocabulary, words) + (passage if g % 2 else [])
        for c in range(1 + rng.randrange(copies)):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text))
            base = text if rng.random() < 0.5 else base  # chains as well as stars
    rows += ["", None, "one", "ONE", "one two", "one two three", " One\ttwo\n", rows[0], rows[0].upper(), "x " * 3000]
    order = list(range(len(rows)))
    rng.shuffle(order)
    return [(i, rows[j]) for i, j in enumerate(order)]


@pytest.mark.parametrize("shingle,similarity,block,ids", [(3, 0.85, 250_000, 1_000_000), (3, 0.85, 150, 3), (5, 0.8, 400, 1_000_000)])
def test_matches_brute_force(spark, shingle, similarity, block, ids):
    rows = corpus(shingle * block)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(docs, shingle, similarity, block_shingles=block, broadcast_ids=ids).collect()
    want = brute(rows, shingle, round(100 * similarity))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(got) == len(rows)


def test_nulls_repeats_and_clashing_columns(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(1, text, "x", 9), (1, text, "x", 9), (None, text, None, None), (2, text, "y", 1), (3, None, "y", 1), (4, "", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, kept long")
    got = sorted((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect() if r.doc_id)
    assert got == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 1, False), (False, 3, 3, True), (False, 4, 4, True)]
    kept = near_dup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]


def test_rows_of_one_id_are_judged_by_their_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    near = a + " more"
    rows = [(3, a), (5, near), (5, b), (5, b), (6, b.upper()), (7, c), (7, c + " more"), (8, None), (8, ""), (None, a), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect() if r.doc_id)
    assert got[:6] == [(3, 3, True), (5, 3, False), (5, 5, True), (5, 5, True), (6, 5, False), (7, 7, False)] and got[6] == (7, 7, True)
    for limit in (1_000_000, 0):
        kept = [(r.doc_id, r.text) for r in near_dup.deduplicated(docs, broadcast_ids=limit).collect()]
        assert sorted(t for d, t in kept if d in (3, 5, 6)) == [a, b] and len([d for d, _ in kept if d == 7]) == 1
        assert sorted(str(t) for d, t in kept if d == 8) == ["", "None"] and sorted(t for d, t in kept if d is None) == [a, b]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 300 + i) for i in range(50)] + [(5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {7: 7} | {300 + i: 7 for i in range(50)}


def test_threshold_keeps_links():
    t = near_dup.matches_for(0.85)
    assert 15 <= t <= 25
    assert near_dup.matches_for(0.8) < t
