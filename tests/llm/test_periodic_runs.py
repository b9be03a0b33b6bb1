"""Periodic runs against their definition."""

import random

import pytest

from ratewise.llm.periodic_runs import find_runs, longest, numbered, periodic_runs, repeats
from ratewise.llm.queries import planted_run


def brute(words, min_words=24, min_repeats=3):
    """Every maximal stretch of a period without a smaller one, straight from the definition."""
    n, runs = len(words), []
    for q in range(1, n // min_repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            part = words[start : start + length]
            smaller = any(part[d:] == part[:-d] for d in range(1, q))
            if length >= max(min_words, min_repeats * q) and not smaller:
                runs.append((start, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def periodic(rng, size):
    """Random words with planted repetitions, some nested, some touching each other."""
    words = []
    while len(words) < size:
        base = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 30]))]
        if rng.random() < 0.3:
            base = base * 3 + [rng.choice("xyz")]
        words += base * rng.choice([1, 2, 3, 4, 9]) + base[: rng.randrange(len(base) + 1)]
        if rng.random() < 0.5:
            words += [f"u{rng.randrange(50)}" for _ in range(rng.randrange(6))]
    return [w.encode() for w in words[:size]]


@pytest.mark.parametrize("min_words,min_repeats", [(24, 3), (5, 3), (2, 4), (64, 3)])
def test_runs_equal_brute_force(min_words, min_repeats):
    rng = random.Random(min_words)
    for _ in range(40):
        words = periodic(rng, rng.randrange(0, 260))
        assert find_runs(numbered(words), min_words, min_repeats) == brute(words, min_words, min_repeats), words


def test_binary_and_sturmian_words():
    a, b = b"a", b"b"
    fibonacci, before = [a, b], [a]
    while len(fibonacci) < 300:
        fibonacci, before = fibonacci + before, fibonacci
    for words in (fibonacci, [a] * 100, [a] * 23, [a, b] * 12, [a, b] * 11 + [a], ([a] * 30 + [b]) * 5, []):
        assert find_runs(numbered(words), 10) == brute(words, 10)
        assert find_runs(numbered(words)) == brute(words)


def test_fewer_repeats_are_refused():
    with pytest.raises(ValueError):
        find_runs(numbered([b"a"] * 9), min_repeats=2)


def test_longest_and_repeats():
    assert longest([]) is None
    assert longest([(5, 30, 10), (9, 24, 8), (0, 25, 9)]) == (5, 30, 10)
    assert longest([(5, 48, 16), (5, 24, 8)]) == (5, 24, 8)
    assert repeats(8, [(1, 6, 2), (2, 6, 3)]).tolist() == [False] * 3 + [True] * 5


def test_long_text_of_one_period():
    words = numbered([b"w%d" % (i % 1000) for i in range(300_000)] + [b"end"])
    assert find_runs(words) == [(0, 300_000, 1000)]


def test_rows_of_all_kinds(spark):
    text = "a b " * 20
    rows = [(1, text, 7), (1, text, 7), (None, text, 8), (2, None, 8), (3, "", 8), (4, " \t\n\v\f\r", 8), (5, "é" * 9, 8), (6, "x " * 30 + "y z", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs long")
    got = {}
    for r in periodic_runs(docs).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.longest and tuple(r.longest), r.collapsed))
    run = (40, [(0, 40, 2)], (0, 40, 2), "a b")
    none = (0, [], None, "")
    assert got == {
        1: [run, run], None: [run], 2: [none], 3: [none], 4: [none],
        5: [(1, [], None, "é" * 9)], 6: [(31, [(0, 30, 1)], (0, 30, 1), "x y z")],
    }
    assert periodic_runs(docs.limit(0)).count() == 0


def test_planted_runs():
    import zlib

    seen = 0
    for doc_id in range(300):
        words = [b"w%d" % i for i in range(50 + doc_id)]
        made = planted_run(doc_id, words)
        if zlib.crc32(str(doc_id).encode()) % 10:
            assert made == words
        else:
            seen += 1
            assert len(made) == len(words)
    assert seen > 10 and planted_run(None, [b"a"]) == [b"a"] and planted_run(5, []) == []
