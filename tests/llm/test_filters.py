"""Line dedup, decontamination, quality and mixing on awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewise.llm import bloom, decontamination, line_dedup, mixing, quality

LONG = "word " * 50_000

ROWS = [
    (1, None, None, None, 1, "x"),
    (2, "", "en", "a", 2, "x"),
    (3, " \t\n\v\f\r ", "en", "a", 3, "y"),
    (4, "One line\nTwo  lines \n\nshared", "en", "a", 4, "y"),
    (4, "One line\nTwo  lines \n\nshared", "en", "a", 4, "y"),
    (5, "SHARED \n one LINE\nÉté", "fr", "b", 5, None),
    (6, LONG, "fr", None, 6, None),
    (None, "shared", None, None, None, None),
    (7, "shared\nshared\nété", "fr", "b", 7, "z"),
]
#: Extra columns whose names the operators use for their own.
SCHEMA = "doc_id long, text string, lang string, source string, size long, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def lines_brute(rows, min_docs, keep_first=False):
    def key(line):
        line = line.strip(" \t\n\v\f\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line)

    split = [(d, (t or "").split("\n")) for d, t in rows]
    seen, first = {}, {}
    for d, lines in split:
        for k in {key(x) for x in lines if key(x)}:
            seen[k] = seen.get(k, 0) + 1
            if d is not None:
                first[k] = min(first.get(k, d), d)
    out = []
    for d, lines in split:
        kept, used = [], set()
        for x in lines:
            k = key(x)
            shared = seen.get(k, 0) >= min_docs
            if shared and keep_first and d is not None and first[k] == d and k not in used:
                shared = False
            used.add(k)
            if not shared:
                kept.append(x)
        out.append((str(d), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("limit", [1_000_000, 0])
@pytest.mark.parametrize("bits", [None, 4])
def test_line_dedup(spark, docs, keep_first, limit, bits):
    rng = random.Random(1)
    extra = [(100 + i, "\n".join(rng.choice(["α", "b ", " B", "c", "d" * i, ""]) for _ in range(6))) for i in range(40)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    got = line_dedup.drop_lines(table, 3, keep_first=keep_first, filter_bits=bits and 18, broadcast_keys=limit).collect()
    rows = [(r[0], r[1]) for r in ROWS] + extra
    assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in got) == lines_brute(rows, 3, keep_first)


def test_bloom_filters_never_forget(spark):
    rows = [([i, i + 1],) for i in range(0, 4000, 3)] + [([5 * i for i in range(200)],)]
    table = spark.createDataFrame(rows, "h array<long>").repartition(7)
    table = table.select(F.transform("h", lambda x: F.xxhash64(x)).alias("h"))
    held = {r[0] for r in table.select(F.explode("h")).distinct().collect()}
    twice = {r[0] for r in table.select(F.explode("h").alias("h")).groupBy("h").count().where("count > 1").select("h").collect()}
    assert held
    for bits in (18, 22):
        for which, members in (("once", held), ("twice", twice)):
            made = bloom.build(table, "h", bits, which)
            assert made.has(np.array(sorted(members), np.int64)).all()
    fresh = np.random.default_rng(0).integers(0, 2**62, 10_000)
    assert bloom.build(table, "h", 20, "twice").has(fresh).mean() < 0.01


def spans_brute(docs, items, span):
    def words(t):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in t).split(" ")

    split = lambda t: [w for w in words(t) if w]
    wins = {}
    for i, t in items:
        w = split(t)
        n = min(span, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    sizes = {len(w) for w in wins}
    out = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out.append((str(d), len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_decontamination(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}é" if i % 5 == 0 else f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 4, 9, 10, 11, 30]))) for i in range(25)] + [(90, None), (91, "..."), (92, "w1"), (93, "w1")]
    passage = items[3][1] + " " + text(12)
    items.append((94, passage))
    items.append((95, passage))
    docs = [(i, text(rng.choice([0, 3, 9, 10, 60])) + " " + (passage.upper() if i % 3 == 0 else "") + " " + text(5)) for i in range(40)]
    docs += [(200, None), (201, ""), (None, passage), (202, passage), (202, passage), (203, "a " * 20_000 + passage)]
    table = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, words string, row string")
    bench = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, fp string")
    for bits in (24, 18):
        got = decontamination.scan(table, bench, 10, 5, filter_bits=bits).collect()
        assert sorted(((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got), key=str) == spans_brute(docs, items, 10)
    clean = decontamination.clean(table, bench)
    assert clean.columns == table.columns
    none = bench.limit(0)
    assert decontamination.scan(table, none).where("contaminated").count() == 0
    assert decontamination.scan(table.limit(0), bench).count() == 0


def test_clean_judges_each_row_by_its_text(spark):
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(None, passage), (None, "clean"), (None, None), (7, "so " + passage), (7, "clean too"), (8, ""), (9, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = [(r.doc_id, r.text) for r in decontamination.clean(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([rows[1], rows[2], *rows[4:]], key=str)


def test_quality_measures(spark, docs):
    again = " ".join("abcdefgh") + " x "
    rows = [(20, again + again + again, "en", "a", 0, ""), (21, "a\na \na\n\n\na b#|", "en", "a", 0, ""), (22, " ".join(map(str, range(30))), "en", "a", 0, "")]
    table = docs.unionByName(spark.createDataFrame(rows, SCHEMA))
    got = {r.doc_id: r for r in quality.assess(table).collect()}
    blank = " \t\n\v\f\r"

    for d, t, *_ in [*ROWS, *rows]:
        text = t or ""
        words = [w for w in text.translate({ord(c): " " for c in blank}).split(" ") if w]
        lines = [x for x in text.split("\n") if x.strip(blank)]
        grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        counts = {g: 0 for g in grams}
        for g in grams:
            counts[g] += 1
        repeated = {p for i, g in enumerate(grams) if counts[g] > 1 for p in range(i, i + 8)}
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(words) < 20 or 100 * len(repeated) > 30 * len(words))
        assert not (r.kept and r.base_failed)
    assert got[22].kept and not got[20].kept
    assert quality.assess(table.limit(0)).count() == 0


def test_mixing(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), "en", f"s{min(rng.randrange(12), 5)}", 0, "k") for i in range(3000)]
    table = docs.unionByName(spark.createDataFrame(rows, SCHEMA))
    got = mixing.mix(table).collect()
    size = {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r.size
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    cap, target, total = {s: 3.0 * size[s] for s in order}, {}, sum(size.values())
    while True:  # redistribute until nothing is above its cap
        free = [s for s in order if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in free) if free else 0
        above = [s for s in free if weight[s] * level >= cap[s]]
        if not above:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: cap[s] for s in above}
    taken, largest = dict.fromkeys(order, 0), dict.fromkeys(order, 0)
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in order if s is not None)
    again = mixing.mix(table.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(table.limit(0)).count() == 0
    plain = table.select("doc_id", "text", "source", "lang")
    assert sum(len(r.text.split()) for r in mixing.repeated(plain).collect() if r.text and r.source is not None) == sum(
        r.taken for r in got if r.source is not None
    )


def test_no_copy_above_the_most_repetitions(spark):
    rows = [(i, "w w w" if i % 25 == 0 else " ", "a") for i in range(200)] + [(1000 + i, "w " * 50, "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = {r.doc_id: r["count"] for r in mixing.repeated(docs, max_epochs=3.0).groupBy("doc_id").count().collect()}
    assert {copies[i] for i in range(200)} == {3}


def test_tasks_give_memory_back(spark, monkeypatch):
    """When the batches of a task end, also by an error, its worker returns what it holds free."""
    from ratewise.llm import kernels as K

    given = []
    monkeypatch.setattr(K, "_give_back", lambda: given.append(1))
    assert list(K.giving_back(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3] and given == [1]
    with pytest.raises(ZeroDivisionError):
        list(K.giving_back(lambda batches: (1 // b for b in batches))(iter([1, 0])))
    assert given == [1, 1]
    monkeypatch.undo()
    K._give_back()
